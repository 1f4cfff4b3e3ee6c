"""Conversation structure repair: cheapest edits that give every conversation a legal order of roles.

The rows of a conversation, by turn, are edited until their roles' initials read (s?(ua)+)?:
Keep (cost 0), Rerole to user or assistant (3), Delete (4) and Insert of an empty user or assistant
row anywhere (3).  Blank rows (no character beside white space) and duplicates (role and text seen
earlier) must go; a truncated row (last such character not one of .!?) that stays adds 3.

Nodes are places between rows in one of four states (start, system, user, assistant seen last);
an edit is an arc.  Three steps give the audit (the initials of the cheapest edits, ASCII-least of
equals) and the repaired rows:

* Cost DP from the last row to the first.  Costs of the four states differ by a bounded amount, so that
  few vectors of differences occur; a step is a lookup by (vector, kind of row), filled when first seen.
* Prefix doubling over all nodes of a batch of conversations at once: a node's rank by the least audit of 1, 2,
  4, ... letters that begins there follows from the ranks of the node and of its doubled pointer.  From
  one state a letter leads to one node, so ranks of length one settle a node's arc.  Nodes of one
  rank have one audit, which is read once.
* The letters of an audit are read in parallel: letter t of a node by the pointers of the bits of t.

Distribution: rows are range partitioned by (conversation, turn, role, text), which cuts a
conversation of any size into runs.  What lies inside one run is settled there in batches.  A
conversation that touches an edge of its partition, or is longer than a block (``BLOCK`` rows or
``ROOM`` bytes of text), goes on as blocks: first occurrences by a grouped minimum, a matrix of
costs between the states at a block's ends, chained backward per conversation, then an audit per
entry state, chained forward.  So one matrix or four states per block of a conversation meet in one task.
The repaired text's SHA-256 and the audit are single values of a conversation which can only be
made front to back: its blocks pass one task as a sorted stream, one block in memory at a time.

Edge cases: NULL role and text are one space; a NULL turn comes first and is no turn for the gaps; NULL
conversations are one conversation; rows of one turn go by role, then by the first 64 characters
of the text, then by its hash; an empty role or one of another initial cannot be kept; repeated rows are duplicates; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import materialise, read

BLOCK = 4096
ROOM = 8 << 20
BATCH = 1 << 15  # rows of whole conversations settled at once
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEXT = (USER, USER, ASSISTANT, USER)      # state after Insert or Rerole
INITIALS = {"s": 0, "u": 1, "a": 2}       # 3: any other
KEEP = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
SOUND, TRUNCATED, GONE = range(3)         # kinds of fault; a row's code is initial * 3 + fault
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
INF = 1 << 50
END = (0, 2 * INSERT, INSERT, 0)          # cost from each state when no row is left
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}


class Costs:
    """Cost vectors over the four states, by number, and the steps between them."""

    def __init__(self):
        self.vectors: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.step: dict[int, tuple[int, int]] = {}   # vector * 12 + code: vector before the row, cost added
        self.arcs: dict[int, tuple] = {}             # the same: letters and node jumps of the four states

    def add(self, d) -> tuple[int, int]:
        """(number, least cost) of a vector, which is kept less its least cost."""
        low = min(d)
        v = tuple(x - low if x < INF else INF for x in d)
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v], low

    def fill(self, key: int) -> tuple[int, int]:
        after, (initial, fault) = self.vectors[key // 12], divmod(key % 12, 3)
        extra = CUT if fault == TRUNCATED else 0
        ways = []  # per state: (letter, cost, layer step, state)
        for q in range(4):
            own = [(1, DELETE + after[q], 1, q)]
            if fault != GONE:
                if (q, initial) in KEEP:
                    to = KEEP[q, initial]
                    own.append((3, extra + after[to], 1, to))
                own.append((4, REROLE + extra + after[NEXT[q]], 1, NEXT[q]))
            ways.append(own)
        d = [min(w[1] for w in own) for own in ways]
        for _ in range(3):  # at most two inserts in a row are ever cheaper
            d = [min(x, INSERT + d[NEXT[q]]) for q, x in enumerate(d)]
        d = [min(x, INF) for x in d]
        for q, own in enumerate(ways):
            own.append((2, INSERT + d[NEXT[q]], 0, NEXT[q]))
        best = [min((w for w in own if w[1] <= d[q]), default=(0, 0, 0, q)) for q, own in enumerate(ways)]
        self.arcs[key] = tuple(b[0] for b in best), tuple(4 * b[2] + b[3] - q for q, b in enumerate(best))
        self.step[key] = self.add(d)
        return self.step[key]

    def back(self, codes, end: int) -> tuple[list[int], int, int]:
        """(vector after each row, vector before the first, cost added) from the vector after the last."""
        after, total, step = [0] * len(codes), 0, self.step
        for i in range(len(codes) - 1, -1, -1):
            after[i] = end
            key = end * 12 + codes[i]
            end, low = step.get(key) or self.fill(key)
            total += low
        return after, end, total


def audits(costs: Costs, items: list[tuple]) -> list[list[tuple[str, int]]]:
    """(audit, state at the end) of runs of rows (codes, vector after them, no row follows, entry states)."""
    size = np.array([len(codes) + 1 for codes, *_ in items])
    first = np.cumsum(size) - size
    letter, jump = np.zeros((size.sum(), 4), np.int64), np.zeros((size.sum(), 4), np.int64)
    for at, (codes, end, last, _) in zip(first, items):
        after, _, _ = costs.back(codes, end)
        found = [costs.arcs[v * 12 + c] for v, c in zip(after, codes)]
        if found:
            letter[at: at + len(codes)] = [x[0] for x in found]
            jump[at: at + len(codes)] = [x[1] for x in found]
        if last:
            letter[at + len(codes)], jump[at + len(codes)] = (0, 2, 2, 0), (0, USER - SYSTEM, ASSISTANT - USER, 0)
    starts = np.array([4 * at + q for at, item in zip(first, items) for q in item[3]])
    rank = letter.reshape(-1)
    far = np.arange(len(rank)) + jump.reshape(-1)
    pointers, long, own = [far], (rank > 0).astype(np.int64), rank
    while True:
        rank = np.unique(rank * (rank.max() + 1) + rank[far], return_inverse=True)[1]
        long = long + long[far]
        further = far[far]
        if np.array_equal(further, far):
            break
        pointers.append(further)
        far = further
    _, once, which = np.unique(rank[starts], return_index=True, return_inverse=True)
    heads = starts[once]
    n = long[heads]
    t = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    node = np.repeat(heads, n)
    for k, pointer in enumerate(pointers):
        node = np.where(t >> k & 1, pointer[node], node)
    text = LETTERS[own[node]].tobytes().decode()
    cuts = np.concatenate([[0], np.cumsum(n)]).tolist()
    distinct = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    out, at = [], 0
    for *_, entries in items:
        out.append([(distinct[which[at + i]], int(far[starts[at + i]] % 4)) for i in range(len(entries))])
        at += len(entries)
    return out


def _fault(text: str) -> int:
    """SOUND, TRUNCATED or, for a blank text, GONE."""
    text = text.rstrip(BLANKS)
    return GONE if not text else SOUND if text[-1] in ".!?" else TRUNCATED


def _lines(audit: str, state: int, roles: list[str], texts: list[str]) -> list[str]:
    """Repaired rows of a run that is entered in ``state``."""
    out, i = [], 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            out.append(f"{NAMES[state]}:")
            continue
        if letter == "K":
            state = KEEP[state, INITIALS[roles[i][:1]]]
            out.append(f"{roles[i]}:{texts[i]}")
        elif letter == "R":
            state = NEXT[state]
            out.append(f"{NAMES[state]}:{texts[i]}")
        i += 1
    return out


def _turns(turns: list) -> tuple:
    """((first, last), number of different) of sorted turns; None and 0 without one."""
    real = [t for t in turns if t is not None]
    if not real:
        return None, 0
    return (real[0], real[-1]), 1 + sum(a != b for a, b in zip(real, real[1:]))


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
BLOCKS = ("seq long, codes binary, keys array<binary>, roles array<string>, texts array<string>, "
          "turn_first long, turn_last long, turns long")


def _pack(kind: pa.DataType, block_rows: int):
    """Task function: sorted rows to results of conversations inside the run and blocks of all others."""
    names = [x.split()[0] for x in RESULT.split(", ")] + [x.split()[0] for x in BLOCKS.split(", ")]
    types = [pa.int64()] * 6 + [pa.string()] * 2 + [
        pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.string())] + [pa.int64()] * 3
    schema = pa.schema([("conv_id", kind), ("whole", pa.bool_()), *zip(names, types)])

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    def block(conv, seq: int, turns, roles, texts) -> dict:
        codes = bytes(3 * INITIALS.get(r[:1], 3) + _fault(t) for r, t in zip(roles, texts))
        keys = [hashlib.blake2b(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass"), digest_size=16).digest() for r, t in zip(roles, texts)]
        ends, different = _turns(turns)
        return {"conv_id": conv, "whole": False, "seq": seq, "codes": codes, "keys": keys, "roles": roles, "texts": texts,
                "turn_first": ends and ends[0], "turn_last": ends and ends[1], "turns": different}

    def settle(costs: Costs, held: list[tuple]) -> pa.RecordBatch:
        end, items, rows = costs.add(END)[0], [], []
        for conv, turns, roles, texts in held:
            seen, codes, count = set(), bytearray(), [0, 0, 0]
            for r, t in zip(roles, texts):
                fault = _fault(t)
                if fault == GONE:
                    count[0] += 1
                elif (r, t) in seen:
                    fault = GONE
                    count[1] += 1
                elif fault == TRUNCATED:
                    count[2] += 1
                seen.add((r, t))
                codes.append(3 * INITIALS.get(r[:1], 3) + fault)
            ends, different = _turns(turns)
            _, before, total = costs.back(codes, end)
            items.append((codes, end, True, (START,)))
            rows.append({"conv_id": conv, "whole": True, "gaps": ends[1] - ends[0] + 1 - different if ends else 0,
                         "blank": count[0], "duplicate": count[1], "truncated": count[2],
                         "illegal": _illegal([r[:1] for r in roles]), "cost": total + costs.vectors[before][START]})
        for row, ((audit, _),), (_, _, roles, texts) in zip(rows, audits(costs, items), held):
            row["audit"] = audit
            row["repaired_sha256"] = hashlib.sha256("\n".join(_lines(audit, START, roles, texts)).encode()).hexdigest()
        return batch_of(rows)

    def run(batches):
        costs, held, waiting, room = Costs(), [], 0, 0
        conv, turns, roles, texts, size, seq, edge, some = None, [], [], [], 0, 0, True, False
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else 0
            for c, turn, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text"))):
                if some and c != conv:
                    if edge:  # the first of the run, or one with blocks before
                        yield batch_of([block(conv, (part << 33) + seq - len(turns), turns, roles, texts)])
                    else:
                        held.append((conv, turns, roles, texts))
                        waiting, room = waiting + len(turns), room + size
                        if waiting >= BATCH or room >= ROOM:
                            yield settle(costs, held)
                            held, waiting, room = [], 0, 0
                    turns, roles, texts, size, edge = [], [], [], 0, False
                elif some and (len(turns) >= block_rows or size >= ROOM):
                    yield batch_of([block(conv, (part << 33) + seq - len(turns), turns, roles, texts)])
                    turns, roles, texts, size, edge = [], [], [], 0, True
                conv, some = c, True
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                size += len(text) + len(role)
                seq += 1
        if held:
            yield settle(costs, held)
        if turns:
            yield batch_of([block(conv, (part << 33) + seq - len(turns), turns, roles, texts)])
    return run


def _matrices(batches):
    """Blocks with their duplicates marked, and the costs from each state before to each state after them."""
    costs = Costs()
    for batch in batches:
        rows = {x: [] for x in ("seq", "codes", "blank", "duplicate", "truncated", "matrix")}
        for seq, codes, firsts in zip(*(batch.column(x).to_pylist() for x in ("seq", "codes", "firsts"))):
            first, codes = set(firsts or ()), bytearray(codes)
            blank, again = sum(c % 3 == GONE for c in codes), 0
            for i, c in enumerate(codes):
                if c % 3 != GONE and i not in first:
                    codes[i] = c // 3 * 3 + GONE
                    again += 1
            columns = []
            for e in range(4):
                _, v, total = costs.back(codes, costs.add([0 if q == e else INF for q in range(4)])[0])
                columns.append([x + total if x < INF else INF for x in costs.vectors[v]])
            for name, value in zip(rows, (seq, bytes(codes), blank, again, sum(c % 3 == TRUNCATED for c in codes),
                                          [columns[e][q] for q in range(4) for e in range(4)])):
                rows[name].append(value)
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
            [("seq", pa.int64()), ("codes", pa.binary()), ("blank", pa.int64()), ("duplicate", pa.int64()),
             ("truncated", pa.int64()), ("matrix", pa.list_(pa.int64()))]))


def _chain_back(table: pa.Table) -> pa.Table:
    """Costs after each block of one conversation, from the last to the first; cost of all with the first."""
    table = table.sort_by("seq")
    seq, matrix = table.column("seq").to_pylist(), table.column("matrix").to_pylist()
    d, after = list(END), [None] * len(seq)
    for i in range(len(seq) - 1, -1, -1):
        after[i] = d
        m = matrix[i]
        d = [min(min(m[4 * q + e] + d[e] for e in range(4)), INF) for q in range(4)]
    return pa.table([pa.array(seq, pa.int64()), pa.array(after, pa.list_(pa.int64())),
                     pa.array([i == len(seq) - 1 for i in range(len(seq))]),
                     pa.array([d[START] if i == 0 else 0 for i in range(len(seq))], pa.int64())],
                    names=["seq", "after", "last", "cost"])


def _block_audits(batches):
    """Audit of each block from every state it may be entered in, and the state it ends in."""
    costs = Costs()
    for batch in batches:
        items = [(codes, costs.add(after)[0], last, range(4)) for codes, after, last in
                 zip(*(batch.column(x).to_pylist() for x in ("codes", "after", "last")))]
        found = audits(costs, items) if items else []
        yield pa.RecordBatch.from_arrays(
            [batch.column("seq"), pa.array([[a for a, _ in x] for x in found], pa.list_(pa.string())),
             pa.array([[q for _, q in x] for x in found], pa.list_(pa.int32()))], names=["seq", "audits", "exits"])


def _chain_on(table: pa.Table) -> pa.Table:
    """State that each block of one conversation is entered in."""
    table = table.sort_by("seq")
    entries, state = [], START
    for exits in table.column("exits").to_pylist():
        entries.append(state)
        state = exits[state]
    return pa.table([table.column("seq"), pa.array(entries, pa.int32())], names=["seq", "entry"])


def _block_lines(kind: pa.DataType):
    """Task function: repaired text of each block (NULL: no row) and what its neighbours need to know."""
    def run(batches):
        for batch in batches:
            texts, illegal, initials = [], [], []
            for audit, entry, roles, text in zip(*(batch.column(x).to_pylist() for x in ("audit", "entry", "roles", "texts"))):
                lines = _lines(audit, entry, roles, text)
                texts.append("\n".join(lines) if lines else None)
                first = [r[:1] for r in roles]
                illegal.append(_illegal(first))
                initials.append([first[0], first[-1]])
            keep = ["conv_id", "seq", "audit", "blank", "duplicate", "truncated", "cost", "turn_first", "turn_last", "turns"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in keep), pa.array(illegal, pa.int64()), pa.array(initials, pa.list_(pa.string())),
                 pa.array(texts, pa.string())], names=[*keep, "illegal", "initials", "repaired"])
    return run


def _finish(kind: pa.DataType):
    """Task function: blocks sorted by conversation and place, streamed to one result per conversation."""
    names = ["conv_id"] + [x.split()[0] for x in RESULT.split(", ")]
    schema = pa.schema([("conv_id", kind), *((x, pa.int64()) for x in names[1:7]), *((x, pa.string()) for x in names[7:])])

    def row(now: dict) -> pa.RecordBatch:
        low, high = now["low"], now["high"]
        values = [now["conv_id"], high - low + 1 - now["turns"] if low is not None else 0,
                  *(now[x] for x in ("blank", "duplicate", "truncated", "illegal", "cost")),
                  "".join(now["audit"]), now["hash"].hexdigest()]
        return pa.RecordBatch.from_pylist([dict(zip(names, values))], schema=schema)

    def run(batches):
        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                x = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if now is None or x["conv_id"] != now["conv_id"]:
                    if now is not None:
                        yield row(now)
                    now = {"conv_id": x["conv_id"], "low": None, "high": None, "turns": 0, "audit": [], "hash": hashlib.sha256(),
                           "lines": False, "initial": None, **dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)}
                for n in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    now[n] += x[n]
                if now["initial"] is not None:
                    now["illegal"] += now["initial"] + x["initials"][0] not in LEGAL
                now["initial"] = x["initials"][1]
                if x["turns"]:
                    now["turns"] += x["turns"] - (now["high"] == x["turn_first"])
                    now["low"], now["high"] = x["turn_first"] if now["low"] is None else now["low"], x["turn_last"]
                now["audit"].append(x["audit"])
                if x["repaired"] is not None:
                    now["hash"].update((("\n" if now["lines"] else "") + x["repaired"]).encode())
                    now["lines"] = True
        if now is not None:
            yield row(now)
    return run


def _long(blocks: DataFrame, kind: pa.DataType, conv: str) -> DataFrame:
    """Results of the conversations that lie in several blocks, or may do so."""
    firsts = (blocks.select("conv_id", "seq", F.posexplode("keys").alias("place", "key"))
              .groupBy("conv_id", "key").agg(F.min(F.struct("seq", "place")).alias("x"))
              .groupBy("x.seq").agg(F.collect_list("x.place").alias("firsts")))  # at most BLOCK places
    costs = materialise(blocks.select("seq", "codes").join(firsts, "seq", "left").mapInArrow(
        _matrices, "seq long, codes binary, blank long, duplicate long, truncated long, matrix array<long>"))
    owner = blocks.select("conv_id", "seq")
    after = materialise(costs.select("seq", "matrix").join(owner, "seq").groupBy("conv_id").applyInArrow(
        _chain_back, "seq long, after array<long>, last boolean, cost long"))
    found = materialise(costs.select("seq", "codes").join(after.select("seq", "after", "last"), "seq").mapInArrow(
        _block_audits, "seq long, audits array<string>, exits array<int>"))
    entry = found.select("seq", "exits").join(owner, "seq").groupBy("conv_id").applyInArrow(_chain_on, "seq long, entry int")
    chosen = (found.join(entry, "seq").select("seq", "entry", F.element_at("audits", F.col("entry") + 1).alias("audit"))
              .join(after.select("seq", "cost"), "seq").join(costs.select("seq", "blank", "duplicate", "truncated"), "seq"))
    lines = blocks.select("conv_id", "seq", "roles", "texts", "turn_first", "turn_last", "turns").join(chosen, "seq").mapInArrow(
        _block_lines(kind), f"conv_id {conv}, seq long, audit string, blank long, duplicate long, truncated long, cost long, "
                            "turn_first long, turn_last long, turns long, illegal long, initials array<string>, repaired string")
    return (lines.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
            .mapInArrow(_finish(kind), f"conv_id {conv}, {RESULT}"))


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           block_rows: int = BLOCK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    from pyspark.sql.pandas.types import to_arrow_type
    given = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(k) for k, c in (("role", role), ("text", text))))
    conv, kind = given.schema["conv_id"].dataType.simpleString(), to_arrow_type(given.schema["conv_id"].dataType)
    # the row's number ends the key, so that a run may be cut between rows that are equal
    order = ["conv_id", "turn", "role", F.left("text", F.lit(64)), F.xxhash64("text"), "row"]
    runs = (given.withColumn("row", F.monotonically_increasing_id())
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", F.spark_partition_id().alias("part")))
    packed = materialise(runs.mapInArrow(_pack(kind, block_rows), f"conv_id {conv}, whole boolean, {RESULT}, {BLOCKS}"))
    names = ["conv_id", *(x.split()[0] for x in RESULT.split(", "))]
    blocks = packed.filter(~F.col("whole")).select("conv_id", *(x.split()[0] for x in BLOCKS.split(", ")))
    return packed.filter("whole").select(names).unionByName(_long(blocks, kind, conv))


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults that crc32(conv_id:turn) % 20 picks (NULL: one space)."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = filled("text")
    return (rows.select("conv_id", "turn", fault.alias("fault"),
                        F.when(fault == 4, F.lit("user")).otherwise(filled("role")).alias("role"),
                        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
            .filter("fault != 0")
            .select("conv_id", "turn", "role", "text",
                    F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    found = repair(damage(rows))
    ids = rows.select(F.col("conv_id").alias("id")).distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
            .select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS f
  FROM keyed, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed WHERE f <> 0)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS ini,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM damaged),
again AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
                 lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
coded AS (
  SELECT *, body = '' AS blank, body <> '' AND seen AS dup,
         body <> '' AND NOT seen AND right(body, 1) NOT IN ('.', '!', '?') AS trunc FROM again),
-- d0 to d3: cheapest (cost, audit, repaired rows) from row i on, after start, system, user, assistant
step AS (
  SELECT conv_id, n + 1 AS i, {'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])} AS d0,
         {'c': 6, 'a': 'II', 't': ['user:', 'assistant:']} AS d1, {'c': 3, 'a': 'I', 't': ['assistant:']} AS d2,
         {'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])} AS d3
  FROM (SELECT DISTINCT conv_id, n FROM coded)
  UNION ALL
  SELECT conv_id, i,
         least(b0, {'c': 3 + e2.c, 'a': 'I' || e2.a, 't': list_concat(['user:'], e2.t)}),
         least(b1, {'c': 3 + e2.c, 'a': 'I' || e2.a, 't': list_concat(['user:'], e2.t)}),
         e2, least(b3, {'c': 3 + b2.c, 'a': 'I' || b2.a, 't': list_concat(['user:'], b2.t)})
  FROM (
    SELECT *, least(b2, {'c': 3 + b3.c, 'a': 'I' || b3.a, 't': list_concat(['assistant:'], b3.t)}) AS e2
    FROM (
      SELECT conv_id, i,
             least(least(dd0, ra), CASE WHEN ini = 's' THEN ks WHEN ini = 'u' THEN ku ELSE dd0 END) AS b0,
             least(least(dd1, ra), CASE WHEN ini = 'u' THEN ku ELSE dd1 END) AS b1,
             least(least(dd2, rb), CASE WHEN ini = 'a' THEN ka ELSE dd2 END) AS b2,
             least(least(dd3, ra), CASE WHEN ini = 'u' THEN ku ELSE dd3 END) AS b3
      FROM (
        SELECT c.conv_id, c.i, c.ini,
               {'c': s.d0.c + 4, 'a': 'D' || s.d0.a, 't': s.d0.t} AS dd0, {'c': s.d1.c + 4, 'a': 'D' || s.d1.a, 't': s.d1.t} AS dd1,
               {'c': s.d2.c + 4, 'a': 'D' || s.d2.a, 't': s.d2.t} AS dd2, {'c': s.d3.c + 4, 'a': 'D' || s.d3.a, 't': s.d3.t} AS dd3,
               {'c': s.d1.c + w, 'a': 'K' || s.d1.a, 't': list_concat([c.role || ':' || c.text], s.d1.t)} AS ks,
               {'c': s.d2.c + w, 'a': 'K' || s.d2.a, 't': list_concat([c.role || ':' || c.text], s.d2.t)} AS ku,
               {'c': s.d3.c + w, 'a': 'K' || s.d3.a, 't': list_concat([c.role || ':' || c.text], s.d3.t)} AS ka,
               {'c': s.d2.c + w + 3, 'a': 'R' || s.d2.a, 't': list_concat(['user:' || c.text], s.d2.t)} AS ra,
               {'c': s.d3.c + w + 3, 'a': 'R' || s.d3.a, 't': list_concat(['assistant:' || c.text], s.d3.t)} AS rb
        FROM step s JOIN (SELECT *, CASE WHEN blank OR dup THEN 1000000 WHEN trunc THEN 3 ELSE 0 END AS w FROM coded) c
          ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.i = s.i - 1)))),
counted AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         CAST(count(*) FILTER (blank) AS BIGINT) AS blank, CAST(count(*) FILTER (dup) AS BIGINT) AS duplicate,
         CAST(count(*) FILTER (trunc) AS BIGINT) AS truncated,
         CAST(count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS BIGINT) AS illegal
  FROM coded GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(s.d0.c, 0) AS BIGINT) AS cost, coalesce(s.d0.a, '') AS audit,
       sha256(coalesce(array_to_string(s.d0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN step s ON s.conv_id IS NOT DISTINCT FROM o.conv_id AND s.i = 1
"""
