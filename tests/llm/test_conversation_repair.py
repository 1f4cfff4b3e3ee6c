"""Conversation repair against a plain dynamic programme over (cost, audit) pairs."""

import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from tidemart.llm import conversation_repair as cr

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       T.StructField("part", T.StringType()), T.StructField("row", T.StringType())])  # clash with own names
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def plain(rows):
    """Result of one conversation from its sorted (turn, role, text)."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    best = {"": (0, "", []), "a": (0, "", []), "u": (3, "I", ["assistant:"]), "s": (6, "II", ["user:", "assistant:"])}
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        extra = 3 * (fault == "truncated")
        now = {}
        for q, (c, a, t) in best.items():
            ways = [(c + 4, "D" + a, t)]
            if fault not in ("blank", "duplicate"):
                legal = {"": "su", "s": "u", "u": "a", "a": "u"}[q]
                if role[:1] and role[:1] in legal:
                    c, a, t = best[role[0]]
                    ways.append((c + extra, "K" + a, [f"{role}:{text}"] + t))
                c, a, t = best[NEXT[q]]
                ways.append((c + extra + 3, "R" + a, [f"{FULL[NEXT[q]]}:{text}"] + t))
            now[q] = min(ways)
        for _ in range(4):
            now = {q: min(x, (now[NEXT[q]][0] + 3, "I" + now[NEXT[q]][1], [f"{FULL[NEXT[q]]}:"] + now[NEXT[q]][2])) for q, x in now.items()}
        best = now
    turns = {t for t, _, _ in rows if t is not None}
    first = [r[:1] for _, r, _ in rows]
    cost, audit, lines = best[""]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    by = {}
    for c, turn, role, text, *_ in rows:
        by.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    return {c: plain(sorted(v, key=key)) for c, v in by.items()}


def check(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    out = cr.repair(df, **more).collect()
    assert len(out) == len({r[0] for r in rows})
    assert {r[0]: tuple(r[1:]) for r in out} == expected(rows)


def made(seed, conversations, length):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, length)):
            turn += rng.choice([0, 1, 1, 1, 1, 3])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((c, turn if rng.random() < 0.95 else None, role, rng.choice(["a.", "b!", "cut", "", " \n", None, f"t{rng.random()}. "])))
    return rows


def test_against_plain_programme(spark):
    check(spark, made(1, 300, 7))


@pytest.mark.parametrize("block_rows", [1, 3, 50])
def test_conversations_in_several_blocks(spark, block_rows):
    check(spark, made(2, 12, 60), block_rows=block_rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(3)
    rows = [(7, i // 2, rng.choice(["user", "assistant"]), rng.choice(["same.", f"{i}.", f"{i}", ""])) for i in range(4000)]
    check(spark, rows + made(4, 5, 6), block_rows=64)


def test_null_conversation_repeats_and_one_row(spark):
    rows = [(None, 0, "user", "hi."), (None, 1, "assistant", "yes."), (1, None, "user", "x."), (1, None, "user", "x."),
            (2, 5, "assistant", "only."), (3, 2, "system", ""), (4, 0, "user", "long " * 400_000 + "."), (4, 1, "assistant", "a.")]
    check(spark, rows)


def test_empty_table(spark):
    assert cr.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ties_go_to_the_least_letters(spark):
    # one truncated assistant row: delete it (4) or keep it (3) behind an inserted user row (3), rerole (6) and insert (3)
    out = cr.repair(spark.createDataFrame([(1, 0, "assistant", "cut", "", "")], SCHEMA)).first()
    assert (out.cost, out.audit) == (4, "D")
    # user, user: insert an answer (3) or rerole the second (3): I before K, K before R
    out = cr.repair(spark.createDataFrame([(1, 0, "user", "a.", "", ""), (1, 1, "user", "b.", "", "")], SCHEMA)).first()
    assert (out.cost, out.audit) == (3, "KR")


def test_damage_follows_the_checksum(spark):
    import zlib
    df = spark.createDataFrame([(c, t, "assistant", "a. b!", "", "") for c in (1, None) for t in [*range(40), None]], SCHEMA)
    found = {}
    for r in cr.damage(df).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c in (1, None):
        for t in [*range(40), None]:
            f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            row = ("user" if f == 4 else "assistant", "" if f == 1 else "a b" if f == 2 else "a. b!")
            assert found.get((c, t), []) == [row] * (0 if f == 0 else 2 if f == 3 else 1)
