"""N-gram Jaccard join: candidates by rare prefixes, verified in a prefix tree.

The set of a document is its distinct ``k``-word shingles (64-bit hashes).  Two documents
link when ``PERCENT`` or more per cent of the shingles of both are shared.

1. Documents with equal sets form a class; only classes are joined.
2. Shingles get one global order, rare ones first, by a sketch of their frequency over all
   documents (``2**SKETCH`` counters, whatever the size of the corpus).  Linked sets must
   share at least ``l`` shingles of their prefixes of ``n - ceil(0.8 n) + l`` shingles.
   Prefix shingles that no other class has are dropped where they arise; classes with too
   few left have no link.
3. Classes that share a prefix shingle are candidates.  Rounds of stars compare every class
   of such a group with one pivot; what links becomes a component.  A last round compares
   all pairs of a group that lie in different components, by their sizes and parity bits
   (bounds that no link breaks), so no link between components is missed and no pair inside
   one is listed (``stars``).
4. The sets that meet a pivot are verified in a trie: sorted in the global order (frequent
   shingles first), sets share the overlap counted for their common prefix, and a subtree
   is left as soon as the shingles that remain cannot reach the overlap needed.

Edge cases: NULL or empty texts have an empty set and link with nothing; a text with fewer
than ``k`` words has its whole word sequence as its one shingle; rows that repeat id and
text get the same result each, different texts under one id are separate documents; a NULL
id counts as smaller than any other, so the component of its document has a NULL id; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import collected, free_names, materialise, read, shuffle_partitions
from .repeats import PACKED_SCHEMA, SPREAD, local_rows, packed_local, repeated_owners, signed
from .stars import grouped_components, verified
from .substring_dedup import keyed, _NO_ID
from .words import mix, released, scan, slices, whitespace_table, windows

K = 5
PERCENT = 80
SKETCH = 18          # log2 of the counters of the frequency sketch
PARITIES = 512       # bits of a set's parities
CHUNK = 1 << 12      # counters in one row of the sketch
SLICE = 2 << 20      # bytes of text whose shingles a task holds at a time
MAX_IDS = 2_000_000  # ids of candidate documents that may be broadcast
KEY_BYTES = 7        # of a prefix shingle: 48 bits of its hash and its level
SETS_SCHEMA = "doc long, tie long, n_shingles long, c1 long, c2 long"


def _least(n, percent: int):
    """Smallest overlap that a set of n shingles has with any set it links with."""
    return -(-n * percent // 100)


def _shared(n, percent: int):
    """Prefix shingles, beyond the first, that linked sets share at least (one of them for n)."""
    return 1 + n // 20


def _shared_with(n, percent: int):
    """The same for a set of n shingles and the smallest set that it can link with."""
    return _shared(_least(n, percent), percent)


def _by_row(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Order by row, then h; equal ones in any order."""
    order = np.argsort(h)
    row = row[order]
    return order[np.argsort(row.astype(np.uint16) if row.max(initial=0) < 1 << 16 else row, kind="stable")]


def shingle_sets(column, k: int, lower: bool = True):
    """Distinct shingle hashes of each text, ascending by row and hash: (row, hash, sizes)."""
    words = scan(column, whitespace_table(), lower)
    h, at = windows(words, k)
    rows = len(words.first) - 1
    row = np.repeat(np.arange(rows), np.maximum(0, words.counts - k + 1))
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i, r in enumerate(short):
            own = words.hash[words.first[r]: words.first[r + 1]]
            extra[i] = np.bitwise_xor.reduce(mix(own * np.uint64(3) + np.arange(len(own), dtype=np.uint64)))
        h, row = np.concatenate([h, mix(extra + np.uint64(k))]), np.concatenate([row, short])
    order = _by_row(row, h)
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[keep], row[keep]
    return row, h, np.bincount(row, minlength=rows).astype(np.int64)


def _class_of(row, h, sizes) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each set, as two sums of mixed hashes."""
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for salt in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(salt)))])
        out.append(signed(mix(sums[first[1:]] - sums[first[:-1]] + sizes.astype(np.uint64))))
    return out[0], out[1]


def _members(k: int):
    @released
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                row, h, sizes = shingle_sets(part.column("text"), k)
                c1, c2 = _class_of(row, h, sizes)
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("tie"), pa.array(sizes),
                                                  pa.array(c1), pa.array(c2)],
                                                 names=["doc", "tie", "n_shingles", "c1", "c2"])
    return run


def _count(k: int):
    """Counters of the frequency sketch over one task."""
    @released
    def run(batches):
        counts = np.zeros(1 << SKETCH, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                _, h, _ = shingle_sets(part.column("text"), k)
                counts += np.bincount(h >> np.uint64(64 - SKETCH), minlength=1 << SKETCH)
        parts = counts.reshape(-1, CHUNK)
        used = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)),
                                          pa.array([parts[i].tobytes() for i in used], pa.binary())],
                                         names=["chunk", "counts"])
    return run


def _add(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     names=["chunk", "counts"])


def frequency_levels(base: DataFrame, k: int) -> np.ndarray:
    """Level (0 rare .. 255 frequent) of each counter of the sketch; 2**SKETCH bytes in all."""
    chunks = (base.mapInArrow(_count(k), "chunk int, counts binary")
              .repartition(1 << SKETCH >> CHUNK.bit_length() - 1, "chunk").mapInArrow(_add, "chunk int, counts binary"))
    counts = np.zeros((1 << SKETCH) // CHUNK * CHUNK, np.int64).reshape(-1, CHUNK)
    table = collected(chunks)  # one row for each of the 2**SKETCH / CHUNK chunks
    for chunk, part in zip(table.column("chunk").to_pylist(), table.column("counts").to_pylist()):
        counts[chunk] += np.frombuffer(part, np.int64)
    return np.minimum(255, np.round(6 * np.log2(counts.reshape(-1) + 1))).astype(np.uint8)


def codes(h: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Shingle as a number that sorts in the global order: rare first, then by hash."""
    return levels[h >> np.uint64(64 - SKETCH)].astype(np.uint64) << np.uint64(56) | mix(h) >> np.uint64(8)


def _turned(code: np.ndarray) -> np.ndarray:
    """Codes as evenly spread keys: 48 bits of the hash, then the level, in the KEY_BYTES leading bytes."""
    return code << np.uint64(8) & ~np.uint64(0xFFFF) | code >> np.uint64(56) << np.uint64(8)


def _code(key):
    """The leading 56 bits of a code, which sort as codes do, of the leading bytes of its key."""
    return F.shiftleft(key.bitwiseAND(255), 48).bitwiseOR(F.shiftright(key, 8))


def _prefixes(k: int, percent: int, shared):
    """Rows of LOCAL_SCHEMA: prefix shingles (as codes) of each class of a batch."""
    @released
    def run(batches):
        levels = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                found, rows = [], 0
                for piece in slices(part, "text", SLICE):
                    row, h, sizes = shingle_sets(piece.column("text"), k)
                    code = codes(h, levels)
                    order = _by_row(row, code)
                    code, row = code[order], row[order]
                    nth = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
                    prefix = sizes - _least(sizes, percent) + _shared(sizes, percent)
                    keep = nth < prefix[row]
                    found.append((code[keep], row[keep] + rows, *_class_of(row, h, sizes)))
                    rows += piece.num_rows
                # what repeats is settled over more texts than are held with all their shingles
                code, row, c1, c2 = (np.concatenate(x) for x in zip(*found))
                _, once = np.unique(np.stack([c1, c2], 1), axis=0, return_index=True)
                copies = np.ones(rows, bool)
                copies[once] = False
                keep = ~copies[row]
                yield local_rows(code[keep], row[keep], c1, c2, twice=False)
    return run


def _packed_prefixes(k: int, percent: int, shared, buckets: int):
    """The same as rows of PACKED_SCHEMA, in which a class is known by the first half of its digest."""
    def run(batches):
        for local in _prefixes(k, percent, shared)(batches):
            yield packed_local(local, _turned, buckets, KEY_BYTES)
    return run


def _sets(k: int, shared):
    """node, its set as big-endian codes in the order frequent first, and its parities."""
    @released
    def run(batches):
        levels = shared.value
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                row, h, sizes = shingle_sets(part.column("text"), k)
                code = ~codes(h, levels)  # complement: frequent first
                order = _by_row(row, code)
                code = code[order].astype(">u8")
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"),
                     pa.array([code[b - n: b].tobytes() for b, n in zip(ends, sizes)], pa.binary()),
                     pa.array([x.tobytes() for x in parities(row, h, len(sizes))], pa.binary())],
                    names=["node", "content", "sketch"])
    return run


def trie_join(probe: np.ndarray, sets: list[np.ndarray], percent: int, step: int = 32) -> list[int]:
    """Indexes of the sets that link with ``probe``.

    ``sets`` are ascending code arrays sorted lexicographically, which is a depth-first walk
    of their trie: a set goes on from the overlap counted at its common prefix with the set
    before, and skips what lies below a node where the walk was given up.
    """
    found: list[int] = []
    m = len(probe)
    overlap = np.zeros(1, np.int64)   # overlap after each shingle of the walk's path
    path = np.zeros(0, np.uint64)
    dead, least = None, 0             # depth at which the path was given up, for sets of least shingles or more
    for i, s in enumerate(sets):
        n = len(s)
        need = -(-percent * (n + m) // (100 + percent))
        both = min(len(path), n)
        differ = np.flatnonzero(path[:both] != s[:both])
        depth = int(differ[0]) if len(differ) else both
        if dead is not None and depth >= dead and n == least:
            continue
        depth = min(depth, len(overlap) - 1)
        counts = [overlap[: depth + 1]]
        have, at, gone = int(overlap[depth]), depth, False
        while at < n:
            left = m - int(np.searchsorted(probe, s[at]))
            if have + min(n - at, left) < need:
                gone = True
                break
            part = s[at: at + step]
            place = np.searchsorted(probe, part)
            hit = (place < m) & (probe[np.minimum(place, m - 1)] == part)
            counts.append(have + np.cumsum(hit))
            have, at = int(counts[-1][-1]), at + len(part)
        overlap, path = np.concatenate(counts), s
        dead, least = (at, n) if gone else (None, 0)
        if not gone and have >= need:
            found.append(i)
    return found


def parities(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """(rows, PARITIES / 64) bits: whether an odd number of a set's shingles falls on each bit."""
    odd = np.bincount(row * PARITIES + (mix(h + np.uint64(5)) % np.uint64(PARITIES)).astype(np.int64),
                      minlength=rows * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(rows, PARITIES), axis=1).view(np.uint64)


def _close(percent: int):
    """Bounds that linked sets keep: on their sizes, and on the shingles only one of them has.

    Each shingle of one set alone flips one parity, so parities that differ are not more.
    """
    def run(a: dict, b: dict) -> np.ndarray:
        m, n = a["n"].astype(np.int64), b["n"].astype(np.int64)
        fit = (100 * m >= percent * n) & (100 * n >= percent * m)
        at = np.flatnonzero(fit)
        differ = np.bitwise_count(a["sketch"][at] ^ b["sketch"][at]).sum(axis=1, dtype=np.int64)
        fit[at] = differ * (100 + percent) <= (100 - percent) * (m[at] + n[at])
        return fit
    return run


def _links(percent: int):
    """Nodes of the sorted candidate sets that link with a set, by one walk of their trie."""
    def run(own: bytes, candidates: list[tuple[bytes, int]]) -> list[int]:
        sets = [np.frombuffer(x, ">u8").astype(np.uint64) for x, _ in candidates]
        return [candidates[i][1] for i in trie_join(np.frombuffer(own, ">u8").astype(np.uint64), sets, percent)]
    return run


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    base = keyed(docs, doc_id, text)
    members, comp = link_keyed(base, k, percent)
    # a component is named by its smallest id
    named = materialise(members.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("doc").alias("least"))
    return (named.join(least, "component")
            .select(F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), "n_shingles",
                    F.when(F.col("least") != _NO_ID, F.col("least")).alias("component_id")))


def link_keyed(base: DataFrame, k: int = K, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc, tie, n_shingles, node) of every row, and (node, component) of linked classes."""
    spark = base.sparkSession
    parts = shuffle_partitions(spark)
    members = materialise(base.mapInArrow(_members(k), SETS_SCHEMA))
    classes = (members.filter("n_shingles > 0").groupBy("c1", "c2")
               .agg(F.min(F.struct("doc", "tie")).alias("rep"), F.first("n_shingles").alias("n")))
    name = F.when(F.col("rep.tie") == 0, F.col("rep.doc")).otherwise(F.xxhash64("rep.doc", "rep.tie"))
    levels = spark.sparkContext.broadcast(frequency_levels(base, k))
    found = repeated_owners(base.mapInArrow(_packed_prefixes(k, percent, levels, SPREAD * parts), PACKED_SCHEMA), width=KEY_BYTES)
    n_least = -F.floor(-F.col("n") * percent / 100)
    prefixes = materialise(
        found.groupBy(F.col("node").alias("c1")).agg(F.array_sort(F.collect_set(_code(F.col("key")))).alias("codes"))
        .join(classes, "c1")
        .withColumn("l", (1 + F.floor(n_least / 20)).cast("int"))
        .filter(F.size("codes") >= F.col("l"))
        # of l shared shingles or more, one is not among the last l - 1
        .select(name.alias("node"), "rep", "n", F.expr("slice(codes, 1, size(codes) - l + 1)").alias("codes")))
    ids = prefixes.select("rep.doc", "rep.tie", "node")
    few = prefixes.count() <= MAX_IDS
    texts = base.join(F.broadcast(ids) if few else ids, ["doc", "tie"])
    sets = materialise(texts.mapInArrow(_sets(k, levels), "node long, content binary, sketch binary").dropDuplicates(["node"]))
    index = prefixes.select(F.explode("codes").alias("key"), "node")
    bounds = materialise(prefixes.select("node", "n").join(sets.select("node", "sketch"), "node"))
    comp = grouped_components(index, bounds, sets, partial(verified, links=_links(percent)), _close(percent), percent)
    named = classes.select("c1", "c2", name.alias("_node"))
    members = (members.join(named, ["c1", "c2"], "left")
               .withColumn("own", F.when(F.col("tie") == 0, F.col("doc")).otherwise(F.xxhash64("doc", "tie")))
               .select("doc", "tie", "n_shingles",
                       F.when(F.col("n_shingles") > 0, F.col("_node")).otherwise(F.col("own")).alias("node")))
    return members, comp


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` that are the first of their component, or link with nothing.

    First is the smallest id (NULL before all); of rows that repeat id and text one stays.
    """
    d, t = free_names(docs, "doc", "tie")
    members, comp = link_keyed(keyed(docs, doc_id, text), k, percent)
    named = members.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kept = named.groupBy("component").agg(F.min(F.struct("doc", "tie")).alias("first"))
    gone = (named.join(kept, "component").filter("n_shingles > 0 AND struct(doc, tie) != first")
            .select(F.col("doc").alias(d), F.col("tie").alias(t)).distinct())
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))
    same = (F.col(t) == 0) | (F.col(t) == F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    gone = materialise(gone)
    few = gone.count() <= MAX_IDS
    left = docs.join(F.broadcast(gone) if few else gone, (doc == F.col(d)) & same, "left_anti")
    repeats = not members.filter("tie != 0").isEmpty()
    return left.dropDuplicates([doc_id, text]) if repeats else left


def query(spark, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM dw WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ways AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM both_ways JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT dw.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles,
       least(dw.doc_id, coalesce((SELECT min(y) FROM reach WHERE reach.x = dw.doc_id), dw.doc_id)) AS component_id
FROM dw LEFT JOIN size ON dw.doc_id = size.doc_id
"""
