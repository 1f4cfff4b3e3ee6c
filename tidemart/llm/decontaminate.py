"""Benchmark decontamination: broadcast hash set of normalised test n-grams.

Words are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters.  A
window is ``n`` consecutive words of one benchmark item; an item of fewer words (but not
none) is one window.  Every window of every training text is looked up by hash in the
broadcast set and each hit is verified word by word before it counts.

The broadcast is bounded: the set is cut into blocks of ``max_windows`` windows (about 90
bytes each).  A benchmark within one block takes one narrow pass without a shuffle; a
larger one takes a pass per block, whose hits are written before the next block is built
and its broadcast is destroyed, so that driver and executors hold one block at a time.

Edge cases: NULL or empty text has no words and stays clean; an item without words has no
window; items with a NULL id still hit, but have no name to list; repeated items and rows
count as one item and as separate documents; extra columns of either table are ignored
(``flag``) or passed through (``remove_documents``, ``remove_spans``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import materialise, read
from .words import Words, alnum_table, released, row_of, scan, slices, windows

N_GRAM = 10
MAX_WINDOWS = 1_000_000
SLICE = 2 << 20           # bytes of text whose words a task of ``remove`` holds at a time
FLAG_SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, "
               "items_sha256 string, contaminated boolean")


class Grams(NamedTuple):
    """One length of windows: sorted hashes, their words, and the items of each (CSR)."""

    length: int
    hash: np.ndarray
    words: np.ndarray   # (windows, length) word hashes, for verification
    filter: np.ndarray  # 2**20 flags by the top bits of the hash
    first: np.ndarray
    items: np.ndarray   # positions in Block.names; -1 for an item without id


class Block(NamedTuple):
    grams: list[Grams]
    names: list[str]


def _item_windows(n: int):
    """Task function: rows (len, hash, words, item) of a benchmark table (id, text)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), alnum_table(), lower=True)
                ids = part.column("item").to_pylist()
                rows = {"len": [], "hash": [], "words": [], "item": []}
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    size = min(n, b - a)
                    for at in range(a, b - size + 1) if size else ():
                        gram = words.hash[at: at + size]
                        rows["len"].append(int(size))
                        rows["hash"].append(int(_digest(gram[None, :]).view(np.int64)[0]))
                        rows["words"].append(gram.tobytes())
                        rows["item"].append(ids[i])
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                    [("len", pa.int32()), ("hash", pa.int64()), ("words", pa.binary()),
                     ("item", pa.string())]))
    return run


def _digest(grams: np.ndarray) -> np.ndarray:
    """Window hash, as ``windows`` makes it, from a (windows, length) array of word hashes."""
    flat = np.ascontiguousarray(grams).reshape(-1)
    k = grams.shape[1]
    first = np.arange(0, len(flat) + 1, k, dtype=np.int64)
    empty = np.zeros(0, np.int64)
    return windows(Words(flat, empty, empty, first, empty), k)[0]


def blocks(items: DataFrame, id_col: str, text_col: str, n: int = N_GRAM,
           max_windows: int = MAX_WINDOWS) -> tuple[int, Iterator[Block]]:
    """Number of window blocks of a benchmark table, of ``max_windows`` windows at most, and the blocks.

    A block comes to the driver when it is asked for; blocks are cut by a hash of the window,
    so that equal windows meet in one block.
    """
    grams = (items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
             .mapInArrow(_item_windows(n), "len int, hash long, words binary, item string")
             .distinct())
    grams = materialise(grams)
    total = grams.count()
    parts = max(1, -(-total * 5 // (max_windows * 4)) if total > max_windows else 1)
    return parts, (_block((grams.filter(F.pmod("hash", F.lit(parts)) == i) if parts > 1 else grams).toArrow())
                   for i in range(parts))


def _block(table: pa.Table) -> Block:
    items = table.column("item").to_pylist()
    names = sorted({x for x in items if x is not None})
    number = {x: i for i, x in enumerate(names)} | {None: -1}
    by: dict[int, dict[bytes, list[int]]] = {}
    for size, gram, item in zip(table.column("len").to_pylist(), table.column("words").to_pylist(), items):
        by.setdefault(size, {}).setdefault(gram, []).append(number[item])
    grams = []
    for size, found in sorted(by.items()):
        text = np.frombuffer(b"".join(found), np.uint64).reshape(-1, size)
        hashes = _digest(text)
        order = np.argsort(hashes, kind="stable")
        lists = list(found.values())
        lists = [lists[i] for i in order]
        flags = np.zeros(1 << 20, bool)
        flags[hashes >> np.uint64(44)] = True
        grams.append(Grams(size, hashes[order], text[order], flags,
                           np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64),
                           np.concatenate([np.array(x, np.int64) for x in lists])))
    return Block(grams, names)


def _share(spark, block: Block):
    """Broadcast a block as plain tuples, which executors read without this package."""
    return spark.sparkContext.broadcast(([tuple(g) for g in block.grams], block.names))


def _pass(df: DataFrame, block: Block, task, schema) -> DataFrame:
    """``df`` through ``task`` with one block, written, after which the block's broadcast is gone."""
    shared = _share(df.sparkSession, block)
    out = materialise(df.mapInArrow(task(shared), schema))
    shared.destroy()
    return out


def _open(shared) -> Block:
    grams, names = shared.value
    return Block([Grams(*g) for g in grams], names)


def _hits(words, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(covered flag per word, unique (row, item) pairs) of verified window occurrences."""
    edge = np.zeros(len(words.hash) + 1, np.int32)
    pairs = [np.zeros((0, 2), np.int64)]
    for g in block.grams:
        found, at = windows(words, g.length)
        keep = np.flatnonzero(g.filter[found >> np.uint64(44)])
        found, at = found[keep], at[keep]
        lo = np.searchsorted(g.hash, found)
        hi = np.searchsorted(g.hash, found, side="right")
        while len(at):  # equal hashes of different windows are tried one after the other
            live = lo < hi
            found, at, lo, hi = found[live], at[live], lo[live], hi[live]
            same = np.ones(len(at), bool)
            for j in range(g.length):
                same &= words.hash[at + j] == g.words[lo, j]
            np.add.at(edge, at[same], 1)
            np.add.at(edge, at[same] + g.length, -1)
            rows, gram = row_of(words, at[same]), lo[same]
            pair = np.unique(np.stack([rows, gram], 1), axis=0)
            size = g.first[pair[:, 1] + 1] - g.first[pair[:, 1]]
            begin = np.repeat(g.first[pair[:, 1]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) \
                if len(pair) else np.zeros(0, np.int64)
            item = g.items[begin + np.arange(size.sum())]
            pairs.append(np.stack([np.repeat(pair[:, 0], size), item], 1))
            lo = lo + 1
    pairs = np.unique(np.concatenate(pairs), axis=0)
    return np.cumsum(edge[:-1]) > 0, pairs[pairs[:, 1] >= 0]


def _per_row(words, flags: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[words.first[1:]] - sums[words.first[:-1]]


def _names(pairs: np.ndarray, names: list[str], rows: int) -> list[list[str]]:
    out: list[list[str]] = [[] for _ in range(rows)]
    for row, item in pairs.tolist():
        out[row].append(names[item])
    return out


def _scan(shared):
    """Task function: word counts, covered word positions and items of each (doc_id, text)."""
    def run(batches):
        block = _open(shared)
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), alnum_table(), lower=True)
                hit, pairs = _hits(words, block)
                at = np.flatnonzero(hit)
                bounds = np.searchsorted(at, words.first)
                local = (at - words.first[row_of(words, at)]).astype(np.int32)
                items = _names(pairs, block.names, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.counts, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(local, pa.int32())),
                     pa.array(items, pa.list_(pa.string()))],
                    names=["doc_id", "n_words", "hits", "items"])
    return run


def _flag(shared):
    def run(batches):
        block = _open(shared)
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), alnum_table(), lower=True)
                hit, pairs = _hits(words, block)
                n_hit = _per_row(words, hit)
                items = _names(pairs, block.names, part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array([len(x) for x in items], pa.int64()),
                     pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
                     pa.array(n_hit > 0)],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return run


def flag(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", n: int = N_GRAM,
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: counts of words, hit words and items, digest of the item ids."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts, found = blocks(items, item_id, item_text, n, max_windows)
    if parts == 1:
        return base.mapInArrow(_flag(_share(spark, next(found))), FLAG_SCHEMA)
    keyed = materialise(base.withColumn("row", F.monotonically_increasing_id()))
    scans = []
    for block in found:
        scans.append(_pass(keyed.select(F.struct("row", "doc_id").alias("doc_id"), "text"), block, _scan,
                           "doc_id struct<row:long,doc_id:long>, n_words long, hits array<int>, items array<string>"))
        del block  # before the next is built
    merged = scans[0]
    for other in scans[1:]:
        merged = merged.unionByName(other)
    # at most one row per block and document meets here
    merged = merged.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.select(
        F.col("doc_id.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _clean(shared, text: str, spans: bool):
    @released
    def run(batches):
        block = _open(shared)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                words = scan(part.column(text), alnum_table(), lower=True)
                hit, _ = _hits(words, block)
                n_hit = _per_row(words, hit)
                if not spans:
                    yield part.filter(pa.array(n_hit == 0))
                    continue
                texts = part.column(text).to_pylist()
                yield _with_texts(part, text, _cut(texts, words, hit))
    return run


def _with_texts(part: pa.RecordBatch, text: str, texts: list) -> pa.RecordBatch:
    place = part.schema.get_field_index(text)
    return part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))


def _cut(texts: list, words, hit: np.ndarray) -> list:
    """The texts without the runs of words that are flagged."""
    begin = np.concatenate([[0], np.cumsum([len((x or "").encode()) for x in texts])])
    for row in np.flatnonzero(_per_row(words, hit)):
        raw, a, b = texts[row].encode(), words.first[row], words.first[row + 1]
        flags = hit[a:b].astype(np.int8)
        step = np.diff(np.concatenate([[0], flags, [0]]))
        kept, at = [], 0
        for lo, hi in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
            kept.append(raw[at: words.start[a + lo] - begin[row]])
            at = words.end[a + hi - 1] - begin[row]
        kept.append(raw[at:])
        texts[row] = b"".join(kept).decode()
    return texts


def _cut_listed(text: str, hits: str):
    """Task function: the text column without the words at the positions in ``hits``, which is dropped."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                words = scan(part.column(text), alnum_table(), lower=True)
                hit = np.zeros(len(words.hash), bool)
                for row, places in enumerate(part.column(hits).to_pylist()):
                    if places:
                        hit[words.first[row] + np.array(places)] = True
                part = part.remove_column(part.schema.get_field_index(hits))
                yield _with_texts(part, text, _cut(part.column(text).to_pylist(), words, hit))
    return run


def _remove_spans(docs: DataFrame, found: Iterator[Block], text: str) -> DataFrame:
    """Hits of every block on the texts as they are, merged per row and cut at once."""
    keyed = materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("own")))
    merged = None
    for block in found:
        hits = (_pass(keyed.select(F.col("row").alias("doc_id"), F.col("own").getField(text).alias("text")), block, _scan,
                      "doc_id long, n_words long, hits array<int>, items array<string>")
                .filter(F.size("hits") > 0).select("doc_id", "hits"))
        merged = hits if merged is None else merged.unionByName(hits)
        del block
    # at most one row per block and document meets here
    merged = merged.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"))
    name = "_hits"
    while name in docs.columns:
        name = "_" + name
    return (keyed.join(merged, F.col("row") == F.col("doc_id"), "left")
            .select("own.*", F.col("hits").alias(name)).mapInArrow(_cut_listed(text, name), docs.schema))


def remove(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
           item_text: str = "text", n: int = N_GRAM, max_windows: int = MAX_WINDOWS,
           spans: bool = False) -> DataFrame:
    """Documents without the contaminated ones; with ``spans``, all documents without hit spans.

    Columns are those of ``docs``.  Documents are filtered by one block after the other; spans
    are found by all blocks in the original text and cut at once.
    """
    parts, found = blocks(items, item_id, item_text, n, max_windows)
    if parts == 1:
        return docs.mapInArrow(_clean(_share(docs.sparkSession, next(found)), text, spans), docs.schema)
    if spans:
        return _remove_spans(docs, found, text)
    schema = docs.schema
    for block in found:
        docs = _pass(docs, block, lambda shared: _clean(shared, text, spans), schema)
        del block
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    return flag(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bg AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
dg AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM dw, (SELECT DISTINCT size FROM bg) WHERE len(w) >= size)),
hits AS (SELECT doc_id, item_id, i, dg.size AS size FROM dg JOIN bg ON dg.size = bg.size AND dg.gram = bg.gram),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(k, ',' ORDER BY k)) AS items_sha256
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov ON dw.doc_id = cov.doc_id LEFT JOIN its ON dw.doc_id = its.doc_id
"""
