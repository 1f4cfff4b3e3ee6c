"""Packing: optimal length buckets and token-budget batches.

A text is cut into pieces of at most ``max_len`` tokens (words between white space), so
that the global histogram of piece lengths has at most ``max_len`` entries.  Dynamic
programming over it chooses the ``n_buckets`` boundaries with the least padding.  Inside a
bucket, batches of ``budget // boundary`` pieces form; a bucket is dealt by hash into
groups of about ``BATCHES`` batches, numbered on their own, so no task holds a bucket.  Each
group ends with one batch that may not be full.

Edge cases: a text that is NULL or has no word gives one row with n_tokens 0 and neither
bucket nor batch; a text of any length gives as many pieces as it needs; repeated rows are
packed each and spread by their number; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .frames import materialise, read
from .words import released, scan, slices, utf8, whitespace_table

MAX_LEN = 2048
N_BUCKETS = 8
BUDGET = 16384
BATCHES = 512  # batches that a hash group of a bucket holds on average


def _pieces(max_len: int, with_text: bool):
    @released
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = scan(part.column("text"), whitespace_table(), lower=False)
                counts = words.counts
                n = np.maximum(1, -(-counts // max_len))
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first = piece * max_len
                size = np.minimum(max_len, counts[row] - first)
                ids = part.column("doc_id")
                _, same = np.unique(np.asarray(ids.fill_null(-1)), return_inverse=True)
                order = np.argsort(same, kind="stable")
                nth = np.empty(len(order), np.int64)  # number of a row among those of its id
                nth[order] = np.arange(len(order)) - np.searchsorted(same[order], same[order])
                columns = [ids.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(first, pa.int64()),
                           pa.array(size, pa.int32()), pa.array(nth[row], pa.int64())]
                if with_text:
                    raw, begin = utf8(part.column("text"))
                    at = words.first[row] + first
                    texts = [bytes(raw[words.start[a]: words.end[a + s - 1]]).decode() if s else ""
                             for a, s in zip(at, size)]
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "piece", "first_word", "n_tokens", "nth", "text"][: len(columns)])
    return run


def boundaries(histogram: dict[int, int], n_buckets: int = N_BUCKETS) -> list[int]:
    """Bucket boundaries (longest length of each) with the least total padding."""
    lengths = np.array(sorted(k for k, c in histogram.items() if k > 0 and c > 0), np.int64)
    if not len(lengths):
        return []
    count = np.concatenate([[0], np.cumsum([histogram[int(k)] for k in lengths])])
    k, size = min(n_buckets, len(lengths)), len(lengths)
    # cost[i, j]: padded tokens of one bucket with the lengths i..j-1
    cost = (count[None, 1:] - count[:-1, None]) * lengths[None, :]
    cost = np.where(np.arange(size)[:, None] <= np.arange(size)[None, :], cost, np.iinfo(np.int64).max // 4)
    best, back = cost[0].copy(), np.zeros((k, size), np.int64)
    for b in range(1, k):
        total = best[:-1, None] + cost[1:, :]
        back[b] = total.argmin(0) + 1
        best = np.minimum(total.min(0), np.iinfo(np.int64).max // 4)
    out, j = [], size - 1
    for b in range(k - 1, -1, -1):
        out.append(int(lengths[j]))
        j = int(back[b, j]) - 1
        if j < 0:
            break
    return sorted(out)


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_len: int = MAX_LEN,
         n_buckets: int = N_BUCKETS, budget: int = BUDGET, with_text: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_tokens, bucket_len, batch, slot (, text)."""
    schema = "doc_id long, piece int, first_word long, n_tokens int, nth long" + ", text string" * with_text
    pieces = materialise(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
                         .mapInArrow(_pieces(max_len, with_text), schema))
    # at most max_len + 1 rows, whatever the size of the corpus
    histogram = {r["n_tokens"]: r["count"] for r in pieces.groupBy("n_tokens").count().collect()}
    cuts = boundaries(histogram, n_buckets)
    bucket = salts = per = F.lit(None)
    for b in reversed(cuts):
        low = max([c for c in cuts if c < b], default=0)
        rows, size = sum(c for k, c in histogram.items() if low < k <= b), max(1, budget // b)
        inside = F.col("n_tokens").between(low + 1, b)
        bucket = F.when(inside, F.lit(b)).otherwise(bucket)
        salts = F.when(inside, F.lit(-(-rows // (size * BATCHES)))).otherwise(salts)
        per = F.when(inside, F.lit(size)).otherwise(per)
    dealt = pieces.withColumns({"bucket_len": bucket.cast("int"), "_salts": salts.cast("long"), "_per": per.cast("int")})
    # texts without words are in no bucket: spread over as many groups as there is need for
    empty = max(1, histogram.get(0, 0) // 100_000)
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "nth"),
                                             F.coalesce("_salts", F.lit(empty)).cast("long")))
    n = F.row_number().over(Window.partitionBy("bucket_len", "_salt").orderBy("doc_id", "piece", "nth")) - 1
    out = dealt.withColumn("_n", n)
    return out.select(
        "doc_id", "piece", "first_word", "n_tokens", "bucket_len",
        (F.floor(F.col("_n") / F.col("_per")) * F.col("_salts") + F.col("_salt")).cast("long").alias("batch"),
        F.when(F.col("bucket_len").isNotNull(), F.col("_n") % F.col("_per")).cast("int").alias("slot"),
        *(["text"] if with_text else []))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
