"""Each pipeline stage on NULLs, repeated rows, texts that share an id, and columns with the stages' own names."""

import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

EXTRA = ["_doc", "_tie", "_gone", "doc", "tie", "node", "score", "slots", "y", "piece", "batch", "component", "ITEM_ID"]
VOCAB = [f"word{i}" for i in range(4000)]


@pytest.fixture(scope="module")
def folder(spark, scratch):
    rng = random.Random(31)
    prose = lambda n: " ".join(rng.choices(VOCAB, k=n))
    line, item, near = prose(12), prose(14), prose(60)
    docs = [(i, prose(40)) for i in range(100, 140)]
    docs += [(None, None), (None, f"{line}\n{prose(30)}"), (None, ""), (1, None), (2, ""), (2, ""),
             (3, f"{prose(30)}\n{line}"), (3, f"{prose(30)}\n{line}"),          # two texts of one id
             (4, near), (4, near), (4, near), (5, f"{near} more"),              # a row three times and a near copy
             (6, f"{prose(10)} {item} {prose(10)}"), (7, "vile nasty " * 20 + prose(5)), (8, "?!\n\n ..."), (9, prose(6000))]
    docs += [docs[-1]] * 2
    sf = tempfile.mkdtemp(prefix="edges-", dir=scratch)
    (spark.createDataFrame(docs, "doc_id long, text string")
     .select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"),
             F.length("text").cast("long").alias("n_chars"),
             *(F.concat(F.lit(x), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(x) for x in EXTRA))
     .repartition(5).write.parquet(f"{sf}/documents.parquet"))
    labels = [(i, 1, 0) for i in range(100, 140)] + [(None, 1, 1), (2, None, None), (4, 1, 0), (7, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item), (None, None), (2, ""), (3, " . ")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, docs, line, near


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def own_columns_kept(now):
    return all(r[x] == x + ("-" if r.doc_id is None else str(r.doc_id)) for r in now.collect() for x in EXTRA)


def test_toxic_rows_go_together(spark, folder):
    sf, docs, *_ = folder
    before = spark.read.parquet(f"{sf}/documents.parquet")
    now = P.remove_toxic(spark, before, sf)
    assert now.schema == before.schema and own_columns_kept(now)
    assert rows(now).items() <= Counter(docs).items()
    assert {i for i, _ in rows(now)} >= set(range(100, 140)) | {None, 1, 2, 8}


def test_lines_go_where_an_occurrence_stays(spark, folder):
    sf, docs, line, near = folder
    before = spark.read.parquet(f"{sf}/documents.parquet")
    now = P.dedup_lines(spark, before, sf)
    assert now.schema == before.schema and own_columns_kept(now)
    got = now.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in docs)
    assert [r.doc_id for r in got if line in (r.text or "")] == [None]       # NULL comes before all
    assert Counter(r.text for r in got if r.doc_id == 4) == {near: 3}        # one document
    assert all((r.text is None and r.n_chars is None) or r.n_chars == len(r.text) for r in got)
    assert sum(r.text is None for r in got) == 2


def test_one_document_of_a_group_stays(spark, folder):
    sf, docs, line, near = folder
    before = spark.read.parquet(f"{sf}/documents.parquet")
    now = P.join_near(spark, before, sf)
    assert now.columns == before.columns and own_columns_kept(now)
    assert rows(now) == Counter({d: 1 for d in docs if d[0] != 5})


def test_leaks_go_and_all_else_stays(spark, folder):
    sf, docs, *_ = folder
    before = spark.read.parquet(f"{sf}/documents.parquet")
    now = P.remove_leaks(spark, before, sf)
    assert now.schema == before.schema and own_columns_kept(now)
    assert rows(now) == Counter(d for d in docs if d[0] != 6)


def test_every_row_is_packed(spark, folder):
    sf, docs, *_ = folder
    got = P.pack_batches(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()
    words = Counter()
    for r in got:
        words[r.doc_id] += r.n_tokens
        assert (r.bucket_len is None) == (r.n_tokens == 0) and (r.n_tokens or 0) <= (r.bucket_len or 0)
    assert words[9] == 3 * 6000 and words[4] == 3 * 60 and words[2] == words[1] == 0
    assert sum(r.doc_id == 2 for r in got) == 2 and sum(r.doc_id is None for r in got) == 3
    assert len({(r.bucket_len, r.batch, r.slot) for r in got if r.n_tokens}) == sum(r.n_tokens > 0 for r in got)
