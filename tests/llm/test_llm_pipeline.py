"""The pipeline over a small folder of tables, stage by stage."""

import os
import random
import tempfile

import pytest

import corpus_pipeline as P

VOCAB = [f"term{i}" for i in range(3000)]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, scratch):
    rng = random.Random(12)
    prose = lambda n: " ".join(rng.choices(VOCAB, k=n))
    sf = tempfile.mkdtemp(prefix="pipeline-", dir=scratch)
    item, shared = prose(30), prose(15)
    docs = {i: "\n".join([prose(30), prose(30)]) for i in range(160)}
    for i in range(0, 160, 4):
        docs[i] = f"{docs[i]} vile {prose(5)} nasty {prose(5)}"
    near = prose(90).split()
    for i in (201, 202, 203):
        words = list(near)
        words[i - 200] = "changed"
        docs[i] = " ".join(words)
    docs |= {210: f"{prose(20)} {item} {prose(20)}", 211: f"{prose(40)}\n{shared}", 212: f"{shared}\n{prose(40)}",
             220: None, 221: "", 222: prose(5000)}
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, docs, item, shared


def test_stages_take_effect_and_keep_clean_documents(spark, folder):
    sf, docs, item, shared = folder
    now, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (name, stage) in enumerate(P.STAGES):
        now = P.materialise(stage(spark, now, sf))
        if i < len(P.STAGES) - 1:
            assert now.columns == COLUMNS, name
            seen.append({r.doc_id: r for r in now.collect()})
    toxic, lines, near, clean = seen
    clean_ids = {i for i in docs if i >= 160 or i % 4}
    assert set(toxic) == clean_ids
    assert set(lines) == set(toxic)
    assert [shared in lines[i].text for i in (211, 212)] == [True, False]
    assert all(r.n_chars == len(r.text) for r in lines.values() if r.text is not None) and lines[220].text is None
    # the copies differ in two words of their only line: the first occurrence stays
    assert sum(bool(lines[i].text) for i in (201, 202, 203)) == 1 or {201, 202, 203} & set(near) == {201}
    assert set(near) >= clean_ids - {202, 203} and set(clean) == set(near) - {210}
    packed = {}
    for r in now.collect():
        packed.setdefault(r.doc_id, []).append((r.piece, r.text))
    assert set(packed) == set(clean)
    for i, pieces in packed.items():
        assert " ".join(t for _, t in sorted(pieces)).split() == (clean[i].text or "").split()


def test_run_returns_the_packed_rows(spark, folder):
    assert P.run(spark, folder[0]).columns == ["doc_id", "piece", "first_word", "n_tokens", "bucket_len", "batch", "slot", "text"]
    assert 4 <= len(P.STAGES) <= 5 and P.ORACLE_SQL is None


def test_empty_documents_pass_through(spark, folder):
    sf = folder[0]
    now = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        now = stage(spark, now, sf)
        assert now.count() == 0
    assert os.path.isdir(sf)
