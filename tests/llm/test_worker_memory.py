"""What a Python worker gets and holds at a time in line dedup and the Jaccard join, and what it keeps after a task."""

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import decontaminate, jaccard_join, packing, words
from tidemart.llm.frames import BATCH, BATCH_BYTES, collected, materialise


@pytest.mark.parametrize("run", [lambda df: materialise(df).collect(), lambda df: collected(df).to_pylist()])
def test_workers_get_batches_of_bounded_bytes(spark, run):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])
    before = spark.conf.get(BATCH, None)
    texts = spark.range(0, 300, 1, 1).selectExpr("id", "repeat(cast(id AS string), 50000) AS text")
    found = run(texts.mapInArrow(sizes, "n long, size long"))
    assert sum(x["n"] for x in found) == 300
    assert sum(x["size"] for x in found) > 2 * BATCH_BYTES
    assert max(x["size"] for x in found) < BATCH_BYTES + (1 << 20)
    assert spark.conf.get(BATCH, None) == before


class Levels:
    value = np.arange(1 << jaccard_join.SKETCH, dtype=np.uint64).astype(np.uint8)


def _batch():
    texts = [" ".join(f"w{(i % 7 < 6) * i}x{j}" for j in range(300)) for i in range(2500)]  # every seventh is one text
    return pa.record_batch({"doc": pa.array(range(2500)), "tie": pa.array([0] * 2500), "node": pa.array(range(2500)), "text": pa.array(texts)})


def _prefix_rows():
    return [b.to_pylist() for b in jaccard_join._prefixes(5, 80, Levels)(iter([_batch()]))]


def test_shingles_are_held_of_slices_of_text(monkeypatch):
    real, held = jaccard_join.shingle_sets, []

    def watched(column, k, lower=True):
        held.append(column.nbytes)
        return real(column, k, lower)
    monkeypatch.setattr(jaccard_join, "shingle_sets", watched)
    assert _batch().nbytes > 4.5 * 2**20
    for task in (jaccard_join._members(5), jaccard_join._count(5), jaccard_join._prefixes(5, 80, Levels), jaccard_join._sets(5, Levels)):
        held.clear()
        list(task(iter([_batch()])))
        assert 2 < len(held) and max(held) < 2.2 * 2**20


def test_prefixes_settle_repeats_over_all_slices(monkeypatch):
    found = _prefix_rows()
    monkeypatch.setattr(jaccard_join, "SLICE", 1 << 30)
    assert found == _prefix_rows() and len(found) == 1
    assert sum(x["tag"] == 0 for x in found[0]) > 2000


def test_leaks_are_sought_in_slices_of_text(monkeypatch):
    real, held = decontaminate.scan, []

    def watched(column, *args, **kwargs):
        held.append(column.nbytes)
        return real(column, *args, **kwargs)
    monkeypatch.setattr(decontaminate, "scan", watched)
    monkeypatch.setattr(decontaminate, "_open", lambda shared: None)
    monkeypatch.setattr(decontaminate, "_hits", lambda words, block: (np.zeros(len(words.hash), bool), None))
    found = list(decontaminate._clean(None, "text", False)(iter([_batch()])))
    assert sum(b.num_rows for b in found) == 2500 and 2 < len(held) and max(held) < 2.2 * 2**20


@pytest.mark.parametrize("task", [jaccard_join._members(5), packing._pieces(2048, True)])
def test_workers_give_memory_back_when_a_task_ends(monkeypatch, task):
    calls = []

    class Libc:
        def __init__(self, name):
            pass

        def malloc_trim(self, pad):
            calls.append(pad)
    monkeypatch.setattr(words.ctypes, "CDLL", Libc)
    batch = _batch().append_column("doc_id", pa.array(range(2500)))
    rows = task(iter([batch, batch]))
    next(rows)
    assert not calls
    list(rows)
    assert calls == [0]


def test_word_hashes_do_not_depend_on_the_piece(monkeypatch):
    column = pa.array(["one two three " * 50, "", None, "x" * 400 + " y", "äöü ß " * 30])
    whole = words.scan(column, words.whitespace_table(), True)
    for piece in (7, 64, 1000):
        monkeypatch.setattr(words, "PIECE", piece)
        cut = words.scan(column, words.whitespace_table(), True)
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut))
