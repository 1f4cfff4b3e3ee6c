"""Prefix shingles leave a task as packed keys, which keep the global order of the codes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import jaccard_join
from tidemart.llm.repeats import PACKED_BYTES, PACKED_SCHEMA, packed_rows, repeated_owners


def test_shingles_of_a_slice_leave_it_by_bucket():
    class Levels:
        value = np.zeros(1 << jaccard_join.SKETCH, np.uint8)
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(200)) for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(60)), "tie": [0] * 60, "text": texts})
    rows = sum(b.num_rows for b in jaccard_join._packed_prefixes(5, 80, Levels, 4)([batch]))
    assert 0 < rows <= 3 * 4  # a row of a bucket and tag, where there was one for each of some 2,400 shingles


def test_keys_turn_into_codes_of_the_same_order(spark):
    codes = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 500, dtype=np.uint64))
    keys = (jaccard_join._turned(codes) >> np.uint64(64 - 8 * jaccard_join.KEY_BYTES)).astype(np.int64)
    got = [r.c for r in spark.createDataFrame([(i, int(k)) for i, k in enumerate(keys)], "i long, k long")
           .select("i", jaccard_join._code(F.col("k")).alias("c")).orderBy("i").collect()]
    assert got == [(int(k) & 255) << 48 | int(k) >> 8 for k in keys]
    assert got == sorted(got) and [x >> 48 for x in got] == [int(c) >> 56 for c in codes]


@pytest.mark.parametrize("width", [PACKED_BYTES, 7])
def test_keys_of_a_width_are_told_apart_by_their_bytes(spark, width):
    def slices(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                h = np.array([(3 << 56) + (i << 8), 9 << 56], np.uint64)  # the first ones differ in the seventh byte
                yield packed_rows(h, np.zeros(2, np.int64), np.array([i]), 3, width=width)
    got = repeated_owners(spark.range(4).mapInArrow(slices, PACKED_SCHEMA), width=width).collect()
    assert len(got) == (8 if width == 6 else 4)
    assert {r.key for r in got if r.key >> (8 * width - 8) == 9} == {9 << (8 * width - 8)}


def test_order_by_row_and_hash():
    rng = np.random.default_rng(3)
    for rows in (1, 300, 1 << 17):
        row, h = rng.integers(0, rows, 5000), rng.integers(0, 50, 5000, dtype=np.uint64)
        order = jaccard_join._by_row(row, h)
        expected = np.lexsort((h, row))
        assert (row[order] == row[expected]).all() and (h[order] == h[expected]).all()
    assert len(jaccard_join._by_row(np.zeros(0, np.int64), np.zeros(0, np.uint64))) == 0
