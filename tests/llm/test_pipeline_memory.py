"""What the pipeline's first stages hold on the driver and in a task, and what verification shuffles."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import line_dedup, stars, toxicity
from tidemart.plans.inspect import shuffle_metrics


def test_training_holds_its_sample_in_one_array(monkeypatch):
    real, blocks = np.random.default_rng, []
    samples = [np.unique(real(i).integers(0, 5000, 400)).astype(np.uint32) for i in range(300)]

    class Rng:
        def permutation(self, n):
            blocks.append(sum(t.size > 512 for t in tracemalloc.take_snapshot().traces))
            return real(1).permutation(n)
    monkeypatch.setattr(np.random, "default_rng", lambda seed: Rng())
    tracemalloc.start()
    try:
        toxicity.train(samples, np.arange(300.0) % 2)
    finally:
        tracemalloc.stop()
    assert len(blocks) == toxicity.EPOCHS and max(blocks) < 100


def test_texts_are_held_in_slices():
    lines = "\n".join(f"some line {i} of these words here" for i in range(50))
    batch = pa.record_batch({"doc": pa.array(range(2500)), "tie": pa.array([0] * 2500), "text": pa.array([lines] * 2500)})
    assert batch.nbytes > 3.5 * 2**20
    found = list(line_dedup._scan_lines(1)([batch]))
    assert sum(b.num_rows for b in found) == 2500 * 50 and max(b.num_rows for b in found) * len(lines) / 50 < 2.2 * 2**20

    class Shared:
        value = np.zeros(0, np.int64), np.zeros(0, np.float32), -1.0
    kept = list(toxicity._kept(Shared, "text", 0.5)([batch]))
    assert sum(b.num_rows for b in kept) == 2500 and max(b.num_rows for b in kept) * len(lines) < 1.1 * 2**20


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_contents_without_a_candidate_are_not_shuffled(spark, no_broadcast):
    rng = np.random.default_rng(1)
    contents = spark.createDataFrame([(i, bytearray(rng.bytes(1000))) for i in range(3000)], "node long, content binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (-7, 4), (5, 9)], "pivot long, node long")  # -7 has no content

    def links(own, candidates):
        return [node for _, node in candidates]
    found = stars.verified(pairs, contents, links)
    assert sorted(map(tuple, found.collect())) == [(1, 2), (1, 3), (5, 9)]
    assert shuffle_metrics(stars.verified(pairs, contents, links))["shuffle_bytes"] < 100_000
