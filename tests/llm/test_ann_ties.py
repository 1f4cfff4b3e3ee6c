"""Equal scores of different vectors go to the smaller ids."""

import numpy as np
from pyspark.sql import functions as F

from tidemart.llm import ann_forest


def _check(spark, vectors):
    """Small enough that all trees' leaves are taken: the result is that of brute force."""
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann_forest.search(df, df.filter(F.col("vec_id") % 20 == 0), least=10_000_000).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    array = np.array(vectors, np.float32).astype(np.float64)
    for q in range(0, len(vectors), 20):
        score = (array * array[q]).sum(1)
        best = sorted((i for i in range(len(vectors)) if i != q), key=lambda i: (-score[i], i))[:20]
        assert [(rank, i) for rank, i, _ in sorted(got[q])] == [(n + 1, i) for n, i in enumerate(best)]
        assert [s for *_, s in sorted(got[q])] == [score[i] for i in best]


def test_three_hundred_vectors_of_one_score(spark):
    _check(spark, [[1.0] + [0.0] * 15] + [[1.0, *([0.0] * 14), float(i)] for i in range(1, 300)])


def test_integer_vectors_with_many_ties(spark):
    rng = np.random.default_rng(1)
    _check(spark, [v for v in rng.integers(-2, 3, (400, 8)).astype(float).tolist() if any(v)])
