"""Connected components by alternating star contraction, as Spark joins.

Tasks first contract their own edges with a union-find, so what is shuffled is at most one
edge per node and task.  Rounds then rewire every node to the smallest neighbour it knows
until only stars are left; aggregates are partial and joins can be split, so a node may have
any number of neighbours.  Every round is written to the shared checkpoint folder.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import materialise

EDGES = "u long, v long"


def _contract(batches):
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = root(parent.setdefault(u, u) if u not in parent else u), root(parent.setdefault(v, v) if v not in parent else v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for at in range(0, len(nodes), 1 << 18):
        part = nodes[at: at + (1 << 18)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())],
                                         names=["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges u > v: links of each node move to its smallest neighbour.

    Large: the larger neighbours of every node; small: the smaller ones and the node itself.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges u > v are stars: every node that has an edge to a smaller one has one, to a node that has none."""
    ends = (edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up"))
            .unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up"))))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 OR down = 1 AND up = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to a smaller one of its component.

    ``edges``: columns u, v (long, not NULL) in any direction; self-loops and repeats are fine.
    The component is its smallest node, which is not listed itself.
    """
    now = materialise(edges.select("u", "v").mapInArrow(_contract, EDGES).distinct())
    while not _settled(now):
        now = materialise(_star(_star(now, True), False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
