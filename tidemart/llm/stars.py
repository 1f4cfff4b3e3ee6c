"""Components of a similarity join whose candidates share a key, without listing all pairs.

Rounds of stars compare every member of a key's group with one pivot of the group and
contract what links.  In a last round the members of a group that lie in different
components are compared pairwise inside a task by a cheap test that every link passes; only
pairs that pass it leave the task and are verified.  So every pair that shares a key is
either compared or connected already.  Groups of more than ``BLOCK`` members are dealt as
pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemart.operators.joins import key_filter

from .components import components
from .frames import materialise, shuffle_partitions
from .words import mix, released, utf8

GROUP = 500   # contents that meet one pivot in one task
BLOCK = 2000  # members of a key's group that are compared in one task
STARS = 2     # rounds of stars before the last round
FILTER = 24   # log2 of the bits of the filter on contents: at most 262,144 words of 64 are broadcast


def _verify(links: Callable):
    """Cogrouped by (pivot, salt): nodes whose content ``links`` with the pivot's."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            out = links(left.column("content")[0].as_py(),
                        sorted(zip(right.column("other").to_pylist(), right.column("node").to_pylist())))
        pivot = left.column("pivot")[0].as_py() if left.num_rows else None
        return pa.table({"u": pa.array([pivot] * len(out), pa.int64()), "v": pa.array(out, pa.int64())})
    return run


def verified(pairs: DataFrame, contents: DataFrame, links: Callable) -> DataFrame:
    """Links (u, v) among candidate pairs (pivot, node); a pivot with many nodes is dealt over tasks.

    Contents of nodes without a candidate, most of them in the later rounds, are not shuffled.
    """
    ends = pairs.select("node").unionByName(pairs.select(F.col("pivot").alias("node")))
    contents = key_filter(contents, ends, ["node"], FILTER)
    load = pairs.groupBy("pivot").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("_salts"))
    salted = (pairs.join(load, "pivot")
              .select("pivot", "node", F.pmod(F.xxhash64("node"), F.col("_salts")).alias("salt")))
    sent = (salted.join(contents, "node")
            .select(F.col("pivot").alias("to"), F.col("salt").alias("part"), "node", F.col("content").alias("other")))
    probes = (load.select("pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("salt"))
              .join(contents.select(F.col("node").alias("pivot"), "content"), "pivot"))
    return (probes.groupBy("pivot", "salt").cogroup(sent.groupBy("to", "part"))
            .applyInArrow(_verify(links), "u long, v long"))


class Lists(NamedTuple):
    """Lists of 64-bit words, of which some are chosen by an index array."""

    values: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def __getitem__(self, at) -> Lists:
        return Lists(self.values, self.first[at], self.counts[at])


def columns_of(batch, names, prefix: str = "") -> dict:
    """Carried columns as arrays; a fixed-size binary column becomes a matrix of 64-bit words, one of arrays ``Lists``."""
    out = {}
    for name in names:
        column = batch.column(prefix + name)
        if pa.types.is_binary(column.type):
            raw = np.frombuffer(utf8(column)[0].tobytes(), np.uint64)
            out[name] = raw.reshape(batch.num_rows, -1) if batch.num_rows else raw.reshape(0, 1)
        elif pa.types.is_list(column.type):
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            ends = np.asarray(column.offsets).astype(np.int64)
            out[name] = Lists(np.asarray(column.values).view(np.uint64), ends[:-1], np.diff(ends))
        else:
            out[name] = column.to_numpy() if isinstance(column, pa.ChunkedArray) else np.asarray(column)
    return out


def _passing(close: Callable, carried: list[str]):
    """Rows (pivot, node, a_*, b_*): the pairs that may link."""
    def run(batches):
        for batch in batches:
            keep = close(columns_of(batch, carried, "a_"), columns_of(batch, carried, "b_"))
            yield batch.select(["pivot", "node"]).filter(pa.array(keep))
    return run


def reach(n: np.ndarray, percent: int) -> np.ndarray:
    """The largest size that one of n is at least ``percent`` per cent of."""
    return 100 * n.astype(np.int64) // percent


def _all_pairs(close: Callable, carried: list[str], percent: int):
    """All rows of a partition: the pairs of a cell, in different components, that may link."""
    @released
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        cell, node, comp, block = (table.column(c).to_numpy() for c in ("cell", "node", "component", "block"))
        own, twin = table.column("own").to_numpy(), columns_of(table, carried)
        order = np.lexsort((twin["n"], cell))
        cell, n = cell[order], twin["n"][order]
        most = reach(n, percent)
        head = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1))
        size = np.diff(np.append(head, len(cell)))
        at = np.arange(len(cell))
        behind = np.repeat(head + size, size) - at  # a member and those of its cell behind it
        seen = np.zeros((0, 2), np.int64)
        for d in range(1, int(size.max())):
            at = at[behind[at] > d]
            at = at[n[at + d] <= most[at]]  # ascending: no later one is in reach
            if not len(at):
                break
            a, b = order[at], order[at + d]
            fit = (comp[a] != comp[b]) & (own[a] | (block[a] != block[b]))
            a, b = a[fit], b[fit]
            fit = close({k: v[a] for k, v in twin.items()}, {k: v[b] for k, v in twin.items()})
            seen = np.concatenate([seen, np.stack([node[a[fit]], node[b[fit]]], 1)])
            if len(seen) > 1 << 18:
                seen = np.unique(np.sort(seen, axis=1), axis=0)
        seen = np.unique(np.sort(seen, axis=1), axis=0)
        for i in range(0, len(seen), 1 << 18):
            part = seen[i: i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0].copy()), pa.array(part[:, 1].copy())],
                                             names=["pivot", "node"])
    return run


def _cell_ids(batches):
    """One number for a key and its pair of blocks; nothing else changes."""
    for batch in batches:
        h = mix(np.asarray(batch.column("key")).view(np.uint64))
        for c in ("i", "j"):
            h = mix(h ^ np.asarray(batch.column(c)).view(np.uint64))
        yield batch.append_column("cell", pa.array((h >> np.uint64(1)).astype(np.int64))).drop_columns(["key", "i", "j"])


def grouped_components(index: DataFrame, nodes: DataFrame, contents: DataFrame, linked: Callable, close: Callable, percent: int,
                       stars: int = STARS, found: DataFrame | None = None) -> DataFrame:
    """(node, component) of the nodes that link, directly or through others.

    ``index``: rows (key, node); ``nodes``: one row of columns per node, which ``close`` gets;
    ``contents``: (node, content); ``linked(pairs, contents)``: links (u, v) among candidate
    pairs (pivot, node); ``close(a, b)``: a vectorised test over dicts of the columns of
    ``nodes`` that every pair that links passes; their column n is a size, of which the smaller
    one is at least ``percent`` per cent of the other's in such a pair; ``found``: links (u, v) that are known, which
    may be of nodes without a key.
    """
    spark = index.sparkSession
    carried = [c for c in nodes.columns if c != "node"]
    index = index.select("key", "node")
    comp = None

    def joined() -> DataFrame:
        return index.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = index.withColumn("component", F.col("node"))
    if found is not None and not found.isEmpty():
        comp = materialise(components(found))
        known = joined()
    for turn in range(0 if index.isEmpty() else stars + 1):
        ends = known.select("key", F.struct("node", "component").alias("x"))
        groups = ends.groupBy("key").agg(
            F.min("x.component").alias("a"), F.max("x.component").alias("b"), F.count("*").alias("_size"),
            F.min_by("x", F.xxhash64(F.col("x.node") + (turn if turn < stars else 0))).alias("p")).filter("a != b")
        if turn < stars:
            pairs = (ends.join(groups.select("key", "p"), "key").filter("x.component != p.component")
                     .select(F.col("p.node").alias("pivot"), F.col("x.node").alias("node")).distinct())
            for end, side in (("pivot", "a"), ("node", "b")):
                pairs = pairs.join(nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{side}_{c}") for c in carried]), end)
            pairs = (pairs.select("pivot", "node", *[f"{s}_{c}" for s in "ab" for c in carried])
                     .mapInArrow(_passing(close, carried), "pivot long, node long"))
        else:
            blocks = F.ceil(F.col("_size") / BLOCK).cast("long")
            dealt = (known.join(groups.select("key", F.col("p.node").alias("home"), blocks.alias("_blocks")), "key")
                     .withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")))
                     .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
                     .select("key", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"),
                             "home", "node", "component", "block", (F.col("block") == F.col("_other")).alias("own")))
            row = ", ".join(["home long", "node long", "component long", "block long", "own boolean", "cell long"])
            # keys of one cluster of near copies mostly have the same pivot: their pairs meet in one task, once
            pairs = (dealt.withColumn("home", F.xxhash64("home", "i", "j")).mapInArrow(_cell_ids, row)
                     .join(nodes, "node").select("home", "node", "component", "block", "own", "cell", *carried)
                     .repartition(shuffle_partitions(spark), "home")
                     .mapInArrow(_all_pairs(close, carried, percent), "pivot long, node long").distinct())
        pairs = materialise(pairs)
        if pairs.isEmpty():
            continue
        new = materialise(linked(pairs, contents))
        if new.isEmpty():
            continue
        # a component stands for the links that made it
        comp = materialise(components(new if comp is None else new.unionByName(comp.toDF("u", "v"))))
        known = joined()
    return spark.createDataFrame([], "node long, component long") if comp is None else comp
