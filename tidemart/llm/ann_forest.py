"""Approximate nearest neighbours: a forest of random-projection trees.

1. Equal vectors form a class with its ``k + 1`` smallest ids (ties go to smaller ids, so no
   other id of it can be an answer); a vector that a third of all rows share costs one row.
2. Trees are fitted on at most ``SAMPLE`` classes: each node splits its sample at the median
   of the projection on the difference of two of its points.  The forest is at most
   ``TREES * SAMPLE / 4`` planes, whatever the size of the corpus, and is broadcast.
3. Every class goes to one leaf of each tree.  Every query takes the leaves of all trees in one
   order, nearest split first (squared margins add up along a path), until those taken hold
   enough rows; the numbers of rows in the leaves (one number each) are known to it.
4. Queries and classes meet by leaf; inner products in double precision rank the candidates
   exactly, and the best of all leaves are merged.  A large leaf is dealt by hash into
   parts, and so are its queries.

Edge cases: vectors that are NULL or zero, hold NULL or non-finite components, or whose
length differs from the most common one, and rows without id take no part; fewer than
``k`` candidates give all of them; repeated rows count once; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .frames import materialise, read, shuffle_partitions
from .words import mix

K = 20
TREES = 24
SAMPLE = 20_000      # classes that the forest is fitted on, at most
LEAF = 96            # rows of a leaf aimed at, where the sample allows so many leaves
SEARCH = 0.6         # share of the rows that a query takes from all trees together ...
SEARCH_LEAST = 8_000 # ... and least number
PART = 5_000         # rows, and queries, of one leaf that meet in one cell
BUCKET = 1 << 22     # numbers in the vectors of the cells that one task takes: a query's bound starts anew in each
HELD = 1 << 17       # query and row pairs that wait for their exact score
NEAR = 1 << 20       # query and row pairs of one matrix product
SEED = 11
BATCH_IDS = "vec array<float>, salt int, ids array<long>"


class Forest(NamedTuple):
    planes: np.ndarray   # (nodes, dims)
    cuts: np.ndarray     # threshold of each inner node
    left: np.ndarray     # child node; ~leaf for a leaf
    right: np.ndarray
    roots: np.ndarray    # one per tree; ~leaf for a tree of one leaf
    leaves: int          # of all trees


def grow(sample: np.ndarray, trees: int, leaf: int, seed: int = SEED) -> Forest:
    """Fit a forest whose leaves hold at most ``leaf`` sample rows."""
    rng = np.random.default_rng(seed)
    planes, cuts, left, right, roots = [], [], [], [], []
    leaves = 0
    for _ in range(trees):
        todo = [(np.arange(len(sample)), None, 0)]
        while todo:
            rows, parent, side = todo.pop()
            here = None
            if len(rows) > leaf:
                a, b = rng.choice(rows, 2, replace=False)
                plane = sample[a].astype(np.float64) - sample[b]
                size = np.linalg.norm(plane)
                if size > 0:
                    plane /= size
                    along = sample[rows] @ plane
                    cut = float(np.median(along))
                    low = along < cut
                    if 0 < low.sum() < len(rows):
                        here = len(planes)
                        planes.append(plane)
                        cuts.append(cut)
                        left.append(0)
                        right.append(0)
                        todo += [(rows[low], here, 0), (rows[~low], here, 1)]
            if here is None:
                here = ~leaves
                leaves += 1
            if parent is None:
                roots.append(here)
            else:
                (left if side == 0 else right)[parent] = here
    dims = sample.shape[1] if sample.ndim == 2 else 0
    return Forest(np.array(planes, np.float64).reshape(len(planes), dims), np.array(cuts), np.array(left, np.int64),
                  np.array(right, np.int64), np.array(roots, np.int64), leaves)


def leaves_of(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """(rows, trees) leaf numbers."""
    out = np.empty((len(vectors), len(forest.roots)), np.int64)
    for t, root in enumerate(forest.roots):
        node = np.full(len(vectors), root, np.int64)
        while (inner := np.flatnonzero(node >= 0)).size:
            at = node[inner]
            low = np.einsum("ij,ij->i", vectors[inner], forest.planes[at]) < forest.cuts[at]
            node[inner] = np.where(low, forest.left[at], forest.right[at])
        out[:, t] = ~node
    return out


def levels(forest: Forest) -> list[np.ndarray]:
    """Inner nodes of all trees, by depth."""
    out, node = [], forest.roots[forest.roots >= 0]
    while len(node):
        out.append(node)
        node = np.concatenate([forest.left[node], forest.right[node]])
        node = node[node >= 0]
    return out


def walk(forest: Forest, sizes: np.ndarray, margins: np.ndarray, enough: float, by_depth: list[np.ndarray]) -> list[np.ndarray]:
    """Leaves of each query, taken as by one queue over all trees until they hold ``enough`` rows.

    ``margins``: (queries, inner nodes) signed distances to the planes.  A node costs its parent's
    sum of squared margins, and on the side away from the query that of the parent, too; the queue
    would give the leaves in the order of these costs, so they are summed for all of them at once.
    """
    margins = np.ascontiguousarray(margins.T)
    inner, cost = np.zeros(margins.shape), np.zeros((forest.leaves, margins.shape[1]))
    least = np.finfo(np.float64).tiny
    for node in by_depth:
        m, near = margins[node], inner[node]
        far, low = near + np.maximum(m * m, least), m < 0  # on a plane, too, the query's side is first
        for child, bound in ((forest.left[node], np.where(low, near, far)), (forest.right[node], np.where(low, far, near))):
            leaf = child < 0
            inner[child[~leaf]] = bound[~leaf]
            cost[~child[leaf]] = bound[leaf]
    used = np.flatnonzero(sizes)
    rows, out = sizes[used], []
    if not len(used):
        return [used] * margins.shape[1]
    for own in np.ascontiguousarray(cost[used].T):
        most = 64 + int(2 * enough / rows.mean())
        while True:  # the nearest leaves first; more of them where those are small
            at = np.sort(np.argpartition(own, most)[:most]) if most < len(own) else np.arange(len(own))
            at = at[np.argsort(own[at], kind="stable")]
            held = np.cumsum(rows[at])
            if held[-1] >= enough or len(at) == len(own):
                break
            most *= 2
        out.append(used[at[: np.searchsorted(held, enough) + 1]])
    return out


def _vectors(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float32)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _lists(values: np.ndarray, kind) -> pa.Array:
    n, d = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(values.reshape(-1), kind))


def _classes(keep: int):
    """Equal vectors of a batch, with the smallest ids of each."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vec")) + np.float32(0)  # -0.0 and 0.0 are equal
            ids = np.asarray(batch.column("id"))
            keys = vectors.view(np.dtype((np.void, vectors.shape[1] * 4))).reshape(-1)
            _, first, group = np.unique(keys, return_index=True, return_inverse=True)
            order = np.lexsort((ids, group))
            cuts = np.searchsorted(group[order], np.arange(len(first) + 1))
            lists = [np.unique(ids[order[a:b]])[:keep].tolist() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [_lists(vectors[first], pa.float32()), pa.array([x[0] % 64 for x in lists], pa.int32()),
                 pa.array(lists, pa.list_(pa.int64()))], names=["vec", "salt", "ids"])
    return run


def valid(vectors: DataFrame, vec_id: str, vec: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    base = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).cast("array<float>").alias("vec"))
    limit = F.lit(float("inf"))
    good = (F.col("id").isNotNull() & F.col("vec").isNotNull()
            & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
            & F.exists("vec", lambda x: x != 0))
    base = base.filter(F.coalesce(good, F.lit(False)))
    common = base.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return base.filter(F.size("vec") == (common[0]["d"] if common else 0))


def _index(shared, salts, buckets: int):
    """Rows (bucket, cell, names, vecs): the classes of a batch in a cell, one after the other."""
    def run(batches):
        forest, (parts, sides) = Forest(*shared.value), salts.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vec"))
            hashes = np.asarray(batch.column("hash"))
            names = np.stack([np.asarray(batch.column("cid")), hashes], 1)
            leaf = leaves_of(forest, vectors.astype(np.float64))
            row, leaf = np.repeat(np.arange(len(leaf)), leaf.shape[1]), leaf.reshape(-1)
            part = hashes[row] % parts[leaf]
            many = sides[leaf]  # a copy for each part of the queries
            row, leaf, part = (np.repeat(x, many) for x in (row, leaf, part))
            side = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            cell = _cell(leaf, part, side)
            yield _grouped(cell, row, names, vectors, ["bucket", "cell"], [cell % buckets, cell])
    return run


def _cell(leaf, part, side) -> np.ndarray:
    """One number for a part of a leaf's rows and a part of its queries."""
    h = mix((leaf.astype(np.uint64) << np.uint64(40)) ^ (part.astype(np.uint64) << np.uint64(20)) ^ side.astype(np.uint64))
    return (h >> np.uint64(1)).astype(np.int64)


def _sizes(shared):
    def run(batches):
        forest = Forest(*shared.value)
        total = np.zeros(forest.leaves, np.int64)
        for batch in batches:
            if batch.num_rows:
                leaf = leaves_of(forest, _vectors(batch.column("vec")).astype(np.float64))
                total += np.bincount(leaf.reshape(-1), minlength=forest.leaves)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["leaf", "rows"])
    return run


def _route(shared, sizes, enough: float):
    """Rows (leaf, n, names, vecs): the queries of a batch that take a leaf, one after the other."""
    def run(batches):
        forest = Forest(*shared.value)
        by_depth = levels(forest)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, taken = _vectors(batch.column("vec")), []
            for a in range(0, len(vectors), 16):
                margins = vectors[a: a + 16].astype(np.float64) @ forest.planes.T - forest.cuts
                taken += walk(forest, sizes.value, margins, enough, by_depth)
            row = np.repeat(np.arange(len(taken)), [len(x) for x in taken])
            leaf = np.concatenate(taken)
            yield _grouped(leaf, row, np.asarray(batch.column("id"))[:, None], vectors, ["leaf"], [leaf])
    return run


def _grouped(key, row, names, vectors, labels, keys) -> pa.RecordBatch:
    """One row per key, with the names and vectors of its rows as bytes."""
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=key[order][0] - 1)) if len(key) else order
    ends = np.append(first, len(key)).astype(np.int64)

    def blobs(values):
        width = values.dtype.itemsize * values.shape[1]
        return pa.Array.from_buffers(pa.large_binary(), len(first), [
            None, pa.py_buffer((ends * width).tobytes()), pa.py_buffer(np.ascontiguousarray(values[row[order]]).tobytes())
        ]).cast(pa.binary())
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x[order][first]) for x in keys), pa.array(np.diff(ends), pa.int64()), blobs(names), blobs(vectors)],
        names=[*labels, "n", "names", "vecs"])


def _unpacked(table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the table's row, names, vectors) of all rows packed in a table."""
    n = np.asarray(table.column("n"))
    names = np.frombuffer(b"".join(table.column("names").to_pylist()), np.int64).reshape(-1, width)
    vectors = np.frombuffer(b"".join(table.column("vecs").to_pylist()), np.float32).reshape(len(names), -1)
    return np.repeat(np.arange(table.num_rows), n), names, vectors


def _deal(salts, buckets: int):
    """Queries of each leaf, once for each part of its rows, dealt to parts of their own."""
    def run(batches):
        parts, sides = salts.value
        for batch in batches:
            if not batch.num_rows:
                continue
            at, ids, vectors = _unpacked(batch, 1)
            leaf = np.asarray(batch.column("leaf"))[at]
            many = parts[leaf]
            row = np.repeat(np.arange(len(leaf)), many)
            part = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            side = (mix(ids[row, 0].view(np.uint64)) >> np.uint64(1)).astype(np.int64) % sides[leaf[row]]
            cell = _cell(leaf[row], part, side)
            yield _grouped(cell, row, ids, vectors, ["bucket", "cell"], [cell % buckets, cell])
    return run


def _meet(k: int):
    """Cogrouped by bucket: the k + 1 best classes for each query over the cells of the bucket.

    Only rows that reach a query's bound, the least of its k + 1 best scores so far, are held.  A
    matrix product rounds in its own way, so rows within its rounding below the bound go on to the
    exact score, too; ties there go to the smallest id.
    """
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _best_table(np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.zeros(0), k)
        at, names, vectors = _unpacked(right, 2)
        order, cells = _by_cell(np.asarray(right.column("cell"))[at])
        q_at, q_ids, q_vectors = _unpacked(left, 1)
        q_order, q_cells = _by_cell(np.asarray(left.column("cell"))[q_at])
        ids, asker = np.unique(q_ids[:, 0], return_inverse=True)
        slack = (4 * vectors.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(vectors.astype(np.float64), axis=1).max()
                 * np.linalg.norm(q_vectors.astype(np.float64), axis=1))
        bound = np.full(len(ids), -np.inf)
        order_of, first = np.lexsort((names[:, 1], names[:, 0])), np.zeros(len(names), bool)
        first[1:] = (names[order_of[1:]] != names[order_of[:-1]]).any(axis=1)
        number = np.empty(len(names), np.int64)  # of the class, in the order of the names
        number[order_of] = np.cumsum(first)
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        held, many = [], 0

        def settle():
            nonlocal best, many
            asked, rows = (np.concatenate(x) for x in zip(*held))
            exact = np.concatenate([(vectors[rows[a: a + HELD]].astype(np.float64) * q_vectors[asked[a: a + HELD]]).sum(axis=1)
                                    for a in range(0, len(rows), HELD)])
            fit = exact >= bound[asker[asked]]
            found = asker[asked[fit]], number[rows[fit]], exact[fit]
            best = _best(*(np.concatenate(x) for x in zip(best, found)), k)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(ids)) > k)
            bound[full] = best[2][np.searchsorted(best[0], full, side="right") - 1]
            held.clear()
            many = 0

        begins = np.flatnonzero(np.diff(q_cells, prepend=q_cells[0] - 1))
        for a, b in zip(begins, np.append(begins[1:], len(q_cells))):
            rows = order[np.searchsorted(cells, q_cells[a]): np.searchsorted(cells, q_cells[a], side="right")]
            if not len(rows):
                continue
            vs = vectors[rows].astype(np.float64)
            step = max(1, NEAR // len(rows))
            for c in range(a, b, step):
                asked = q_order[c: min(b, c + step)]
                near = q_vectors[asked].astype(np.float64) @ vs.T
                least = bound[asker[asked]]
                new = np.flatnonzero(np.isneginf(least))
                if len(new) and len(rows) > k:  # a class is once in a cell; one may hold the query alone
                    least[new] = np.partition(near[new], len(rows) - k - 1, axis=1)[:, len(rows) - k - 1]
                    np.maximum.at(bound, asker[asked[new]], least[new] - slack[asked[new]])
                i, j = np.nonzero(near >= (least - slack[asked])[:, None])
                held.append((asked[i], rows[j]))
                many += len(i)
                if many > HELD:
                    settle()
        if held:
            settle()
        row = np.empty(len(names), np.int64)
        row[number] = np.arange(len(names))
        return _best_table(ids[best[0]], names[row[best[1]]], best[2], k)
    return run


def _by_cell(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(cell, kind="stable")
    return order, cell[order]


def _best(query, number, score, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k + 1 best distinct classes of each query, by query and from the best on; ties by their number."""
    order = np.lexsort((number, -score, query))
    query, number, score = query[order], number[order], score[order]
    new = np.ones(len(query), bool)  # a class comes from several trees
    new[1:] = (query[1:] != query[:-1]) | (number[1:] != number[:-1])
    query, number, score = query[new], number[new], score[new]
    first = np.flatnonzero(np.diff(query, prepend=query[0] - 1)) if len(query) else np.zeros(0, np.int64)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return tuple(x[place <= k] for x in (query, number, score))


def _best_table(query, names, score, k: int) -> pa.Table:
    """Rows (query, cids, hashes, scores): the k + 1 best distinct classes of each query, as bytes."""
    names, number = np.unique(names, axis=0, return_inverse=True)
    query, number, score = _best(query, number.reshape(-1), score, k)
    names = names[number]
    first = np.flatnonzero(np.diff(query, prepend=query[0] - 1)) if len(query) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(query))
    return pa.table({
        "query": pa.array(query[first], pa.int64()),
        **{c: pa.array([np.ascontiguousarray(v[a:b]).tobytes() for a, b in zip(first, ends)], pa.binary())
           for c, v in (("cids", names[:, 0]), ("hashes", names[:, 1]), ("scores", score))}})


def _merge(k: int):
    """Rows (query, hits): the k + 1 best classes of each query over all buckets, one row each."""
    def run(batches):
        for batch in batches:
            hits = batch.column("hits")
            n = np.diff(np.asarray(hits.offsets))
            flat = hits.flatten()
            parts = {c: flat.field(c).to_pylist() for c in ("cids", "hashes", "scores")}
            query = np.repeat(np.repeat(np.asarray(batch.column("query")), n), [len(x) // 8 for x in parts["scores"]])
            names = np.stack([np.frombuffer(b"".join(parts[c]), np.int64) for c in ("cids", "hashes")], 1)
            best = _best_table(query, names, np.frombuffer(b"".join(parts["scores"]), np.float64), k)
            size = [len(x) // 8 for x in best.column("scores").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.asarray(best.column("query")), size)),
                 *(pa.array(np.frombuffer(b"".join(best.column(c).to_pylist()), kind))
                   for c, kind in (("cids", np.int64), ("hashes", np.int64), ("scores", np.float64)))],
                names=["query", "cid", "hash", "score"])
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K, trees: int = TREES, vec_id: str = "vec_id",
           vec: str = "embedding", share: float = SEARCH, least: int = SEARCH_LEAST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row of ``queries``, itself excluded."""
    spark = vectors.sparkSession
    local = valid(vectors, vec_id, vec).mapInArrow(_classes(k + 1), BATCH_IDS)
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")
    classes = materialise(local.groupBy("vec", "salt").agg(smallest).groupBy("vec").agg(smallest)
                          .withColumns({"hash": F.xxhash64("vec").bitwiseAND(F.lit((1 << 62) - 1)), "cid": F.col("ids")[0]}))
    n = classes.count()
    share_of = min(1.0, 0.97 * SAMPLE / max(1, n))
    picked = classes.filter(F.col("hash") % (1 << 20) < int(share_of * (1 << 20)) + (share_of == 1.0)).limit(SAMPLE)
    sample = _vectors(picked.orderBy("hash").select("vec").toArrow().column("vec"))
    forest = grow(sample, trees, max(8, LEAF * len(sample) // max(1, n)))
    shared = spark.sparkContext.broadcast(tuple(forest))
    sizes = np.zeros(max(1, forest.leaves), np.int64)
    for row in classes.select("vec").mapInArrow(_sizes(shared), "leaf long, rows long").groupBy("leaf") \
            .agg(F.sum("rows").alias("rows")).collect():  # one row per leaf
        sizes[row["leaf"]] = row["rows"]
    enough = max(least, share * n)
    asked = valid(queries, vec_id, vec).distinct()
    tasks = max(1, shuffle_partitions(spark))
    routes = materialise(asked.repartition(tasks, "id")
                         .mapInArrow(_route(shared, spark.sparkContext.broadcast(sizes), enough),
                                     "leaf long, n long, names binary, vecs binary"))
    asks = np.zeros(len(sizes), np.int64)
    for row in routes.groupBy("leaf").agg(F.sum("n").alias("n")).collect():  # one row per leaf
        asks[row["leaf"]] = row["n"]
    parts, sides = np.maximum(1, -(-sizes // PART)), np.maximum(1, -(-asks // PART))
    salts = spark.sparkContext.broadcast((parts, sides))
    buckets = max(1, -(-int((sizes * sides).sum()) * (sample.shape[1] if n else 0) // BUCKET))
    packed = "bucket long, cell long, n long, names binary, vecs binary"
    index = classes.select("vec", "hash", "cid").mapInArrow(_index(shared, salts, buckets), packed)
    sent = routes.mapInArrow(_deal(salts, buckets), packed)
    met = (sent.groupBy("bucket").cogroup(index.withColumnRenamed("bucket", "b2").groupBy("b2"))
           .applyInArrow(_meet(k), "query long, cids binary, hashes binary, scores binary"))
    # a query has at most as many rows as it took leaves and their parts
    best = (met.groupBy("query").agg(F.collect_list(F.struct("cids", "hashes", "scores")).alias("hits"))
            .mapInArrow(_merge(k), "query long, cid long, hash long, score double"))
    members = classes.select("cid", "hash", "ids")
    rows = (best.join(members, ["cid", "hash"]).select("query", "score", F.explode("ids").alias("vec_id"))
            .filter("vec_id != query"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return (rows.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", "vec_id", "score"))


def query(spark, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))
