"""Leaves that a query takes: those of one queue over all trees, for many queries at once."""

import heapq

import numpy as np

from tidemart.llm.ann_forest import grow, leaves_of, levels, walk


def _queue(forest, sizes, margin, enough):
    queue = [(0.0, i, int(root)) for i, root in enumerate(forest.roots)]
    taken, rows, ties = [], 0, len(queue)
    while queue and rows < enough:
        bound, _, node = heapq.heappop(queue)
        while node >= 0:
            m = margin[node]
            heapq.heappush(queue, (bound + m * m, ties, int(forest.right[node] if m < 0 else forest.left[node])))
            ties += 1
            node = int(forest.left[node] if m < 0 else forest.right[node])
        if sizes[~node]:
            taken.append(~node)
            rows += sizes[~node]
    return taken


def test_leaves_are_those_of_one_queue():
    v = np.random.default_rng(3).normal(size=(700, 12)).astype(np.float32)
    forest = grow(v[:500], 5, 9)
    sizes = np.bincount(leaves_of(forest, v.astype(np.float64)).reshape(-1), minlength=forest.leaves)
    sizes[::7] = 0  # leaves without rows are not taken
    margins = v[:40].astype(np.float64) @ forest.planes.T - forest.cuts
    for enough in (1, 30, 900, 10_000):
        found = walk(forest, sizes, margins, enough, levels(forest))
        assert [x.tolist() for x in found] == [_queue(forest, sizes, m, enough) for m in margins]


def test_trees_of_one_leaf_and_empty_leaves():
    v = np.ones((4, 3), np.float32)
    forest = grow(v, 2, 8)
    margins = v[:2].astype(np.float64) @ forest.planes.T - forest.cuts
    assert [x.tolist() for x in walk(forest, np.array([4, 4]), margins, 5, levels(forest))] == [[0, 1], [0, 1]]
    assert [x.tolist() for x in walk(forest, np.array([0, 0]), margins, 5, levels(forest))] == [[], []]


def test_walk_takes_no_step_per_node_and_query():
    """A Python step for each node of each path took a fifth of the run: 2,000 calls at most for 16 queries here, whatever the planes."""
    import sys
    v = np.random.default_rng(5).normal(size=(4000, 8)).astype(np.float32)
    forest = grow(v, 8, 8)
    sizes = np.bincount(leaves_of(forest, v.astype(np.float64)).reshape(-1), minlength=forest.leaves)
    margins = v[:16].astype(np.float64) @ forest.planes.T - forest.cuts
    by_depth, calls = levels(forest), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        found = walk(forest, sizes, margins, 8000, by_depth)
    finally:
        sys.setprofile(None)
    assert len(found) == 16 and min(len(x) for x in found) > 500
    assert calls < 2000
