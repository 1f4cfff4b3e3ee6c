"""Rounds of contraction end with the stars, without one more to see that nothing changes."""

import random

from tidemart.llm import components as C


def plain(edges):
    group = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    return {(x, g) for x, g in group.items() if x != g}


def test_components_are_those_of_a_plain_search(spark):
    rng = random.Random(8)
    for nodes, links in ((200, 90), (200, 260), (60, 59)):
        edges = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(links)]
        if links == 59:  # a path
            edges = [(i, i + 1) for i in range(links)]
        got = C.components(spark.createDataFrame(edges, C.EDGES).repartition(7))
        assert {tuple(r) for r in got.collect()} == plain(edges)
        assert got.count() == len(plain(edges))


def test_stars_take_no_round(spark, monkeypatch):
    def none(edges, large):
        raise AssertionError("a round of stars")
    monkeypatch.setattr(C, "_star", none)
    edges = spark.createDataFrame([(9, 1), (8, 1), (7, 2)], C.EDGES).coalesce(1)
    assert sorted(tuple(r) for r in C.components(edges).collect()) == [(7, 2), (8, 1), (9, 1)]
    assert C.components(edges.limit(0)).count() == 0


def test_what_is_settled(spark):
    def settled(*edges):
        return C._settled(spark.createDataFrame(list(edges), C.EDGES))
    assert settled((3, 1), (4, 1), (5, 2))
    assert not settled((3, 1), (3, 2))
    assert not settled((3, 2), (2, 1))
