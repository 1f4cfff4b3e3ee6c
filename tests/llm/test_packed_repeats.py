"""Keys that several owners hold, settled from packed rows, against a plain count."""

import numpy as np
import pytest

from tidemart.llm.repeats import PACKED_SCHEMA, packed_rows, repeated_owners
from tidemart.llm.words import mix


@pytest.mark.parametrize("hot", [False, True])
def test_repeated_owners_are_those_of_a_plain_count(spark, hot):
    rng = np.random.default_rng(3)
    key = rng.integers(0, 900, 4000)
    if hot:
        key[::3] = 7
    owner_of = rng.integers(-400, 400, 1000) * (1 << 40)  # a line that repeats has one owner in several rows
    row = rng.integers(0, 1000, 4000)
    want: dict = {}
    for k, r in zip(key.tolist(), row.tolist()):
        want.setdefault(k, set()).add(int(owner_of[r]))
    want = {(k, o) for k, owners in want.items() if len(owners) > 1 for o in owners}
    h = mix(key.astype(np.uint64))
    cuts = [0, 1000, 1000, 2500, 4000]

    def slices(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                at = slice(cuts[i], cuts[i + 1])
                yield packed_rows(h[at], row[at], owner_of, 5)
    got = repeated_owners(spark.range(4).repartition(2).mapInArrow(slices, PACKED_SCHEMA)).distinct().collect()
    back = {int(x >> np.uint64(16)): k for x, k in zip(h, key.tolist())}
    pairs = {(back[r.key], r.node) for r in got}
    assert want <= pairs
    # rows of one owner that meet in one slice are told, too: more than asked for, never less
    assert all(o in {int(owner_of[r]) for r in row[key == k]} for k, o in pairs)
    assert len(pairs) == len(got)


def test_no_keys(spark):
    def none(batches):
        for _ in batches:
            yield packed_rows(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), 3)
    assert repeated_owners(spark.range(3).mapInArrow(none, PACKED_SCHEMA)).count() == 0
