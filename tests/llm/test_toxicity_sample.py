"""FTRL-proximal against a plain per-coordinate version, and the bounds of its sample."""

import math
import random

import numpy as np
import pyarrow as pa

from tidemart.llm import toxicity

VOCAB = [f"w{i}" for i in range(200)]


def plain_ftrl(samples, labels):
    """Weights by slot and the intercept, one coordinate at a time as the method is published."""
    seen = {}
    for s in samples:
        for x in s:
            seen[x] = seen.get(x, 0) + 1
    prior = (sum(labels) + toxicity.PRIOR) / (len(labels) + 1)
    base = math.log(prior / (1 - prior))
    z, n, bias = {}, {}, [0.0, 0.0]

    def weight(x):
        if abs(z.get(x, 0.0)) <= toxicity.L1:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n[x])) / toxicity.ALPHA + toxicity.L2
        return -(z[x] - math.copysign(toxicity.L1, z[x])) / rate
    rng = np.random.default_rng(toxicity.SEED)
    for _ in range(toxicity.EPOCHS):
        for i in rng.permutation(len(samples)):
            at = [x for x in samples[i] if seen[x] > 1]
            b = -bias[0] / ((toxicity.BETA + math.sqrt(bias[1])) / toxicity.ALPHA)
            p = 1 / (1 + math.exp(-sum(map(weight, at)) - b - base))
            g = p - labels[i]
            for x in at:
                w, old = weight(x), n.get(x, 0.0)
                z[x] = z.get(x, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * w
                n[x] = old + g * g
            bias = [bias[0] + g - (math.sqrt(bias[1] + g * g) - math.sqrt(bias[1])) / toxicity.ALPHA * b, bias[1] + g * g]
    return ({x: weight(x) for x in z if weight(x)},
            base - bias[0] / ((toxicity.BETA + math.sqrt(bias[1])) / toxicity.ALPHA))


def texts(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = rng.choices(VOCAB, k=rng.randint(3, 25))
        out.append((i, " ".join(words + ["vile"] * (i % 3 == 0)), int(i % 3 == 0)))
    return out


def test_training_is_plain_ftrl():
    rows = texts(300, 4)
    row, slot, n = toxicity.features(pa.array([t for _, t, _ in rows]))
    samples = [np.unique(slot[row == i]).astype(np.uint32) for i in range(n)]
    labels = np.array([y for *_, y in rows], float)
    slots, weights, bias = toxicity.train(samples, labels)
    want, intercept = plain_ftrl([s.tolist() for s in samples], labels.tolist())
    assert want and set(slots.tolist()) == set(want) and abs(bias - intercept) < 1e-9
    assert all(abs(w - want[s]) < 1e-5 for s, w in zip(slots.tolist(), weights.tolist()))


def test_sample_is_bounded_in_texts_and_slots_whatever_the_layout(spark):
    rows = texts(120, 5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    table = spark.createDataFrame([r[:2] for r in rows] + [rows[0][:2]] * 40 + [(1, "another text of the id")] * 3,
                                  "doc_id long, text string")

    def taken(parts, **bounds):
        return {r.doc_id: bytes(r.slots) for r in toxicity.sample(table.repartition(parts), labels, **bounds).collect()}
    whole = taken(1)
    assert toxicity.sample(table, labels).count() == len(whole) <= 120
    assert whole.keys().isdisjoint(r.doc_id for r in table.filter(toxicity.held_out("doc_id")).collect())
    few = taken(7, max_train=30)
    assert len(few) == 30 and few == taken(2, max_train=30) and few.items() <= whole.items()
    small = taken(5, max_slots=900)
    assert small == taken(3, max_slots=900) and 700 < sum(len(s) // 4 for s in small.values()) <= 900
    assert taken(2, max_slots=0) == {} and toxicity.fit(table, labels, max_slots=0)[2] < 0


def test_a_text_beyond_the_bound_leaves_room_for_the_others():
    sizes = pa.table({"doc_id": [5, 6, 7, 8], "place": [3, 1, 2, 1], "n": [4, 9, 100, 0]})
    assert toxicity._fitting(sizes, 13) == [6, 8, 5]
