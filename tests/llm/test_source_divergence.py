"""Source divergence against plain Python integers."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from tidemart.llm import source_divergence as sd

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("lang", "source", "text", "term", "shard")])


def plain(rows, min_docs=10, top=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, groups = Counter(), Counter(), set()
    for lang, source, text, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.add((lang, source))
        docs.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= min_docs]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(of):
            n = [sum(counts[lang, s, t] for s in of) for t in kept]
            return [(c, 1 + 1_000_000_000 * (c + 2) // (sum(n) + 2 * len(kept))) for c in n]
        own, q = {s: shares([s]) for s in sources}, shares(sources)

        def apart(a, b):
            return (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(apart(a[1], b[1]) for a, b in zip(own[s], own[o])), o) for o in sources if o != s]
            terms = [(apart(a[1], b[1]), t) for t, a, b in zip(kept, own[s], q) if a[0] > 0 and a[1] > b[1]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def made(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ab", "Cé", "zz", "ß", "qu") for b in "abcdefgh"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, "x"])
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", None, ""])
        text = rng.choice([None, "", " 12 ..", " ".join(rng.choices(words, k=rng.randint(1, 60)))] + [" ".join(rng.choices(words[:9], k=20)) + "!x_y"] * 4)
        rows.append((lang, source, text, "t", "s"))
    return rows


def same(spark, rows, **more):
    out = sd.audit(spark.createDataFrame(rows, SCHEMA), **more)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in out.collect()) == plain(rows, **more)


def test_against_plain_integers(spark):
    same(spark, made(1, 400))
    same(spark, made(2, 60), min_docs=2, top=3)


def test_many_shards_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(sd, "SHARD", 7)
    same(spark, made(3, 200))


def test_no_kept_terms_ties_and_long_text(spark):
    same(spark, [("en", "a", "one two", "", ""), ("en", "b", "one", "", ""), ("en", "c", None, "", ""), ("de", "a", "x", "", "")])
    same(spark, [("en", s, w, "", "") for s, w in (("a", "b1 c1"), ("b", "c b"), ("c", "z")) for _ in range(12)])  # ties
    same(spark, [("en", "a", "word " * 300_000, "", ""), ("en", "b", "x" * 1_000_000, "", "")] + [("en", "b", "word x", "", "")] * 12)


def test_empty_table(spark):
    assert sd.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_are_exact_for_large_counts():
    rng = random.Random(5)
    for _ in range(200):
        total = rng.randrange(1, 9 * 10 ** 15)
        count, terms = rng.randrange(total + 1), rng.randrange(1, 10 ** 9)
        assert int(sd.share(np.array([count]), total, terms)[0]) == 1 + 1_000_000_000 * (count + 2) // (total + 2 * terms)


def test_partial_counts_flush_and_merge(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(sd, "FLUSH", 20)
    rows = [(a or "", b or "", c or "") for a, b, c, *_ in made(6, 300)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r)) for r in rows[i: i + 30]]) for i in range(0, 300, 30)]
    total = Counter()
    for out in sd._partial(batches):
        for r in out.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
    expect = Counter()
    for lang, source, text in rows:
        expect.update((lang, source, t.lower()) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text))
    assert {k: v for k, v in total.items() if k[2] is not None} == dict(expect)
