"""Lattice language model against enumerated segmentations and plain counts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from tidemart.llm import lattice_lm as lm

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("row", T.StringType()),
                       T.StructField("word", T.StringType())])


def ways(word: bytes, weight: dict[bytes, float]):
    """(product of weights, pieces) of every segmentation."""
    if not word:
        return [(1.0, [])]
    out = []
    for n in range(1, len(word) + 1):
        if word[:n] in weight:
            out += [(weight[word[:n]] * p, [word[:n], *rest]) for p, rest in ways(word[n:], weight)]
    return out


@pytest.fixture(scope="module")
def small():
    names = [bytes([b]) for b in range(256)] + [b" a", b"ab", b"abc", b" ab", b"bc", "é".encode(), "cé".encode(), b" abcab"]
    weights = np.random.default_rng(1).uniform(0.5, 3, len(names))
    pieces = lm.pieces_of(names, np.log(weights))
    return pieces, dict(zip(names, weights / weights.sum()))


def test_marginals_sum_all_segmentations(small):
    pieces, weight = small
    words = [b"a", b"abc", b"abcabc", "abcé".encode(), b"x", b"abcababcab", b"", "éé".encode()]
    found = lm.log10_marginals(pa.array(words), pieces)
    for w, got in zip(words, found):
        assert got == pytest.approx(math.log10(sum(p for p, _ in ways(b" " + w, weight))), abs=1e-9)


def test_marginals_do_not_depend_on_batches(small, monkeypatch):
    rng = random.Random(2)
    words = pa.array([bytes(rng.choices(b"abcx\xc3\xa9", k=rng.randint(0, 12))) for _ in range(200)])
    whole = lm.log10_marginals(words, small[0])
    monkeypatch.setattr(lm, "LATTICE", 1)
    assert np.allclose(whole, lm.log10_marginals(words, small[0]))
    assert np.allclose(whole[50:90], lm.log10_marginals(words.slice(50, 40), small[0]))


def test_expected_use_of_pieces(spark, small):
    pieces, weight = small
    words = ["abc", "abcab", "x", "cabab"]
    df = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    use = Counter()
    for w in words:
        found = ways(b" " + w.encode(), weight)
        total = sum(p for p, _ in found)
        for p, names in found:
            use.update({n: 0 for n in names})
            for n in names:
                use[n] += p / total
    got = lm.learn_pieces(df, pieces, rounds=1)
    norm = sum(use.values()) + lm.ALPHA * len(pieces.hash)
    for name in weight:
        at = np.searchsorted(pieces.hash, lm._rolled(name)[-1])
        assert math.exp(got.logp[at]) == pytest.approx((use[name] + lm.ALPHA) / norm, rel=1e-9)


def made(n=120):
    rng = random.Random(4)
    words = {"en": ["the", "And", "of", "shore", "tide"], "fr": ["le", "la", "é", "Marée", "mer"], None: ["x1", "y", "the"]}
    rows = [(None, None, "en", "", ""), (None, "the tide", "en", "", ""), (5, "", "fr", "", ""), (5, "", "fr", "", "")]
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", None])
        text = " ".join(rng.choices(words[lang], k=rng.randint(1, 30))) + (f"\n w{i}" if i % 3 == 0 else "")
        rows.append((i, text, lang, "r", "w"))
    return rows


def plain_base(rows):
    words = [[w for w in (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()] + [None]
             for _, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, *_ in rows]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for ws in words]


@pytest.mark.parametrize("top,components", [(1 << 19, 8), (3, 2), (0, 1)])
def test_base_counts_and_scores(spark, top, components):
    rows = made()
    df = spark.createDataFrame([(*r,) for r in rows], SCHEMA)
    model = lm.fit(df, ~lm.held_out(), top=top, components=components, rounds=1)
    out = lm.score(df, model).collect()
    key = lambda x: tuple(x)
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in out)
    want = sorted((i is None, i, a, b, c, round(d, 8)) for (i, *_), (a, b, c, d) in zip(rows, plain_base(rows)))
    assert sorted(map(str, got)) == sorted(map(str, want)) and key
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_broadcast_and_joined_words_score_alike(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    scores = []
    for top in (1 << 19, 2, 0):
        out = lm.score(df, lm.fit(df, ~lm.held_out(), top=top, rounds=1)).collect()
        scores.append(sorted((str(r.doc_id), r.n_tokens, round(r.score, 7)) for r in out))
    assert scores[0] == scores[1] == scores[2]


def test_score_is_the_stated_mixture(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    model = lm.fit(df, ~lm.held_out(), rounds=1)
    words = {bytes(r.word): r for r in model.words.collect()}
    k = len(model.docs)
    for r, text in [(x, x.text) for x in df.filter("text IS NOT NULL").limit(15).collect()]:
        tokens = text.lower().encode().split()
        marginal = 10 ** lm.log10_marginals(pa.array(tokens, pa.binary()), model.pieces)
        total = []
        for i in range(k):
            s = math.log10(model.docs[i] / model.docs.sum()) + math.log10((model.docs[i] + 1) / (model.tokens[i] + 2))
            for w, m in zip(tokens, marginal):
                c = words[w][f"c{i}"]
                s += math.log10((max(c - model.discount[i], 0) + (model.discount[i] * model.types[i] + 1) * m) / (model.tokens[i] + 2))
            total.append(s)
        want = max(total) + math.log10(sum(10 ** (s - max(total)) for s in total))
        got = lm.score(df.filter(F.col("doc_id").eqNullSafe(r.doc_id) & (F.col("text") == text)), model).first().score
        assert got == pytest.approx(want, abs=1e-7)


def test_texts_never_seen_and_long_words(spark):
    df = spark.createDataFrame([(6, "zebra " + "q" * 50_000, "en", "", "")] + made(10), SCHEMA)
    model = lm.fit(df.filter("doc_id != 6 OR doc_id IS NULL"), ~lm.held_out(), rounds=1)
    out = lm.score(df, model).filter("doc_id = 6 AND n_tokens = 3").first()
    assert math.isfinite(out.score) and out.score < -10_000


def test_empty_table_and_no_training_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert lm.score(empty, lm.fit(empty, ~lm.held_out(), rounds=1)).collect() == []
    df = spark.createDataFrame(made(5), SCHEMA)
    out = lm.score(df, lm.fit(df, F.lit(False), rounds=1)).collect()
    assert len(out) == 9 and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and r.score < 0 for r in out)
