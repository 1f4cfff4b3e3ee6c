"""Operators against brute force over small tables with NULLs, ties, repeats and clashing names."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemart.llm import (ann_forest, components, decontaminate, html_text, jaccard_join, license_scan, line_dedup,
                          packing, substring_dedup, toxicity, url_filter)

VOCAB = [f"w{i}" for i in range(4000)]
LOWER = {i: i + 32 for i in range(65, 91)}
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, doc long, tie long, k string"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def corpus() -> list[tuple]:
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choices(VOCAB, k=n))
    base, passage = prose(120), prose(55)
    docs = [(i, "\n".join(prose(rng.randint(8, 30)) for _ in range(rng.randint(1, 5)))) for i in range(30)]
    for i in range(30, 42):  # near copies of one text
        words = base.split()
        for j in rng.sample(range(120), rng.randint(0, 4)):
            words[j] = rng.choice(VOCAB)
        docs.append((i, " ".join(words)))
    docs += [(i, f"{prose(20)} {passage} {prose(25)}") for i in range(42, 50)]  # a passage that documents share
    docs += [(i, base) for i in range(50, 60)]                                 # exact copies
    docs += [(60, None), (61, ""), (62, "  \n\t "), (63, "one two"), (64, "one two"), (65, "w " * 90),
             (66, prose(20_000)), (None, f"null id {passage}"), (67, "Héé © ÉÈ\u00a0x"), (68, base.upper()),
             (69, "twice here " + prose(30)), (69, "twice here " + prose(30))]
    docs += [(3, docs[3][1])]  # a repeated row
    return docs


DOCS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None, None if t is None else len(t), 1, 2, 3, "k") for i, t in DOCS]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def key(x):
    return tuple((v is None, v) for v in x)


def test_decontamination_counts_flags_and_removes(spark, docs, none):
    items = [(1, " ".join(DOCS[45][1].split()[22:50])), (2, "One, TWO!"), (3, None), (4, "..."), (10, "one two"),
             (None, "w w w"), (1, " ".join(DOCS[45][1].split()[22:50])), (7, "absent words " * 9)]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    grams = set()
    for i, t in items:
        w = split(t)
        grams |= {(i, tuple(w[j:j + min(10, len(w))])) for j in range(max(1, len(w) - 9)) if w}
    want = []
    for d, t in DOCS:
        w, hit, found = split(t), set(), set()
        for i, g in grams:
            for j in range(len(w) - len(g) + 1):
                if tuple(w[j:j + len(g)]) == g:
                    hit |= set(range(j, j + len(g)))
                    found.add(i)
        names = sorted(str(i) for i in found if i is not None)
        want.append((d, len(w), len(hit), len(names), sha(",".join(names)), bool(hit)))
    assert sum(x[5] for x in want) >= 10
    for most in (1_000_000, 4):  # one block, and several
        got = [tuple(r) for r in decontaminate.flag(docs, bench, max_windows=most).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    kept = decontaminate.remove(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == sorted((w[0] is None, w[0]) for w in want if not w[5])
    cut = {r.doc_id: r.text for r in decontaminate.remove(docs, bench, spans=True).collect()}
    assert cut[63].strip() == "" and cut[60] is None and cut[5] == DOCS[5][1] and len(cut) == len({d for d, _ in DOCS})
    assert decontaminate.flag(none, bench).count() == 0
    assert decontaminate.flag(docs, bench.limit(0)).filter("contaminated").count() == 0


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def groups(sets):
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def test_jaccard_join_components(docs, none):
    sets = [shingles(t) for _, t in DOCS]
    of = groups(sets)
    least = {}
    for (d, _), g in zip(DOCS, of):
        least.setdefault(g, []).append(d)
    name = {g: None if None in x else min(x) for g, x in least.items()}
    want = [(d, len(s), name[g]) for (d, _), s, g in zip(DOCS, sets, of)]
    assert sum(len(x) > 1 for x in least.values()) >= 3
    got = [tuple(r) for r in jaccard_join.link(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    empty = sum(not s for s in sets)
    assert kept.count() == len({g for g, s in zip(of, sets) if s}) + empty
    assert jaccard_join.link(none).count() == 0 and jaccard_join.keep_first(none).count() == 0


def test_trie_join_matches_set_arithmetic():
    rng = random.Random(3)
    for _ in range(60):
        probe = sorted(rng.sample(range(60), rng.randint(1, 40)))
        sets = []
        for _ in range(rng.randint(0, 25)):
            s = set(rng.sample(probe, int(len(probe) * rng.uniform(.6, 1)))) | set(rng.sample(range(60), rng.randint(0, 6)))
            sets.append(sorted(s or {1}))
        sets.sort()
        want = [i for i, s in enumerate(sets) if 100 * len(set(s) & set(probe)) >= 80 * len(set(s) | set(probe))]
        arrays = [np.array(s, np.uint64) for s in sets]
        assert jaccard_join.trie_join(np.array(probe, np.uint64), arrays, 80, step=rng.choice([1, 3, 32])) == want


def test_components_of_paths_stars_and_repeats(spark):
    rng = random.Random(8)
    nodes = list(range(0, 4000, 3))
    rng.shuffle(nodes)
    edges = [(a, b) for a, b in zip(nodes[:300], nodes[1:300])] + [(nodes[400], x) for x in nodes[401:700]] \
        + [(nodes[700], nodes[700]), (nodes[701], nodes[702]), (nodes[702], nodes[701])]
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    for group in (nodes[:300], nodes[400:700], nodes[701:703]):
        assert {got.get(x, x) for x in group} == {min(group)}
    assert nodes[700] not in got
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_substring_dedup_removes_all_but_the_first(docs, none):
    # documents in the order of the operator: NULL id first, texts under one id by their hash
    ties = {t: h for t, h in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    count = {}
    for d, _ in DOCS:
        count[d] = count.get(d, 0) + 1
    place = lambda d, t: (-1 if d is None else d, ties[t] if count[d] > 1 else 0)
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for d, t in DOCS:
        w = split(t)
        for i in range(len(w) - 19):
            g, at = tuple(w[i:i + 20]), (*place(d, t), i)
            first[g] = min(first.get(g, at), at)
    want = []
    for d, t in DOCS:
        w, gone = split(t), set()
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] != (*place(d, t), i):
                gone |= set(range(i, i + 20))
        want.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    assert sum(x[2] > 0 for x in want) > 25
    got = [tuple(r) for r in substring_dedup.dedup(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert substring_dedup.dedup(none).count() == 0


def line_words(x):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower())


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distance_matches_dynamic_programming():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert line_dedup.edit_distance(a, b) == plain_distance(a, b)


def test_line_dedup_keeps_the_first_of_each_group(spark, none):
    rng = random.Random(4)
    line = lambda n=40: " ".join(rng.choices(VOCAB, k=n))
    base = [line() for _ in range(6)]

    def near(x):
        words = x.split()
        words[rng.randrange(len(words))] = rng.choice(VOCAB)
        return " ".join(words)
    rows = [(i, "\n".join([line(), rng.choice(base), near(rng.choice(base)), "short line", "", line(12)])) for i in range(40)]
    rows += [(50, base[0].upper() + "!!"), (51, None), (52, ""), (53, "\n\n"), (None, base[1]), (54, line(3000)),
             (5, rows[5][1])]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, line int, id string").repartition(4)
    found = []  # distinct lines in the order of their first occurrence
    seen: dict = {}
    order = sorted({((-1 if d is None else d), t or "") for d, t in rows})
    for d, t in order:
        for n, x in enumerate(t.split("\n")):
            w = line_words(x)
            if len(w) >= 5 and tuple(w) not in seen:
                seen[tuple(w)] = len(found)
                found.append(tuple(w))
    parent = list(range(len(found)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(found)):
        for j in range(i):
            a, b = found[i], found[j]
            longest = max(len(a), len(b))  # every two lines within the distance are joined
            if 100 * abs(len(a) - len(b)) <= 20 * longest and 100 * plain_distance(a, b) <= 20 * longest:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    assert sum(parent[i] != i for i in range(len(found))) > 15
    kept, want = set(), {}
    for d, t in order:
        rest = []
        for n, x in enumerate(t.split("\n")):
            w = tuple(line_words(x))
            g = root(seen[w]) if w in seen else None
            if g is None or g not in kept:
                rest.append(x)
            kept.add(g)
        want[d, t] = "\n".join(rest)
    got = [tuple(r) for r in line_dedup.dedup(table).collect()]
    expect = [(d, len(t.split("\n")) if t else 0, len((t or "").split("\n")) - len(want[-1 if d is None else d, t or ""].split("\n"))
               if want[-1 if d is None else d, t or ""] or not t or "\n" in t else 1, sha(want[-1 if d is None else d, t or ""]))
              for d, t in rows]
    assert sorted((g[0] is None, g[0] or 0, g[3]) for g in got) == sorted((e[0] is None, e[0] or 0, e[3]) for e in expect)
    cleaned = line_dedup.clean(table)
    assert cleaned.columns == table.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in cleaned.collect()) == \
        sorted((d is None, d or 0, want[-1 if d is None else d, t or ""]) for d, t in rows)
    assert line_dedup.dedup(none).count() == 0


def test_boundaries_have_the_least_padding():
    rng = random.Random(6)
    from itertools import combinations
    for _ in range(25):
        histogram = {n: rng.randint(1, 9) for n in rng.sample(range(1, 30), rng.randint(1, 8))} | {0: 4}
        lengths = sorted(k for k in histogram if k)
        cost = lambda cuts: sum(histogram[n] * (min(c for c in cuts if c >= n) - n) for n in lengths)
        k = rng.randint(1, 4)
        best = min(cost([*c, lengths[-1]]) for c in combinations(lengths[:-1], min(k, len(lengths)) - 1))
        cuts = packing.boundaries(histogram, k)
        assert cost(cuts) == best and len(cuts) <= k
    assert packing.boundaries({}) == [] and packing.boundaries({0: 3}) == []


def test_packing_keeps_every_word_within_the_budget(docs, none):
    rows = packing.pack(docs, max_len=64, n_buckets=4, budget=256, with_text=True).collect()
    whole = {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append((r.piece, r.first_word, r.n_tokens, r.text))
    for d, t in DOCS:
        if d in (3, 69):
            continue
        pieces = sorted(whole[d])
        words = (t or "").split() if d != 67 else re.findall(r"[^\x20\x09-\x0D]+", t)
        assert " ".join(p[3] for p in pieces).split() == " ".join(words).split()
        assert sum(p[2] for p in pieces) == len(words) and [p[0] for p in pieces] == list(range(len(pieces)))
    assert len(whole[3]) == 2 * len({p[0] for p in whole[3]})
    batches = {}
    for r in rows:
        if r.n_tokens == 0:
            assert r.bucket_len is None and r.batch is None and r.slot is None
            continue
        assert 0 < r.n_tokens <= r.bucket_len
        batches.setdefault((r.bucket_len, r.batch), []).append(r.slot)
    for (length, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and (len(slots) * length <= 256 or len(slots) == 1)
    assert packing.pack(none).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<float>, leaf int, rank int")


def test_forest_finds_exact_neighbours_with_ties(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(50)]  # a vector that many share
    bad = [(300, None), (301, [0.0] * 8), (302, [1.0] * 7 + [None]), (303, [float("nan")] + [1.0] * 7),
           (304, [float("inf")] * 8), (305, [1.0, 2.0]), (306, []), (None, rows[0][1])]
    table = vectors(spark, rows + bad + [rows[3]])
    got = {}
    for r in ann_forest.search(table, table.filter(F.col("vec_id") % 20 == 0)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v = {i: np.array(x, np.float32).astype(np.float64) for i, x in rows}
    assert set(got) == {i for i in v if i % 20 == 0}
    for q, found in got.items():
        want = sorted((-float((v[i] * v[q]).sum()), i) for i in v if i != q)[:20]
        assert [(k + 1, i) for k, (_, i) in enumerate(want)] == [x[:2] for x in sorted(found)]
        assert all(math.isclose(x[2], -s, rel_tol=1e-12, abs_tol=1e-12) for x, (s, _) in zip(sorted(found), want))
    few = vectors(spark, rows[:3])
    assert ann_forest.search(few, few.filter("vec_id = 0")).count() == 2
    nothing = vectors(spark, bad[:1])
    assert ann_forest.search(nothing, nothing).count() == 0


def test_forest_recall_of_the_production_parameters(spark):
    rng = np.random.default_rng(3)  # no clusters: the hardest case for trees
    v = rng.normal(size=(15_000, 64)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    table = spark.createDataFrame(pa.table({"vec_id": pa.array(np.arange(len(v))), "embedding": ann_forest._lists(v, pa.float32())}))
    found = {}
    for r in ann_forest.search(table, table.filter(F.col("vec_id") % 150 == 0)).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q, near in found.items():
        score = v.astype(np.float64) @ v[q].astype(np.float64)
        score[q] = -np.inf
        hits += len(near & set(np.argsort(-score)[:20].tolist()))
        total += 20
    assert total == 2000 and hits / total >= 0.9


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) document.write("</p>")</script></head>
<body class="no-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<!-- ad --><div class="ad">Buy now</div><div id="cookie-notice">We use cookies</div>
<article><header><h1>Title &amp; more</h1></header><p>First&nbsp;paragraph   with <b>bold</b>
text.<p>Second &lt;one&gt;<br>goes on<ul><li>a<li>b</ul><aside>Aside</aside><form><input><button>Send</button></form>
<div class="comments"><p>Reader says</p></div></article><div class="sidebar">Side</div><footer>&copy; 2020</footer>"""


def test_html_article_without_boilerplate():
    assert html_text.main_text(PAGE) == "Title & more\nFirst paragraph with bold text.\nSecond <one> goes on\na\nb"


def test_html_without_article_keeps_the_dense_stretch():
    body = "x" * 60
    page = f"<div>a</div><div></div><div></div><div></div><div><p>{body}</p><p>{body}</p></div><div></div><div></div>" \
           "<div></div><div></div><p>c</p>"
    assert html_text.main_text(page) == f"{body}\n{body}"
    assert html_text.main_text("<p>only a little") == "only a little"
    assert html_text.main_text("plain text") == "plain text"
    assert html_text.main_text("<nav>menu<p>para " + body + body) == "para " + body + body
    assert html_text.main_text("<a 'b <c>d") is not None and html_text.main_text("<!-- open") == ""


def test_html_table(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"),
            (3, "w", "<article>" + "<p>é😀 word</p>" * 20_000 + "</article>", "x")]
    got = [tuple(r) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()]
    text = html_text.main_text(PAGE)
    long = "\n".join(["é😀 word"] * 20_000)
    assert sorted(got, key=key) == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0),
                                                                              (3, "w", long, len(long))], key=key)


def test_toxicity_learns_words_and_ignores_ids(spark, none):
    rng = random.Random(9)
    bad = ["vile", "ÄRGER", "nasty"]
    rows, labels = [], []
    for i in range(500):
        words = rng.choices(VOCAB[:300], k=rng.randint(5, 60))
        toxic = i % 4 == 0
        if toxic:
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    labels += [(1, 0, 0), (None, 1, 1), (2, 1, None), (9999, 1, 1)]
    rows += [(600, None), (601, ""), (None, "vile nasty"), (602, "vile nasty " + " ".join(rng.choices(VOCAB[:300], k=30_000)))]
    table = spark.createDataFrame([(i, t, "y") for i, t in rows], "doc_id long, text string, y string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, known)
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    import zlib
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    held = [i for i in range(500) if got[i].held_out]
    assert sum(got[i].predicted == (i % 4 == 0) for i in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[600].predicted == 0 and got[601].score == got[600].score and got[None].predicted == 1 and not got[None].held_out
    kept = toxicity.remove(table, model)
    assert kept.columns == table.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    nothing = toxicity.fit(table, known.limit(0))
    assert toxicity.score(table, nothing).filter("predicted = 1").count() == 0
    assert toxicity.score(none, model).count() == 0


def test_licenses_by_digest(spark, none):
    mit = "Copyright (c) 2019 Someone\n\n" + license_scan.MIT.lower().replace("and/or", "and / or")
    rows = [(1, mit), (1, mit), (2, "text\nReleased under the MIT Licence!\nmore\nLicensed under CC BY-NC 4.0."), (3, None),
            (4, ""), (5, "(c) 2020 X"), (None, "released under the mit license"), (6, "x " * 200_000)]
    table = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, license string")
    got = sorted((tuple(r) for r in license_scan.scan(table).collect()), key=key)
    want = []
    for i, t in rows:
        lic = {1: "MIT", None: "MIT"}.get(i)
        notes = {2: "CC-BY-NC-4.0,MIT", None: "MIT"}.get(i, "")
        want.append((i, sha(license_scan.normal_text(t)), lic, len(notes.split(",")) if notes else 0, notes))
    assert got == sorted(want, key=key)
    assert got[[r[0] for r in got].index(3)][1] == sha("")
    own = spark.createDataFrame([("A", "x " * 200_000), ("B", ""), (None, "q")], "title string, body string")
    assert [r.license for r in license_scan.scan(table, own, name="title", known_text="body").filter("doc_id = 6").collect()] == ["A"]
    assert license_scan.scan(none).count() == 0


def test_url_rules_and_terms(spark):
    cases = {
        "http://x.com/a": ("x.com", "/a", "com/", "allow"), "HTTP://A.Example.COM/en/x?y": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/1#z": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"), "http://a.net/en/1": ("a.net", "/en/1", None, "allow"),
        "http://notcom/": ("notcom", "/", None, "allow"), "http://x.com": ("x.com", "", None, "allow"),
        "http://x.com?q=/": ("x.com", "", None, "allow"), "http://casino-win.org/": ("casino-win.org", "/", None, "block"),
        "http://free.org/BETS": ("free.org", "/BETS", None, "block"), "http://free.org/free": ("free.org", "/free", None, "allow"),
        "http://casinos2.org/": ("casinos2.org", "/", None, "allow"), "casino": ("", "", None, "block"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "http://a://b.com/": ("a:", "//b.com/", None, "allow"),
        "http://example.org/" + "a" * 100_000: ("example.org", "/" + "a" * 100_000, None, "allow"),
    }
    table = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(table).collect()}
    assert got == dict(enumerate(cases.values()))
    assert url_filter.judge(table, vocabulary={}).filter("verdict = 'block'").count() == 2
