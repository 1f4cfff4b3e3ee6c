"""Source divergence audit: how far the term distributions of a language's sources lie apart.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased.  Arrow kernels do
the counting inside mapInArrow: ascii_lower, split_pattern_regex, dictionary_encode and two
hash group_bys turn a slice of texts into partial counts per (language, source, term), which a
task merges before Spark sums them.  A language keeps the terms of at least ``min_docs`` of its
documents.  The kept counts are dealt by term into columnar shards; a shard holds all counts of
its terms, adds up the divergence of every two sources over them and finds its best terms of
each source, so that only sums per pair and ``top`` terms per source leave it.

All arithmetic is in integers: with N the group's kept occurrences and V the kept terms, a
term seen c times has p = 1 + floor(SCALE * (c + 2) / (N + 2 * V)), and two shares p, q have
the divergence floor((p - q)**2 / (p + q)).  Counts up to 9 * 10**15 are exact.

Bounds: a slice is 8 MB of text or one text; a task merges its counts whenever they exceed
``FLUSH`` rows; a shard has about ``SHARD`` rows, or the square of the number of sources if that
is more (at most 2**21), whatever share of the corpus its language or source has.  The pairs of a
language are part of the result: their number is the square of its sources.

Edge cases: NULL text, language or source count as ''; a text without terms still makes its group
known; a language without kept terms gives its pairs the value 0 and no terms; a language of one
source has no pairs; repeated rows count as documents of their own; ties rank by the item's UTF-8 bytes;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .frames import materialise, read
from .words import slices

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
FLUSH = 1 << 19
SHARD = 1 << 15
SMALL = 100_000  # languages up to which their totals are broadcast (under 10 MB)
SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
COUNTS = "lang string, source string, term string, n long, docs long"
KEYS = ["lang", "source", "term"]


def _count(part: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents per (lang, source, term) of a slice; one row without term per group."""
    groups = pa.table([part.column("lang"), part.column("source")], names=["lang", "source"])
    distinct = groups.group_by(["lang", "source"], use_threads=False).aggregate([])
    none = pa.table([distinct.column("lang"), distinct.column("source"), pa.nulls(distinct.num_rows, pa.string()),
                     pa.array(np.zeros(distinct.num_rows, np.int64)), pa.array(np.zeros(distinct.num_rows, np.int64))],
                    names=[*KEYS, "n", "docs"])
    pieces = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), SEPARATOR)
    terms, rows = pieces.flatten(), pc.list_parent_indices(pieces)
    real = pc.greater(pc.binary_length(terms), 0)
    coded = terms.filter(real).dictionary_encode()
    once = (pa.table([rows.filter(real), coded.indices], names=["row", "code"])
            .group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")]))
    of_row = _codes(groups)
    summed = (pa.table([pc.take(of_row, once.column("row")), once.column("code"), once.column("count_all")],
                       names=["group", "code", "n"])
              .group_by(["group", "code"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")]))
    first = np.unique(of_row.to_numpy(zero_copy_only=False), return_index=True)[1]
    at = pc.take(pa.array(first, pa.int64()), summed.column("group"))
    found = pa.table([pc.take(part.column("lang"), at), pc.take(part.column("source"), at),
                      pc.take(coded.dictionary, summed.column("code")), summed.column("n_sum"), summed.column("count_all")],
                     names=[*KEYS, "n", "docs"])
    return pa.concat_tables([none, found])


def _codes(groups: pa.Table) -> pa.Array:
    """Number of each row's (lang, source)."""
    lang = groups.column("lang").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    source = groups.column("source").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return pa.array(np.unique(lang * (len(source) + 1) + source, return_inverse=True)[1].astype(np.int64))


def _merge(tables: list[pa.Table]) -> pa.Table:
    both = (pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]))
    return both.select([*KEYS, "n_sum", "docs_sum"]).rename_columns([*KEYS, "n", "docs"])


def _partial(batches):
    held, rows = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            held.append(_count(part))
            rows += held[-1].num_rows
            if rows > FLUSH and len(held) > 1:
                held = [_merge(held)]
                rows = held[0].num_rows
                if rows > FLUSH // 2:
                    yield from held.pop().to_batches()
                    rows = 0
    if held:
        yield from _merge(held).to_batches()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; each group has one row of term NULL, too."""
    given = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k)
                          for k, c in (("lang", lang), ("source", source), ("text", text))))
    return (given.mapInArrow(_partial, COUNTS).groupBy(*KEYS)
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: np.ndarray, total, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), by long division in steps of 1000."""
    divisor = np.asarray(total, np.int64) + 2 * np.int64(terms)
    left, out = np.asarray(count, np.int64) + 2, np.int64(0)
    out, left = left // divisor, left % divisor
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // divisor, left % divisor
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(top: int):
    """Cogroup function: counts of a shard's terms and all groups of its language to sums and best terms."""
    def run(key, counts: pa.Table, groups: pa.Table) -> pa.Table:
        names = groups.column("source").combine_chunks()
        totals = groups.column("group_n").to_numpy()
        kept, lang_n = groups.column("terms")[0].as_py(), groups.column("lang_n")[0].as_py()
        size = len(names)
        sums = np.zeros((size, size), np.int64)
        best = []
        if counts.num_rows:
            row = pc.index_in(counts.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False).astype(np.int64)
            coded = counts.column("term").combine_chunks().dictionary_encode()
            terms = coded.dictionary
            by_bytes = np.empty(len(terms), np.int64)  # place of a term in the order of UTF-8 bytes
            by_bytes[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(terms))
            column = by_bytes[coded.indices.to_numpy(zero_copy_only=False)]
            n = counts.column("n").to_numpy()
            order = np.argsort(column, kind="stable")
            row, column, n = row[order], column[order], n[order]
            together = np.zeros(len(terms), np.int64)
            np.add.at(together, column, n)
            of_lang = share(together, lang_n, kept)
            unseen = share(np.zeros(size, np.int64), totals, kept)
            own = share(n, totals[row], kept)
            step = max(1, (1 << 20) // size)
            for lo in range(0, len(terms), step):
                a, b = np.searchsorted(column, (lo, lo + step))
                dense = np.repeat(unseen[:, None], min(step, len(terms) - lo), 1)
                dense[row[a:b], column[a:b] - lo] = own[a:b]
                for i in range(size - 1):
                    sums[i, i + 1:] += _apart(dense[i + 1:], dense[i]).sum(1)
            above = np.flatnonzero((n > 0) & (own > of_lang[column]))
            value = _apart(own[above], of_lang[column[above]])
            order = np.lexsort((column[above], -value, row[above]))
            above, value = above[order], value[order]
            first = np.searchsorted(row[above], row[above])
            near = np.arange(len(above)) - first < top
            above, value = above[near], value[near]
            back = np.empty(len(terms), np.int64)
            back[by_bytes] = np.arange(len(terms))
            best = [(names.take(pa.array(row[above])), terms.take(pa.array(back[column[above]])), value)]
        i, j = np.triu_indices(size, 1)
        parts = [("pair", names.take(pa.array(i)), names.take(pa.array(j)), sums[i, j])] + [("term", *x) for x in best]
        return pa.concat_tables([pa.table(
            [pa.array([key[0].as_py()] * len(v), pa.string()), s.cast(pa.string()), pa.array([part] * len(v), pa.string()),
             t.cast(pa.string()), pa.array(v, pa.int64())], names=["lang", "source", "part", "item", "value"])
            for part, s, t, v in parts])
    return run


def _totals(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept counts, groups with their kept occurrences, languages with their totals and shards)."""
    known = counts.filter(F.col("term").isNotNull())
    terms = known.groupBy("lang", "term").agg(F.sum("docs").alias("d")).filter(F.col("d") >= min_docs)
    kept = materialise(known.join(terms, ["lang", "term"], "left_semi").select(*KEYS, "n"))
    groups = (counts.filter(F.col("term").isNull()).select("lang", "source")
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("n", F.lit(0)).alias("group_n")))
    sizes = kept.groupBy("lang", "term").agg(F.count("*").alias("rows")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("rows").alias("rows"))
    langs = (groups.groupBy("lang").agg(F.count("*").alias("sources"), F.sum("group_n").alias("lang_n"))
             .join(sizes, "lang", "left"))
    room = F.least(F.greatest(F.col("sources") * F.col("sources"), F.lit(SHARD)), F.lit(1 << 21))
    langs = langs.select("lang", "lang_n", F.coalesce("terms", F.lit(0)).alias("terms"),
                         F.greatest(F.lit(1), F.ceil(F.col("rows") / room)).cast("int").alias("shards"))
    return kept, materialise(groups), materialise(langs)


def divergences(counts: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources and each source's ``top`` terms."""
    kept, groups, langs = _totals(materialise(counts), min_docs)
    if langs.count() <= SMALL:
        langs = F.broadcast(langs)
    # a language's totals go to its counts, not its counts to one task: broadcast, or a join that adaptive execution splits
    dealt = kept.join(langs.select("lang", "shards"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "source", "term", "n")
    there = groups.join(langs, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", "group_n", "terms", "lang_n")
    found = materialise(dealt.groupBy("lang", "shard").cogroup(there.groupBy("lang", "shard"))
                        .applyInArrow(_shard(top), "lang string, source string, part string, item string, value long"))
    pairs = (found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
             .select("lang", "part", "value", F.explode(F.array(
                 F.struct(F.col("source"), F.col("item")),
                 F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"))
             .select("lang", "x.source", "part", "x.item", "value"))
    both = pairs.unionByName(found.filter("part = 'term'"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return (both.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top))
            .select("lang", "source", "part", "item", "value", "rank"))


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """Divergences of the sources of ``docs`` in each language."""
    return divergences(term_counts(docs, text, lang, source), min_docs, top)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM occ GROUP BY ALL HAVING count(*) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, k.term, CAST(coalesce(o.n, 0) AS HUGEINT) AS n, k.n AS lang_count
         FROM grp g JOIN kept k ON g.lang = k.lang
         LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM occ GROUP BY ALL) o
           ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
tot AS (SELECT lang, source, sum(n) AS group_n, count(*) AS v FROM cell GROUP BY ALL),
ltot AS (SELECT lang, sum(n) AS lang_n, count(*) AS v FROM kept GROUP BY ALL),
p AS (SELECT c.lang, c.source, c.term, c.n,
             1 + (1000000000 * (c.n + 2)) // CAST(t.group_n + 2 * t.v AS HUGEINT) AS p,
             1 + (1000000000 * (c.lang_count + 2)) // CAST(l.lang_n + 2 * l.v AS HUGEINT) AS q
      FROM cell c JOIN tot t ON c.lang = t.lang AND c.source = t.source JOIN ltot l ON c.lang = l.lang),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM both_parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
