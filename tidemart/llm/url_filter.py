"""URL filter: weighted vocabulary counted by Aho-Corasick, under host and path rules.

Every term of the vocabulary that occurs in the lower-cased URL between boundaries (no
ASCII letter or digit beside it) counts once with its weight.  Strict terms alone reach
``reject_at``; soft terms only together.  A rule of allow or block for a host and its
subdomains, whose path begins the URL's path, decides before the vocabulary; the longest
fitting rule wins.

Edge cases: a NULL URL or one without ``://`` has an empty host and path, fits no rule and
is judged by the vocabulary alone (NULL: allow); repeated rows are judged each; an empty
table gives an empty result; other columns of the table are ignored.  The vocabulary and
the rules are parameters held by the driver, so both are broadcast with the function.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frames import read

STRICT = ("adult", "casino", "casinos", "cialis", "escort", "escorts", "hentai", "malware", "milf", "phishing",
          "porn", "porno", "spam", "viagra", "warez", "webcams", "xxx")
SOFT = ("ads", "adserver", "affiliate", "banner", "bet", "bets", "betting", "bonus", "buy", "cams", "cash", "cheap",
        "click", "coupon", "crack", "dating", "deals", "discount", "free", "gambling", "hot", "jackpot", "keygen",
        "loan", "loans", "lottery", "money", "nude", "pharmacy", "pills", "poker", "popup", "prize", "promo",
        "replica", "sex", "sexy", "slots", "torrent", "track", "tracker", "tracking", "win", "winner")
REJECT_AT = 2
VOCABULARY = {**{t: REJECT_AT for t in STRICT}, **{t: 1 for t in SOFT}}
#: (verdict, host and path)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
SCHEMA = "page_id long, host string, path string, rule string, verdict string, n_strict long, n_soft long"
_LOWER = {i: i + 32 for i in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL: host after the first ``://``, A-Z lower-cased."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for end in "?#":
        rest = rest.split(end, 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def fitting_rule(host: str, path: str, by_host: dict) -> tuple[str, str] | None:
    """Longest rule for the host or a parent domain whose path begins ``path``."""
    best = None
    while host:
        for verdict, rule, prefix in by_host.get(host, ()):
            if path.startswith(prefix) and (best is None or len(rule) > len(best[1])):
                best = (verdict, rule)
        host = host.partition(".")[2]
    return best


def _rules(rules) -> dict:
    by_host: dict[str, list] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        by_host.setdefault(host, []).append((verdict, rule, slash + path))
    return by_host


def found_terms(url: str, automaton) -> set[str]:
    """Distinct terms between boundaries."""
    def apart(i: int) -> bool:
        return not (0 <= i < len(url) and url[i].isascii() and url[i].isalnum())
    return {t for end, t in automaton.iter(url) if apart(end + 1) and apart(end - len(t))}


def _judge(vocabulary: dict, rules, reject_at: int):
    def run(batches):
        automaton = ahocorasick.Automaton()
        for term in vocabulary:
            automaton.add_word(term, term)
        automaton.make_automaton()
        by_host = _rules(rules)
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                rule = fitting_rule(host, path, by_host)
                terms = found_terms((url or "").translate(_LOWER), automaton) if vocabulary else set()
                weight = sum(vocabulary[t] for t in terms)
                strict = sum(vocabulary[t] >= reject_at for t in terms)
                rows.append((host, path, rule and rule[1],
                             rule[0] if rule else "block" if weight >= reject_at else "allow",
                             strict, len(terms) - strict))
            kinds = (pa.string(),) * 4 + (pa.int64(),) * 2
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(list(c), k) for c, k in zip(cols, kinds))],
                names=["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"])
    return run


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", vocabulary: dict | None = None,
          rules=RULES, reject_at: int = REJECT_AT) -> DataFrame:
    """Host, path, rule and verdict of every row; narrow, one pass."""
    vocabulary = VOCABULARY if vocabulary is None else vocabulary
    return (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"))
            .mapInArrow(_judge(dict(vocabulary), tuple(rules), reject_at), SCHEMA))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages"))


def _sql() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)
    terms = ", ".join(f"('{t}', {w})" for t, w in VOCABULARY.items())
    return f"""
WITH p AS (
  SELECT page_id, {lower.format("coalesce(url, '')")} AS u,
         {lower.format("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")} AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, rule, host, prefix) AS (VALUES {rules}),
terms(term, weight) AS (VALUES {terms}),
judged AS (
  SELECT p.*, (SELECT struct_pack(rule := r.rule, verdict := r.verdict) FROM rules r
               WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.prefix)
               ORDER BY length(r.rule) DESC LIMIT 1) AS fit,
         (SELECT count(*) FROM terms t WHERE weight >= {REJECT_AT}
            AND regexp_matches(p.u, '(^|[^a-z0-9])' || t.term || '($|[^a-z0-9])')) AS n_strict,
         (SELECT count(*) FROM terms t WHERE weight < {REJECT_AT}
            AND regexp_matches(p.u, '(^|[^a-z0-9])' || t.term || '($|[^a-z0-9])')) AS n_soft
  FROM p)
SELECT page_id, host, path, fit.rule AS rule,
       coalesce(fit.verdict, CASE WHEN n_strict >= 1 OR n_soft >= {REJECT_AT} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft
FROM judged
"""


SQL = _sql()
