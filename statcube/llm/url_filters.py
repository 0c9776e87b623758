"""URL filters by pattern rules that are indexed by their rarest literal token; DataFrame operations only.

A rule is a regular expression on host and path, with the literal tokens that any match must hold. Each rule is filed
under the one of its tokens that is rarest in the given URLs. A URL is cut into tokens; those
that occur in the index fetch their rules, and only these run their expression. Rules without a literal
token run on every URL. Up to ``INLINE_TOKENS`` index tokens the index is a constant of the projection, so
nothing is shuffled or joined; beyond that, hits are joined with the index table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statcube.llm.shared import Query, table
from statcube.sources.scratch import materialize

INLINE_TOKENS = 256
_SPLIT = r"[^a-z0-9]+"
_RULE = "struct<kind:int,size:int,rule:string,pattern:string,verdict:string>"


@dataclass(frozen=True)
class UrlRule:
    """``kind`` 0: host and path rule, wins over all patterns; 1: pattern. The longest rule of a kind wins."""

    rule: str
    pattern: str
    verdict: str
    tokens: tuple[str, ...]
    kind: int = 1


def host_rule(verdict: str, host: str, path: str) -> UrlRule:
    """Fits a host and its subdomains where the path starts with the rule's."""
    # A token counts only if it stands between separators, so that a match holds it in full.
    tokens = re.split(_SPLIT, host.lower())
    tokens += re.split(_SPLIT, path.lower())[:-1]
    pattern = r"^(?:[^/]*\.)?" + re.escape(host.lower()) + re.escape(path)
    return UrlRule(host + path, pattern, verdict, tuple(t for t in tokens if t), 0)


def word_rule(verdict: str, word: str) -> UrlRule:
    """Fits a word of host or path that stands between separators."""
    word = word.lower()
    return UrlRule(word, rf"(?i)(?:^|[^a-z0-9]){re.escape(word)}(?:[^a-z0-9]|$)", verdict, tuple(t for t in re.split(_SPLIT, word) if t))


HOST_RULES = (
    host_rule("block", "net", "/"),
    host_rule("allow", "example.net", "/en/"),
    host_rule("block", "example.com", "/de/"),
    host_rule("allow", "org", "/fr/"),
)
BLOCKED_WORDS = ("adult", "ads", "ads-track", "bet", "casino", "casino-win", "gambling", "porn", "poker", "spam", "track", "warez", "xxx")
WORD_RULES = tuple(word_rule("block", w) for w in BLOCKED_WORDS)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty without ``://`` or without a URL."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _described(rule: UrlRule) -> Column:
    return F.struct(
        F.lit(rule.kind).alias("kind"),
        F.lit(-len(rule.rule)).alias("size"),
        F.lit(rule.rule).alias("rule"),
        F.lit(rule.pattern).alias("pattern"),
        F.lit(rule.verdict).alias("verdict"),
    )


def rarest_tokens(urls: DataFrame, rules: Sequence[UrlRule]) -> dict[UrlRule, str | None]:
    """The token of each rule that the fewest URLs hold (ties: alphabetical), counted over all URLs.

    ``urls`` has ``__tokens``. What comes to the driver is a count per token of the rules.
    """
    literal = sorted({t for r in rules for t in r.tokens})
    counts = {}
    if literal:
        hits = urls.select(F.explode(F.array_intersect("__tokens", F.array(*map(F.lit, literal)))).alias("t"))
        counts = {r[0]: r[1] for r in hits.groupBy("t").count().collect()}
    return {r: min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None) for r in rules}


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    identifier: str = "page_id",
    url: str = "url",
    default: str = "allow",
    inline_tokens: int = INLINE_TOKENS,
) -> DataFrame:
    """id, ``host``, ``path``, ``rule`` (host and path rule that decides, else NULL), ``pattern_rule`` and ``verdict``, per row of ``pages``.

    Rules of kind 0 come first, then patterns, then the default; of several that fit, the longest wins, then the first
    in the alphabet. A missing URL, or one without ``://``, has an empty host and path and gets the default
    unless a pattern fits the empty text. Rows are kept one by one, repeated ids too; no other column is read.
    """
    host, path = url_parts(F.col(url))
    urls = pages.select(F.col(identifier).alias("__id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("__tokens", F.array_distinct(F.split(F.lower(F.concat("host", "path")), _SPLIT)))
    rules = sorted(set(rules), key=lambda r: (r.kind, r.rule, r.verdict))
    place = rarest_tokens(urls, rules)
    index: dict[str, list[UrlRule]] = {}
    for rule, token in place.items():
        if token is not None:
            index.setdefault(token, []).append(rule)
    always = [_described(r) for r, token in place.items() if token is None]
    everywhere = F.array(*always).cast(f"array<{_RULE}>")
    subject = F.concat("host", "path")
    fits = lambda r: F.regexp_like(subject, r["pattern"])

    if len(index) <= inline_tokens:
        candidates = everywhere
        if index:
            hits = F.array_intersect("__tokens", F.array(*map(F.lit, index)))
            pairs = [x for t, held in index.items() for x in (F.lit(t), F.array(*map(_described, held)).cast(f"array<{_RULE}>"))]
            lookup = F.create_map(*pairs)
            candidates = F.concat(F.flatten(F.transform(hits, lambda t: F.element_at(lookup, t))), everywhere)
        judged = urls.withColumn("__fit", F.array_min(F.filter(candidates, fits)))
    else:
        spark = pages.sparkSession
        rows = [(t, r.kind, -len(r.rule), r.rule, r.pattern, r.verdict) for t, held in index.items() for r in held]
        table_ = spark.createDataFrame(rows, "t string, kind int, size int, rule string, pattern string, verdict string")
        # Written once, as the numbers must not change between the two uses.
        numbered = materialize(urls.withColumn("__row", F.monotonically_increasing_id()), "urls")
        found = (
            numbered.select("__row", "host", "path", F.explode("__tokens").alias("t"))
            .join(table_, "t")
            .filter(F.regexp_like(F.concat("host", "path"), F.col("pattern")))
            .groupBy("__row")
            .agg(F.min(F.struct("kind", "size", "rule", "pattern", "verdict").cast(_RULE)).alias("__indexed"))
        )
        judged = numbered.join(found, "__row", "left").withColumn(
            "__fit", F.array_min(F.filter(F.concat(F.filter(everywhere, fits), F.array("__indexed")), lambda x: x.isNotNull()))
        )
    fit = F.col("__fit")
    return judged.select(
        F.col("__id").alias(identifier),
        "host",
        "path",
        F.when(fit["kind"] == 0, fit["rule"]).alias("rule"),
        F.when(fit["kind"] == 1, fit["rule"]).alias("pattern_rule"),
        F.coalesce(fit["verdict"], F.lit(default)).alias("verdict"),
    )


def op10(spark, folder):
    return judge_urls(table(spark, folder, "pages"), HOST_RULES + WORD_RULES)


_WORDS_BY_LENGTH = sorted(BLOCKED_WORDS, key=lambda w: (-len(w), w))
OP10_SQL = f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), ruled AS (
  SELECT *,
    CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    CASE {" ".join(f"WHEN regexp_matches(host || path, '(?i)(^|[^a-z0-9]){w}([^a-z0-9]|$)') THEN '{w}'" for w in _WORDS_BY_LENGTH)} END AS word
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NULL THEN word END AS pattern_rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

QUERIES: dict[str, tuple[Query, str | None]] = {"op10_url_filters": (op10, OP10_SQL)}
