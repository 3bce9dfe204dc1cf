"""URL rules found through their rarest literal token (native DataFrame operations only).

A rule is a pattern with literal text. Every alphanumeric run of that text which is
bounded on both sides must appear as a whole token in each url that the pattern
matches. Rules are indexed by the one of their tokens that is rarest among the urls; a
url's tokens fetch the rules indexed by them, and only for those pairs a regular
expression runs. Rules without such a token are indexed by the empty token, which every
url has, so none is lost.

Two kinds of rules: host rules (``example.net/en/``: the host and its subdomains, paths
that start with the rule's) outrank patterns (``*`` stands for any text, a leading ``|``
for the start of the host). Among host rules the longest wins, ties by name; likewise
among patterns. A url that no rule matches is allowed.

Defined results: a null url or one without ``://`` has an empty host and path and is
allowed by default; repeated rows are judged each; other columns are carried along (own
ones named like a result column are replaced);
empty tables and an empty list of rules are fine.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bounded_broadcast, keep, table

#: The index of rules is broadcast up to this many rows; beyond, the join is shuffled.
MAX_BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    host_rule: bool


def _bounded_tokens(literal: str, start: bool, end: bool) -> list[str]:
    """Alphanumeric runs of ``literal`` with a boundary inside it (or at an anchored end)."""
    found = []
    for m in re.finditer("[A-Za-z0-9]+", literal):
        if (m.start() > 0 or start) and (m.end() < len(literal) or end):
            found.append(m.group().translate(str.maketrans(UPPER, LOWER)))
    return found


def _quoted(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/ ])", r"\\\1", literal)


def host_rule(action: str, name: str) -> Rule:
    """``host/path``: the host and all subdomains, paths starting with ``/path``."""
    host, slash, path = name.partition("/")
    regex = f"^(?:[^/?#]*\\.)?{_quoted(host + slash + path)}"
    return Rule(name, action, regex, tuple(_bounded_tokens(host + slash + path, True, False)), True)


def pattern_rule(action: str, name: str) -> Rule:
    """Literal text with ``*`` wildcards, anywhere in host, path and query; ``|`` anchors it."""
    anchored = name.startswith("|")
    parts = name.removeprefix("|").split("*")
    regex = ("^" if anchored else "") + "[\\s\\S]*".join(map(_quoted, parts))
    tokens = [t for k, p in enumerate(parts) for t in _bounded_tokens(p, anchored and k == 0, False)]
    return Rule(name, action, regex, tuple(tokens), False)


# The host rules asked for.
HOST_RULES = [
    host_rule("block", "net/"),
    host_rule("allow", "example.net/en/"),
    host_rule("block", "example.com/de/"),
    host_rule("allow", "org/fr/"),
]
#: Pages that repeat others or carry no prose.
PATTERN_RULES = [
    pattern_rule("block", "?utm_source="),
    pattern_rule("block", "/login/"),
    pattern_rule("block", "/cart/"),
    pattern_rule("block", "/ads/*/banner/"),
    pattern_rule("block", "|ads."),
]


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, everything from the host on), empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    lowered = F.translate(host, UPPER, LOWER)
    return lowered, F.regexp_extract(tail, "^[^?#]*", 0), F.concat(lowered, tail)


def _tokens(full: Column) -> Column:
    """Distinct tokens of a url, and the empty one."""
    runs = F.split(F.translate(full, UPPER, LOWER), "[^a-z0-9]+")
    return F.array_distinct(F.concat(runs, F.array(F.lit(""))))


def rule_index(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule, keyed by its token that is rarest among ``urls`` (url, full)."""
    spark = urls.sparkSession
    schema = "rule string, action string, pattern string, literals array<string>, tier int, weight int"
    rows = [(r.name, r.action, r.regex, list(r.tokens), int(r.host_rule), len(r.name)) for r in rules]
    literals = (spark.createDataFrame(rows, schema)
                .withColumn("token", F.explode(F.when(F.size("literals") > 0, F.col("literals")).otherwise(F.array(F.lit(""))))))
    wanted = keep(literals.select("token").distinct(), "urlrules-literals")
    seen = (urls.select(F.explode(_tokens(F.col("full"))).alias("token"))
            .join(bounded_broadcast(wanted, MAX_BROADCAST_RULES), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    counted = literals.join(seen, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = F.min(F.struct("n", (-F.length("token")).alias("short"), "token")).alias("x")
    return (counted.groupBy("rule", "action", "pattern", "tier", "weight").agg(rarest)
            .select("rule", "action", "pattern", "tier", "weight", F.col("x.token").alias("token")))


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the winning host rule), pattern (else the winning
    pattern) and verdict. Every distinct url is judged once.
    """
    host, path, full = host_and_path(F.col("url"))
    urls = pages.select(F.col(f"`{url_col}`").alias("url")).where(F.instr("url", "://") > 0).distinct().withColumn("full", full)
    index = keep(rule_index(urls, rules), "urlrules-index")
    candidates = urls.withColumn("token", F.explode(_tokens(F.col("full")))).join(
        bounded_broadcast(index, MAX_BROADCAST_RULES), "token")
    best = F.max(F.struct("tier", "weight", "rule", "action")).alias("best")
    judged = keep(candidates.where(F.rlike("full", F.col("pattern"))).groupBy("url").agg(best), "urlrules-judged")
    judged = judged.select(F.col("url").alias("_judged_url"), F.col("best").alias("_judged_best"))
    own_host, own_path, _ = host_and_path(F.col(f"`{url_col}`"))
    return (
        pages.withColumn("host", own_host).withColumn("path", own_path)
        .join(judged, F.col(f"`{url_col}`") == F.col("_judged_url"), "left")
        .withColumn("rule", F.when(F.col("_judged_best.tier") == 1, F.col("_judged_best.rule")))
        .withColumn("pattern", F.when(F.col("_judged_best.tier") == 0, F.col("_judged_best.rule")))
        .withColumn("verdict", F.coalesce("_judged_best.action", F.lit("allow")))
        .drop("_judged_url", "_judged_best")
    )


# ---------------------------------------------------------------- query
def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, HOST_RULES + PATTERN_RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")


_ORACLE = f"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
      regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path, substr(rest, length(raw) + 1) AS tail FROM h),
r AS (SELECT *, CASE
      WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p),
m AS (SELECT *, CASE WHEN rule IS NOT NULL THEN NULL
      WHEN regexp_matches(host || tail, '/ads/(.|\\n)*/banner/') THEN '/ads/*/banner/'
      WHEN contains(host || tail, '?utm_source=') THEN '?utm_source='
      WHEN contains(host || tail, '/login/') THEN '/login/'
      WHEN contains(host || tail, '/cart/') THEN '/cart/'
      WHEN starts_with(host || tail, 'ads.') THEN '|ads.' END AS pattern FROM r)
SELECT page_id, host, path, rule, pattern,
       CASE WHEN rule IN ('net/', 'example.com/de/') OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict FROM m"""

QUERIES = {"op5_url_rules": op5_url_rules}
ORACLE = {"op5_url_rules": _ORACLE}
