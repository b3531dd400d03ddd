"""URL rules by host-suffix and path-prefix expressions, looked up by short hash prefixes. DataFrame functions only.

A rule (host, path) fits a URL if the URL's host is the rule's or a subdomain of it and the URL's path starts with the rule's.
Every URL is expanded into the expressions host suffix + path prefix (suffixes at label borders, prefixes that are empty or end
in a slash), no deeper than the deepest rule, which loses nothing. A rule stands under its host and the part of its path up to
the last slash, one of the expressions of every URL that it fits. Expressions meet rules by the first KEY hex digits of their
SHA-256; full digests and the rest of the rule's path are confirmed after that. The longest rule (host and path together) wins,
then the one with the longer host, and where both verdicts stand for one rule the block.

The winner travels as one number from which the rule is rebuilt, so that rows of one URL meet in an aggregation which combines
before its shuffle (by sorting, as the row's own strings go along); its key is the row's number, so no host can be hot there. Rules are broadcast up to MOST_RULES,
beyond that both sides are shuffled by the hash prefix and Spark splits a skewed one.

Edge cases: a null URL or one without `://` has an empty host and path and fits no rule; nor does a rule without a host fit
any. Repeated rows each get a verdict. Without rules every URL gets the default. An empty table gives an empty result. Columns
that are not asked for are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import ascii_lower, broadcast_if_small, written

KEY = 8
MOST_RULES = 200_000
#: The rules that the pages query applies.
PAGE_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _expressions(host: Column, path: Column, labels: int, slashes: int) -> Column:
    """Digests of the expressions of a URL, no deeper than asked for."""
    names, parts = F.split(host, "\\."), F.split(path, "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))), lambda k: F.array_join(F.slice(names, -k, k), "."))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(slashes))), lambda k: F.when(k == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _digest(F.concat(h, p)))))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", keep: list[str] | None = None, default: str = "allow") -> DataFrame:
    """rules: host, path, verdict (allow or block). Returns a row for each row of df: the kept columns (none may be called
    host, path, rule or verdict), host, path, rule (null if none fits) and verdict."""
    keep = keep or []
    if clash := {"host", "path", "rule", "verdict"} & {c.lower() for c in keep}:
        raise ValueError(f"kept columns clash with the result's: {sorted(clash)}")
    indexed = rules.filter("host <> ''").select(ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), (F.col("verdict") == "block").cast("long").alias("block")).distinct()
    entry = F.concat("rule_host", F.regexp_extract("rule_path", "^(?s).*/", 0))
    indexed = written(indexed.withColumn("rule_digest", _digest(entry)).withColumn("rule_key", F.substring("rule_digest", 1, KEY)), "rules")
    deepest = indexed.agg(F.max(F.size(F.split("rule_host", "\\."))), F.max(F.size(F.split("rule_path", "/")) - 1)).first()

    host, path = host_and_path(F.col(url))
    rows = df.select(F.monotonically_increasing_id().alias("row_number"), *keep, host.alias("host"), path.alias("path"))
    found = F.when(F.col("host") != "", _expressions(F.col("host"), F.col("path"), deepest[0] or 1, deepest[1] or 0))
    asked = rows.withColumn("digest", F.explode_outer(found)).withColumn("key", F.substring("digest", 1, KEY))
    fits = (F.col("key") == F.col("rule_key")) & (F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")
    met = asked.join(broadcast_if_small(indexed, MOST_RULES), fits, "left")
    # length of host and path, length of host, verdict
    rank = F.shiftleft(F.length("rule_host").cast("long") + F.length("rule_path"), 32) + F.shiftleft(F.length("rule_host").cast("long"), 1) + F.col("block")
    best = met.groupBy("row_number").agg(*(F.any_value(c).alias(c) for c in [*keep, "host", "path"]), F.max(rank).alias("best"))
    total, own = F.shiftright("best", 32).cast("int"), F.shiftright(F.col("best").bitwiseAND(0xFFFFFFFF), 1).cast("int")
    rule = F.concat(F.right("host", own), F.left("path", total - own))
    verdict = F.when(F.col("best").isNull(), default).when(F.col("best") % 2 == 1, "block").otherwise("allow")
    return best.select(*keep, "host", "path", F.when(F.col("best").isNotNull(), rule).alias("rule"), verdict.alias("verdict"))


def page_verdicts(pages: DataFrame) -> DataFrame:
    rules = pages.sparkSession.createDataFrame(PAGE_RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules, keep=["page_id"])


def page_verdicts_sql() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in PAGE_RULES)
    return f"""
    WITH rules(rh, rp, rv) AS (VALUES {values}),
    cut AS (SELECT row_number() OVER () AS rn, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT rn, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    met AS (SELECT p.*, rh, rp, rv, row_number() OVER (PARTITION BY rn ORDER BY length(rh) + length(rp) DESC NULLS LAST, length(rh) DESC, rv DESC) AS k
            FROM parts p LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
    SELECT page_id, host, path, rh || rp AS rule, coalesce(rv, 'allow') AS verdict FROM met WHERE k = 1"""
