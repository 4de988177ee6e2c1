"""Operator 11, URL filters: host-suffix and path-prefix expressions against a rule list. DataFrame functions only.

The host is what stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased (port and user stay in it);
the path is what follows up to ``?``, ``#`` or the end. A rule (host, path, verdict) fits its host and all subdomains where the
URL's path starts with the rule's. Each distinct host and folder of a URL is expanded to its host suffixes times its path
prefixes that end in a slash; a rule's own expression is its host and its path up to the last slash, so any rule that fits
has one of them. Expressions meet on the first ``PREFIX`` hex digits of their SHA-256, are confirmed by the full digest,
and the rule's whole path by comparison. Expressions with more labels or slashes than any rule has can't match and aren't made, so what a
URL expands to is bounded by the rule list and not by the URL. The longest rule wins (host and path together, then
the longer host, then block before allow); a URL that no rule fits gets ``default``.

Pages are never joined with rules: distinct host and folder pairs are, so a host with a third of all pages costs one row a task and
folder. No join names a side to broadcast; Spark broadcasts one that it has measured to be below its threshold.

A null URL, and one without ``://``, has an empty host and path and fits no rule. URLs that repeat are judged alike, page ids
aren't looked at. Rules with a null or empty host, a null path or a null verdict are left out; rules that repeat count once. An empty table
gives no row, an empty rule list ``default`` everywhere. All columns pass through; columns called host, path, rule or
verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import staging

PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules that the query judges by (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _folder(path: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_extract(path, "(?s)^.*/", 0)


def _prefix(path: Column, slashes: Column) -> Column:
    """A path up to so many slashes."""
    return F.when(slashes > 0, F.concat(F.call_function("substring_index", path, F.lit("/"), slashes), F.lit("/"))).otherwise(F.lit(""))


def compiled(rules: DataFrame) -> DataFrame:
    """(short, digest, rule_path, rule, verdict, size, host_size) of ``rules(host, path, verdict)``, each once."""
    clean = rules.filter((F.col("host") != "") & F.col("path").isNotNull() & F.col("verdict").isNotNull()).select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").distinct()
    keyed = clean.withColumn("digest", F.sha2(F.concat("host", _folder(F.col("path"))), 256))
    named = keyed.select(
        F.substring("digest", 1, PREFIX).alias("short"), "digest", F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"), "verdict",
        F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"), (_count(F.col("host"), ".") + 1).alias("labels"), _count(F.col("path"), "/").alias("slashes"),
    )
    return staging.staged(named, "rules")


def _expressions(places: DataFrame, labels: int, slashes: int) -> DataFrame:
    """(host, folder, digest) of every expression of ``places(host, folder)`` with so many labels and slashes at most."""
    host, folder = F.col("host"), F.col("folder")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.lit(labels), _count(host, ".") + 1)), lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.lit(slashes), _count(folder, "/"))), lambda k: _prefix(folder, k))
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.sha2(F.concat(s, p), 256))))
    return places.select("host", "folder", F.explode(both).alias("digest")).withColumn("short", F.substring("digest", 1, PREFIX))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All columns of ``pages``, and host, path, rule (host and path of the one that decides, else null) and verdict."""
    host, path = url_parts(F.col(url))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    mine, mine_path, place, place_path, found = staging.fresh(kept, "host_of", "path_of", "place", "place_path", "found")
    parted = pages.select(*kept, host.alias(mine), path.alias(mine_path))
    listed = compiled(rules)
    most = listed.agg(F.max("labels").alias("labels"), F.max("slashes").alias("slashes")).first()
    named = lambda rule, verdict: (F.col(mine).alias("host"), F.col(mine_path).alias("path"), rule.alias("rule"), verdict.alias("verdict"))
    if most["labels"] is None:
        return parted.select(*kept, *named(F.lit(None).cast("string"), F.lit(default)))

    # What lies behind the last slash that a rule can have decides only through rules with such a rest.
    spots = parted.filter(F.col(mine) != "").select(F.col(mine).alias("host"), F.col(mine_path).alias("path")).distinct()
    spots = staging.staged(spots.withColumn("folder", _prefix(F.col("path"), F.least(F.lit(most["slashes"]), _count(F.col("path"), "/")))), "urls")
    # Staged, so that the joins are of plain exchanges and the rows of a common expression can be split.
    tried = staging.staged(_expressions(spots.select("host", "folder").distinct(), most["labels"], most["slashes"]), "expressions")
    met = tried.join(listed.withColumnRenamed("digest", "rule_digest"), "short").filter("digest = rule_digest")
    met = staging.staged(met.select("host", "folder", "rule_path", "rule", "verdict", "size", "host_size"), "met")
    fits = spots.join(met, ["host", "folder"]).filter(F.startswith("path", "rule_path"))
    order = F.struct("size", "host_size", F.when(F.col("verdict") == "block", 1).otherwise(0).alias("blocks"), "verdict", "rule")
    decided = fits.groupBy("host", "path").agg(F.max(order).alias(found))
    decided = staging.staged(decided.select(F.col("host").alias(place), F.col("path").alias(place_path), found), "decided")
    joined = parted.join(decided, (F.col(mine) == F.col(place)) & (F.col(mine_path) == F.col(place_path)), "left")
    return joined.select(*kept, *named(F.col(found)["rule"], F.coalesce(F.col(found)["verdict"], F.lit(default))))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge the URL of every page."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules).drop("url")


OP11_SQL = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT row_number() OVER () AS i, page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
),
rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(str(r) for r in RULES)}),
fits AS (
  SELECT i, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY i ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS turn
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fits WHERE turn = 1) USING (i)
"""
