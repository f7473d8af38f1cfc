"""URL filters by host-suffix and path-prefix expressions.

A rule is a host and a path; it fits its host, all subdomains, and every path that begins with its
own.  Each URL is expanded into the expressions that could be such a rule (the host suffixes and
path prefixes of the lengths that rules have).  Expressions and rules meet on the first four bytes
of their SHA-256, full digests confirm the match, and the longest rule decides.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)
#: The verdict of a URL that no rule fits.
DEFAULT = "allow"
#: Hexadecimal digits of a digest that expressions are joined on.
PREFIX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(verdict, host, path) of the rules."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule (its host and path, else null) and verdict.

    Of rules of equal length, blocking ones win.  Null and malformed urls have an empty host and
    path and get the default verdict, as all do under an empty rule table.  Urls of any length are
    expanded as far as rules go.  Repeated pages come out as often as they came in; other columns are
    ignored; without pages there are no rows.
    """
    hashed = rules.filter(F.col("host").isNotNull()).select(
        F.concat("host", F.coalesce("path", F.lit(""))).alias("rule"), "verdict",
        F.size(F.split("host", r"\.")).alias("labels"), F.length(F.coalesce("path", F.lit(""))).alias("depth"),
    )
    # a shape is a number of labels and a length of a path, so there are few even of very many rules
    shapes = [[s["labels"], s["depth"]] for s in hashed.select("labels", "depth").distinct().collect()]
    hashed = hashed.withColumn("rule_digest", F.sha2("rule", 256)).withColumn("prefix", F.substring("rule_digest", 1, PREFIX))
    url = F.col("url").cast("string")
    parsed = pages.select(F.monotonically_increasing_id().alias("nth"), F.col("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))}).withColumn("parts", F.split("host", r"\."))
    listed = F.transform(
        F.filter(F.from_json(F.lit(json.dumps(shapes)), "array<array<int>>"), lambda s: (s[0] <= F.size("parts")) & (s[1] <= F.length("path"))),
        lambda s: F.concat(F.array_join(F.slice("parts", -s[0], s[0]), "."), F.substring(F.col("path"), F.lit(1), s[1])),
    )
    probes = parsed.select("nth", "page_id", "host", "path", F.explode_outer(listed).alias("expression"))
    probes = probes.withColumn("digest", F.sha2("expression", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX))
    met = probes.join(hashed.select("prefix", "rule_digest", "rule", "verdict"), "prefix", "left")
    fits = F.when(F.col("digest") == F.col("rule_digest"), F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("blocks"), "rule", "verdict"))
    best = met.groupBy("nth").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max(fits).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"))
