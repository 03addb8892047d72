"""URL filter rules, found through an index of their rarest literal token. DataFrame functions only.

A rule names a host and a path; it fits that host and all its subdomains where the URL's path starts with the rule's.
Every rule is filed under one of the tokens that each fitting URL must hold (a label of the host, or a whole part of the
path): the one that the fewest rules hold. The distinct tokens of each distinct URL fetch the candidate rules from that
index by a join, and only those run their regular expressions. The longest fitting rule decides.

* null URL, or no ``://``: host and path are empty and no rule fits
* of rules of the same length the smaller text decides; of the same text, a block
* repeated URLs are judged once and keep all their rows; extra columns are dropped, so their names cannot clash
* an empty table gives an empty result
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: So many rules are broadcast at most (a rule is a few hundred bytes); a longer list is joined by a shuffle.
BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: Fixed values.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host: Column, path: Column) -> Column:
    """Labels of the host as ``.label`` and the parts of the path that a slash ends as ``/part``; each once."""
    parts = F.split(path, "/", -1)
    whole = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    mark = lambda sign: lambda x: F.concat(F.lit(sign), x)
    return F.array_distinct(F.concat(F.transform(F.split(host, r"\.", -1), mark(".")), F.transform(whole, mark("/"))))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r"([^A-Za-z0-9_/])", r"\\$1")


def index(rules: DataFrame) -> DataFrame:
    """One row per rule (verdict, host, path): its rarest token, its text and its regular expression over host + path."""
    filed = rules.distinct().withColumn("token", F.explode(tokens(F.col("host"), F.col("path"))))
    held = filed.groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", -F.length("token"), "token"))["token"]
    return (
        filed.join(held, "token")
        .groupBy("verdict", "host", "path")
        .agg(rarest.alias("token"))
        .select(
            "token",
            "verdict",
            F.concat("host", "path").alias("rule"),
            F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), _quoted(F.col("host")), _quoted(F.col("path"))).alias("pattern"),
        )
    )


def judge(urls: DataFrame, rules: DataFrame, few_rules: bool, default: str = "allow") -> DataFrame:
    """``urls`` (one column ``url``): a row per distinct URL with host, path, rule, verdict.

    ``few_rules``: the caller knows that the rules are at most ``BROADCAST_RULES``.
    """
    parts = urls.distinct().select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    found = parts.select("url", F.concat("host", "path").alias("whole"), F.explode(tokens(F.col("host"), F.col("path"))).alias("token"))
    filed = index(rules)
    fits = (
        found.join(F.broadcast(filed) if few_rules else filed, "token")
        .where(F.expr("whole rlike pattern"))
        .groupBy("url")
        .agg(F.min(F.struct(-F.length("rule"), "rule", F.col("verdict") != "block", "verdict")).alias("best"))
        .select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return parts.join(fits, "url", "left").select(
        "url", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def filter_pages(spark: SparkSession, pages: DataFrame, rules: Sequence[Rule] = RULES, default: str = "allow") -> DataFrame:
    """All rows of ``pages`` (page_id, url) with host, path, rule and verdict."""
    rows = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in vars(r).items())) for r in rules))
    listed = spark.range(1, numPartitions=1).select(F.inline(rows))
    judged = judge(pages.select("url"), listed, len(rules) <= BROADCAST_RULES, default)
    own = pages.select("page_id", F.col("url").alias("own"))
    return own.join(judged, F.col("own").eqNullSafe(F.col("url"))).drop("own")
