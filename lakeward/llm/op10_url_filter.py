"""URL filtering by host-suffix and path-prefix rules (DataFrame functions only).

A rule is a host, a path and a verdict. It fits a URL whose host is the rule's host or a subdomain
of it and whose path starts with the rule's path. Each distinct (host, path) is expanded into its
host suffixes, combined with its path prefixes at the lengths that rules have; an expression's
SHA-256 is equi-joined with the rules on a short hash prefix, the full digest confirms the match,
and the longest rule wins.

Defined edge cases:

* null URL, or one without ``://``: host and path are empty, no rule fits, the default verdict;
* ``http://host`` without a slash: the path is empty, so only a rule with an empty path fits;
* host labels are compared whole (``badexample.net`` is no subdomain of ``example.net``); a
  trailing dot, port or user info is part of the host, nothing is normalised but A-Z;
* rules of equal length: ``block`` wins over ``allow``, then the smaller rule text;
* repeated URLs are judged once and every row gets the verdict;
* an empty table gives an empty result; extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict)
BASE_RULES: list[tuple[str, str, str]] = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

#: Hex digits of the digest that form the join key (4 bytes).
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\x00"), path)


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table (host, path, verdict) from a list."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, default_verdict: str = "allow",
          prefix_digits: int = PREFIX_DIGITS) -> DataFrame:
    """Per page: page_id, host, path, rule (null if none fits), verdict.

    ``rules`` may be as large as any block list: it is joined by an equi-join on the hash prefix.
    Only the distinct lengths of the rules' paths (at most the longest URL's length) are read on the driver.
    """
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = rules.select(
        F.sha2(_expression(F.col("host"), F.col("path")), 256).alias("digest"),
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("rule_verdict"),
        F.length(F.concat("host", "path")).alias("rule_length"),
    ).withColumn("short", F.substring("digest", 1, prefix_digits))
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    cuts = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    expressions = (
        urls.filter("host <> '' or path <> ''").select("host", "path").distinct()
        .select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(F.filter(cuts, lambda n: n <= F.length("path"))).alias("cut"))
        .select("host", "path", F.sha2(_expression(F.col("suffix"), F.expr("left(path, cut)")), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, prefix_digits))
    )
    fitting = expressions.join(ruled.withColumnRenamed("digest", "rule_digest"), "short") \
        .filter(F.col("digest") == F.col("rule_digest"))
    # the longest rule; equal lengths: block first, then the smaller text
    order = F.struct((-F.col("rule_length")).alias("a"), (F.col("rule_verdict") != "block").alias("b"),
                     F.col("rule").alias("c"))
    best = fitting.groupBy("host", "path").agg(F.min(F.struct(order.alias("o"), "rule", "rule_verdict")).alias("w"))
    return urls.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("w.rule").alias("rule"),
        F.coalesce(F.col("w.rule_verdict"), F.lit(default_verdict)).alias("verdict"))
