"""URL filters by host-suffix and path-prefix expressions.

A URL expands to every expression (host suffix by labels + path prefix) of a shape that some
rule has; expressions meet rules in an equi-join on a short prefix of their SHA-256, and what
meets is confirmed by the full digest. Of the rules that fit, the longest expression wins; of
equally long ones the longer host, then block before allow.

URLs are expanded once for each distinct host and path, so a URL that a third of the rows share
is expanded once; the verdicts go back by an equi-join that adaptive execution can split.

Defined cases: a null URL or one without ``://`` has an empty host and path, and no rule fits an
empty host; rules with a null host or an unknown verdict are no rules, a null path is the empty
one; no rules at all gives every page the default; repeated pages give repeated results; other
columns are left out.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.llm.frames import lower_ascii

PREFIX = 8          # hex digits of the digest that are joined on
MAX_SHAPES = 4096   # distinct path lengths and label counts taken from the rules; beyond, all


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rules(rules: DataFrame) -> DataFrame:
    text = F.concat("host", "path")
    rules = rules.select(lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.filter((F.col("host") != "") & F.col("verdict").isin("allow", "block"))
    return rules.select(F.sha2(text, 256).alias("digest"), text.alias("rule"), "verdict",
                        F.length(text).alias("size"), F.length("host").alias("host_size"),
                        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_size"))


def expressions(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, digest) of every expression of a shape that occurs among the rules."""
    shapes = {c: [r[0] for r in rules.select(c).distinct().limit(MAX_SHAPES + 1).collect()] for c in ("labels", "path_size")}
    labels = F.split("host", r"\.")

    def sizes(found: list[int], least: int, most: Column) -> Column:
        if len(found) > MAX_SHAPES:
            return F.sequence(F.lit(least), most)
        return F.filter(F.array(*[F.lit(x) for x in sorted(found)]).cast("array<int>"), lambda x: x <= most)

    out = urls.filter(F.col("host") != "")
    out = out.withColumn("_n", F.explode(sizes(shapes["labels"], 1, F.size(labels))))
    out = out.withColumn("_p", F.explode(sizes(shapes["path_size"], 0, F.length("path"))))
    # the last _n labels: what follows the dot before them
    suffix = F.when(F.size(labels) == F.col("_n"), F.col("host")).otherwise(F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("_n")))
    return out.select("host", "path", F.sha2(F.concat(suffix, F.substring(F.col("path"), F.lit(1), F.col("_p"))), 256).alias("digest"))


def url_verdicts(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
                 default: str = "allow") -> DataFrame:
    """page_id, host, path, the rule that decides (or null) and the verdict of every page."""
    rules = _rules(rules)
    pages = pages.select(F.col(page_id), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    asked = expressions(pages.select("host", "path").distinct(), rules).withColumn("key", F.substring("digest", 1, PREFIX))
    known = rules.select(F.substring("digest", 1, PREFIX).alias("key"), F.col("digest").alias("full"),
                         F.struct("size", "host_size", (F.col("verdict") == "block").alias("blocks"), "rule", "verdict").alias("found"))
    fits = asked.join(known, "key").filter(F.col("digest") == F.col("full"))
    best = fits.groupBy("host", "path").agg(F.max("found").alias("found"))
    out = pages.join(best, ["host", "path"], "left")
    return out.select(page_id, "host", "path", F.col("found.rule").alias("rule"),
                      F.coalesce("found.verdict", F.lit(default)).alias("verdict"))
