"""Block and allow rules on URLs, matched by one sorted sweep over canonical keys.

A rule ``host/path`` becomes the key ``reversed host labels / path`` and the interval
``[key, key + 0xFF)`` of all keys that start with it: UTF-8 text never holds the byte 0xFF.
Intervals of one host are nested or apart, so a sweep over the sorted interval ends needs
only a stack. A URL has one key for each of its host's last labels; the rule on top of the
stack where a key falls is the longest rule of that host, and the longest over all its keys
wins.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import partitions, saved

NO_RULE = "allow"


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("/"), path).cast("binary")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, verdict)."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _boundaries(rules: DataFrame) -> DataFrame:
    """Both ends of each rule's interval, with the rule on top of the stack from there on.

    ``depth`` is the height of the stack after an end. The rule uncovered by closing another
    is the last one pushed at that height.
    """
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & (F.col("host") != ""))
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.withColumn("_key", _key(F.split("host", r"\."), F.col("path")))
    rule = F.struct(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("reach"))
    opened = rules.select("host", "_key", F.lit(0).alias("_kind"), F.lit(1).alias("step"), rule.alias("rule"))
    closed = rules.select(
        "host", F.concat("_key", F.lit(b"\xff")).alias("_key"), F.lit(2).alias("_kind"), F.lit(-1).alias("step"),
        F.lit(None).cast(opened.schema["rule"].dataType).alias("rule"),
    )
    order = Window.partitionBy("host").orderBy("_key", "_kind")
    ends = opened.union(closed).withColumn("depth", F.sum("step").over(order))
    level = Window.partitionBy("host", "depth").orderBy("_key", "_kind")
    top = F.when(F.col("depth") > 0, F.last("rule", ignorenulls=True).over(level))
    return ends.select("_key", "_kind", F.struct(top.alias("rule")).alias("_top"))


def match_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", no_rule: str = NO_RULE) -> DataFrame:
    """``pages`` with host, path, rule and verdict added; names already taken are replaced.

    A rule fits its host and all subdomains when the URL's path starts with the rule's path;
    the longest rule text wins, on equal length the one with the longer host. Rules given
    twice with different verdicts block. A NULL URL, or one without ``://``, has an empty
    host and path, and no rule. Repeated URLs are matched once. No pages: no rows.

    The keys are range-partitioned together with the interval ends and swept per partition;
    the top of the stack at each partition's start comes from one row per partition.
    """
    spark = pages.sparkSession
    given = pages.drop("host", "path", "rule", "verdict", "_best")
    given = given.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))})
    given = given.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    # a host can only fit rules of at most as many labels as the longest rule has
    longest = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0))).first()[0]
    labels = F.split("host", r"\.")
    addresses = given.select("host", "path").where("host <> ''").distinct()
    keys = addresses.withColumn("_n", F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(longest))))) if longest else addresses.withColumn("_n", F.lit(1)).limit(0)
    last = F.slice(labels, F.size(labels) - F.col("_n") + 1, F.col("_n"))
    ends = _boundaries(rules)
    keys = keys.select(
        _key(last, F.col("path")).alias("_key"), F.lit(1).alias("_kind"),
        F.lit(None).cast(ends.schema["_top"].dataType).alias("_top"), "host", "path",
    )
    line = ends.select("*", F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path")).union(keys)
    line = line.repartitionByRange(partitions(spark), "_key", "_kind", "host", "path")
    line = saved(line.withColumn("_part", F.spark_partition_id()), "url-sweep")

    ends_seen = F.max_by("_top", F.when(F.col("_kind") != 1, F.struct("_key", "_kind")))
    parts = line.groupBy("_part").agg(ends_seen.alias("_left"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.last("_left", ignorenulls=True).over(before).alias("_at_start"))

    sweep = Window.partitionBy("_part").orderBy("_key", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("_top", F.last("_top", ignorenulls=True).over(sweep)).where("_kind = 1")
    swept = swept.join(parts, "_part").select("host", "path", F.coalesce("_top", "_at_start")["rule"].alias("_rule"))
    best = swept.where(F.col("_rule").isNotNull()).groupBy("host", "path").agg(
        F.max_by("_rule", F.struct(F.length("_rule.rule"), "_rule.reach")).alias("_best")
    )
    out = given.join(best, ["host", "path"], "left")
    return out.select(
        *[c for c in given.columns if c not in ("host", "path")], "host", "path",
        F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(no_rule)).alias("verdict"),
    )
