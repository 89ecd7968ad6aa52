"""URL rules by a sorted sweep: reversed-host keys turn host suffixes into intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import parts

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_RULE = "struct<rule: string, host: string, path: string, verdict: string>"


def host_and_path(url) -> tuple[F.Column, F.Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, _URL, 1), UPPER, LOWER), F.regexp_extract(known, _URL, 2)


def reversed_key(host) -> F.Column:
    """Labels from the last to the first, each in hexadecimal and closed by ``!``: a host's subdomains, and only they, have keys
    that begin with its own."""
    return F.concat(F.array_join(F.transform(F.reverse(F.split(host, r"\.")), F.hex), "!"), F.lit("!"))


def _behind(key) -> F.Column:
    """The least key behind all that begin with ``key``."""
    return F.concat(F.left(key, F.length(key) - 1), F.lit('"'))


def _suffixes(host) -> F.Column:
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def stacks(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, stack: all rules whose host is the host or a domain above it, for each of the distinct ``hosts``.

    Rules' intervals and hosts are sorted by reversed key together. Each interval's begin and end carries the rules in force from
    there on (intervals nest, so they are a stack); a host has those of the last bound before it. The sort is by ranges: a range
    begins with what was in force at the end of the ranges before it.
    """
    spark = hosts.sparkSession
    grouped = rules.groupBy("host").agg(F.array_sort(F.collect_set(F.struct("rule", "host", "path", "verdict"))).alias("own"))
    above = grouped.select("host", F.explode(_suffixes(F.col("host"))).alias("upper"))
    held = above.join(grouped.select(F.col("host").alias("upper"), "own"), "upper")
    strict = F.flatten(F.collect_list(F.when(F.col("upper") != F.col("host"), F.col("own")).otherwise(F.array().cast(f"array<{_RULE}>"))))
    nested = held.groupBy("host").agg(F.flatten(F.collect_list("own")).alias("within"), strict.alias("beyond"))
    key = reversed_key(F.col("host"))
    begins = nested.select(key.alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), F.col("within").alias("stack"))
    ends = nested.select(_behind(key).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"), F.col("beyond").alias("stack"))
    asked = hosts.select(key.alias("at"), F.lit(1).alias("kind"), "host", F.lit(None).cast(f"array<{_RULE}>").alias("stack"))
    swept = begins.unionByName(ends).unionByName(asked).repartitionByRange("at")
    swept = staged(swept.withColumn("range", F.spark_partition_id()), "url_sweep")  # stored, so that ranges stay as they are
    bounds = swept.filter("kind = 0").groupBy("range").agg(F.max_by("stack", "at").alias("stack"))
    every = spark.range(parts(spark)).select(F.col("id").cast("int").alias("range")).join(bounds, "range", "left")
    # one row for each range
    earlier = Window.partitionBy().orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("range", F.last("stack", ignorenulls=True).over(earlier).alias("carried"))
    running = Window.partitionBy("range").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = swept.withColumn("active", F.last("stack", ignorenulls=True).over(running)).filter("kind = 1")
    return inside.join(F.broadcast(carried), "range", "left").select("host", F.coalesce("active", "carried").alias("stack"))


def judged(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url).

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the url's path begins with the rule's; the
    longest host and path together wins, then the longer host, then "block" over "allow". Without a fitting rule the verdict is
    ``otherwise`` and the rule null.

    A null url, or one without ``://``, has an empty host and path, which no rule fits. Rules with a null or empty host don't count,
    a null path is an empty one. Rows that repeat or lack a page_id are judged each; an empty table gives an empty result; other
    columns are left out. Hosts are swept once each however many urls they have; a host's stack holds the rules of its own name
    and the domains above it.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = rules.filter("host is not null and host <> ''").select(
        F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    )
    known = known.withColumn("rule", F.concat("host", "path"))
    found = stacks(urls.filter("host <> ''").select("host").distinct(), known)
    fits = F.filter("stack", lambda r: F.startswith(F.col("path"), r["path"]))
    ranked = F.transform(fits, lambda r: F.struct(F.length(r["rule"]), F.length(r["host"]), r["verdict"], r["rule"]))
    best = F.array_max(ranked)
    return (
        urls.join(found, "host", "left")
        .withColumn("best", best)
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
    )
