"""Sampling of tag time series at interval boundaries.

Readings are the big side. Nothing here moves all readings of a tag into one task: they are sorted by ranges
of (tag, time), and what is carried from one range to the next is one row per range and tag.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.amounts import EXACT, exact
from ..functions.text import blank_to_null, folded
from ..functions.times import ntz
from ..sources.session import staged

RUNNING = (Window.unboundedPreceding, Window.currentRow)


def overlaps(start: Column, end: Column, lo: Column, hi: Column) -> Column:
    """Starts in, ends in, or reaches over the end of [lo, hi]; a null end is open; bounds inclusive."""
    starts_in = (start >= lo) & (start <= hi)
    ends_in = (end >= lo) & (end <= hi)
    spans = (start <= hi) & (end.isNull() | (end >= hi))
    return starts_in | ends_in | spans


def interval_overlap(intervals: DataFrame, start: str, end: str) -> DataFrame:
    lo, hi = ntz(start), ntz(end)
    # every branch implies start <= hi: stated on its own it prunes row groups at the scan
    return intervals.filter(F.col("start_time") <= hi).filter(
        overlaps(F.col("start_time"), F.col("end_time"), lo, hi)
    )


def _nodes(first: Column, last: Column, depth: Column) -> Column:
    """The nodes of a binary tree over 2^depth slots that belong to the slots ``first`` to ``last``: an array of (node, whole).

    A node of level h stands for 2^h slots. Whole nodes make up the range, at most two a level; the others are those above its ends
    that reach beyond it, at most two a level as well. Nodes are numbered as in a heap: the root is 1.
    """

    def of_level(h: Column) -> Column:
        def node(i: Column) -> Column:
            return F.call_function("shiftleft", F.lit(1).cast("long"), (depth - h).cast("int")) + i

        def down(i: Column) -> Column:
            return F.call_function("shiftright", i, h)

        size = F.call_function("shiftleft", F.lit(1).cast("long"), h)
        left, right = down(first + size - 1), down(last + 1)  # whole nodes are left to right - 1
        low, high = down(first), down(last)
        some = left < right
        whole = [F.when(some & (left % 2 == 1), left), F.when(some & (right % 2 == 1), right - 1)]
        part = [F.when(low * size < first, low), F.when((low != high) | (low * size >= first), F.when((high + 1) * size > last + 1, high))]
        marked = [F.when(i.isNotNull(), F.struct(node(i).alias("node"), F.lit(w).alias("whole"))) for w, ns in ((True, whole), (False, part)) for i in ns]
        return F.array_compact(F.array(*marked))

    return F.flatten(F.transform(F.sequence(F.lit(0), depth), of_level))


def interval_overlap_periods(intervals: DataFrame, periods: DataFrame, key: str = "period_id", slot: int = 86_400) -> DataFrame:
    """Every interval with every period it overlaps, by the rule above. ``periods``: ``key``, period_start,
    period_end.

    The time from the first period's start to the last one's end is cut into T slots of ``slot`` seconds, with a binary tree over
    them. An interval, cut to that time, and a period each become at most 4 log T nodes, and an interval that is open at
    the end at most 2 log T, however long they last. Two ranges that share a slot share exactly one node that holds the first
    slot of both and is whole in one of them, so an equi-join by node gives every pair once; the rule is then checked on the times.
    Slots only decide what meets: pick them no longer than the shortest periods. Intervals without a start overlap nothing, as
    above; periods without a start or an end, or that end before they start, have no overlaps.
    """
    bounds = periods.filter("period_start <= period_end")
    lo, hi = bounds.agg(F.min("period_start")).scalar(), bounds.agg(F.max("period_end")).scalar()

    def slot_of(time: Column) -> Column:
        return F.floor(F.timestamp_diff("SECOND", lo, time) / F.lit(slot)).cast("long")

    def laid(df: DataFrame, start: Column, end: Column) -> DataFrame:
        ranged = df.withColumn("_first", slot_of(start)).withColumn("_last", slot_of(end)).withColumn("_depth", F.length(F.bin(slot_of(hi))).cast("int"))
        return ranged.select(*df.columns, "_first", F.col("_depth"), F.explode(_nodes(F.col("_first"), F.col("_last"), F.col("_depth"))).alias("_n"))

    end = F.coalesce("end_time", hi)
    clipped = intervals.filter(F.col("start_time").isNotNull()).withColumn("_from", F.greatest(F.least("start_time", end), lo))
    clipped = clipped.withColumn("_to", F.least(F.greatest("start_time", end), hi)).filter("_from <= _to")
    ours = laid(clipped, F.col("_from"), F.col("_to")).drop("_from", "_to")
    ours = ours.select(*intervals.columns, "_first", "_depth", F.col("_n.node").alias("_node"), F.col("_n.whole").alias("_whole"))
    asked = laid(bounds.select(key, "period_start", "period_end"), F.col("period_start"), F.col("period_end"))
    asked = asked.select(key, "period_start", "period_end", F.col("_first").alias("_begin"), F.col("_n.node").alias("_node"), F.col("_n.whole").alias("_all"))
    met = ours.join(asked, "_node").filter(F.col("_whole") | F.col("_all"))
    # the node holds the first common slot: that slot's leaf, brought up to the node's level, is the node
    leaf = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_depth")) + F.greatest("_first", "_begin")
    up = (F.length(F.bin(leaf)) - F.length(F.bin("_node"))).cast("int")
    hit = (F.col("start_time") <= F.col("period_end")) & overlaps(F.col("start_time"), F.col("end_time"), F.col("period_start"), F.col("period_end"))
    return met.filter((F.call_function("shiftright", leaf, up) == F.col("_node")) & hit).select(key, *intervals.columns)


def boundary_times(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct starts, ends (open end: period end) and the period's own bounds, as column ``ts``."""
    ends = F.coalesce(F.col("end_time"), ntz(end))
    own = intervals.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(ntz(start), ntz(end))).alias("ts"))
    return (
        intervals.select(F.explode(F.array("start_time", ends)).alias("ts"))
        .filter(F.col("ts").isNotNull())
        .union(own)
        .distinct()
    )


def tag_catalog(attributes: DataFrame, xml_col: str, path: str) -> DataFrame:
    """Distinct (object_id, tag) out of XML property documents; empty and missing tags dropped.

    Documents repeat: they are made distinct before any of them is parsed. The count ties the parsing to
    the grouped rows; the filter would otherwise be pushed below the grouping and parse every document.
    """
    documents = attributes.groupBy("object_id", xml_col).agg(F.count(F.lit(1)).alias("_copies"))
    tag = F.get(F.xpath(F.col(xml_col), F.lit(path)), F.lit(0))
    return (
        documents.select("object_id", F.when(F.col("_copies") > 0, tag).alias("tag"))
        .filter(F.col("tag") != "")
        .distinct()
    )


def entity_tags(
    transfers: DataFrame,
    entities: DataFrame,
    aliases: DataFrame,
    attributes: DataFrame,
    alias_name: str | Column,
    path: str = "/Properties/@TagName",
) -> DataFrame:
    """Distinct (tag, object_type, alias_id) that matter for the transfers.

    A unit at either end of a transfer brings the aliases of both its nodes, a tank at either end the
    chosen alias of both its modules. The conditional match is two keyed branches of one equi-join, and
    every side is made distinct first, so a busy place counts once and not per transfer.
    """
    wanted = F.lit(alias_name) if isinstance(alias_name, str) else alias_name
    ends = transfers.select("source_uid", "destination_uid", "source_node", "dest_node").distinct()
    objects = entities.select("uid", F.col("type").alias("object_type")).filter(
        F.col("object_type").isin("Unit", "Tank")
    )
    places = (
        ends.withColumn("uid", F.explode(F.array_distinct(F.array("source_uid", "destination_uid"))))
        .join(objects, "uid")
        .select(
            "object_type",
            F.explode(
                F.when(F.col("object_type") == "Unit", F.array("source_node", "dest_node")).otherwise(
                    F.array("source_uid", "destination_uid")
                )
            ).alias("place"),
        )
        .distinct()
    )
    keyed = aliases.select(
        "alias_id", F.lit("Unit").alias("object_type"), F.col("node_id").cast("string").alias("place")
    ).unionByName(
        aliases.filter(F.col("alias_name") == wanted).select(
            "alias_id", F.lit("Tank").alias("object_type"), F.col("module_id").alias("place")
        )
    )
    tags = tag_catalog(attributes, "properties", path)
    return (
        places.join(keyed, ["object_type", "place"])
        .select("object_type", "alias_id")
        .distinct()
        .join(tags, F.col("alias_id") == F.col("object_id"))
        .select("tag", "object_type", "alias_id")
        .distinct()
    )


def sample_grid(tags: DataFrame, times: DataFrame) -> DataFrame:
    """Every tag at every time of ``times`` (column ``ts``).

    The times are dealt to as many strips as there are shuffle partitions; every tag is laid out once per
    strip and meets its times in an equi-join, so neither side is collected, broadcast or multiplied alone.
    """
    strips = _partitions(tags.sparkSession)
    dealt = times.withColumn("_strip", F.pmod(F.xxhash64("ts"), F.lit(strips)).cast("int"))
    laid = tags.withColumn("_strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    return laid.join(dealt, "_strip").drop("_strip")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _sampled(
    points: DataFrame, readings: DataFrame, by: list[str], time: str, value: str, amount: Column, tie: str | None
) -> DataFrame:
    """Points with ``_last`` (last value at or before) and ``_total`` (sum of ``amount`` up to) the point.

    Readings and points are sorted together by ranges of (by, time): a key with many readings simply takes
    several ranges, at every size. Inside a range a running window gives what was seen so far; one row per
    range and key, summed up over the ranges before, gives what is carried in. Both sides are read once;
    the sorted rows are stored, so that the ranges stay as they are. Of readings at one time the largest
    ``tie`` counts as the last (the largest value, if no column is named), null first.
    """
    value_type = dict(readings.dtypes)[value]
    seen = readings.select(
        *by,
        time,
        F.lit(0).alias("_kind"),
        F.col(tie or value).alias("_tie"),
        F.struct(F.col(value).alias("v")).alias("_seen"),
        amount.cast(EXACT).alias("_add"),
    )
    asked = points.select(
        *by,
        time,
        F.lit(1).alias("_kind"),
        F.lit(None).cast(dict(readings.dtypes)[tie or value]).alias("_tie"),
        F.lit(None).cast(f"struct<v:{value_type}>").alias("_seen"),
        F.lit(None).cast(EXACT).alias("_add"),
        F.struct(*points.columns).alias("_point"),
    )
    order = [time, "_kind", "_tie"]
    rows = seen.unionByName(asked, allowMissingColumns=True).repartitionByRange(*by, *order)
    rows = staged(rows.withColumn("_range", F.spark_partition_id()), "sampled")
    when = F.when(F.col("_kind") == 0, F.struct(*order))
    ends = rows.groupBy("_range", *by).agg(F.max_by("_seen", when).alias("_seen"), F.sum("_add").alias("_add"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_range",
        *by,
        F.last("_seen", True).over(before).alias("_seen_before"),
        F.sum("_add").over(before).alias("_before"),
    )
    running = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(*RUNNING)
    inside = (
        rows.withColumn("_seen", F.last("_seen", True).over(running))
        .withColumn("_add", F.sum("_add").over(running))
        .filter(F.col("_kind") == 1)
    )
    total = F.coalesce(F.col("_add") + F.col("_before"), "_add", "_before")
    return inside.join(carried, ["_range", *by]).select(
        "_point.*",
        F.coalesce("_seen", "_seen_before").getField("v").alias("_last"),
        total.cast("double").alias("_total"),
    )


def asof_last_value(
    points: DataFrame,
    readings: DataFrame,
    by: Sequence[str] = ("tag",),
    time: str = "ts",
    value: str = "value",
    default: float | None = 0.0,
    tie: str | None = None,
) -> DataFrame:
    """Value of the last reading at or before each point; ``default`` when there is none or it is null.

    Of readings at one time that with the largest ``tie`` is the last, or without one the largest value.
    """
    sampled = _sampled(points, readings, list(by), time, value, F.lit(None), tie)
    found = F.col("_last") if default is None else F.coalesce("_last", F.lit(default))
    return sampled.select(*points.columns, found.alias(value))


def _step(before: Column, now: Column) -> Column:
    """What a counter has counted between two readings: one that fell has started again at 0. A reading below 0 counts nothing."""
    return F.when(now >= before, now - before).otherwise(F.greatest(now, F.lit(0).cast(EXACT)))


def _metered(points: DataFrame, readings: DataFrame, by: list[str], time: str, value: str, tie: str | None) -> DataFrame:
    """Points with ``_total``, the sum of all steps of a counter from its first reading up to the point.

    Sorted by ranges as above. What a range hands on is associative: its first and last reading and the sum of the steps between;
    the step from the last reading before a range to its first one is added where ranges are put together.
    """
    tied = F.col(tie or value)
    seen = readings.filter(F.col(value).isNotNull()).select(*by, time, F.lit(0).alias("_kind"), tied.alias("_tie"), exact(value).alias("_v"))
    asked = points.select(*by, time, F.lit(1).alias("_kind"), F.lit(None).cast(dict(readings.dtypes)[tie or value]).alias("_tie"), F.lit(None).cast(EXACT).alias("_v"), F.struct(*points.columns).alias("_point"))
    order = [time, "_kind", "_tie"]
    rows = seen.unionByName(asked, allowMissingColumns=True).repartitionByRange(*by, *order)
    rows = staged(rows.withColumn("_range", F.spark_partition_id()), "metered")
    within = Window.partitionBy("_range", *by).orderBy(*order)
    previous = F.last("_v", True).over(within.rowsBetween(Window.unboundedPreceding, -1))
    stepped = rows.withColumn("_steps", F.when(F.col("_v").isNotNull(), _step(previous, F.col("_v"))))
    stepped = stepped.withColumn("_steps", F.when(previous.isNotNull(), F.col("_steps")))
    when = F.when(F.col("_kind") == 0, F.struct(*order))
    ends = stepped.groupBy("_range", *by).agg(F.min_by("_v", when).alias("_first"), F.max_by("_v", when).alias("_last"), F.sum("_steps").alias("_inner"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    reached = ends.withColumn("_reached", F.last("_last", True).over(before))
    bridged = reached.withColumn("_bridge", F.when(F.col("_reached").isNotNull() & F.col("_first").isNotNull(), _step(F.col("_reached"), F.col("_first"))))
    nothing = F.lit(0).cast(EXACT)
    entry = F.coalesce("_inner", nothing) + F.coalesce("_bridge", nothing)
    carried = bridged.select("_range", *by, "_bridge", F.sum(entry).over(before).alias("_before"))
    inside = (
        stepped.withColumn("_run", F.sum("_steps").over(within.rowsBetween(*RUNNING)))
        .withColumn("_any", F.count("_v").over(within.rowsBetween(*RUNNING)) > 0)
        .filter(F.col("_kind") == 1)
    )
    total = F.coalesce("_before", nothing) + F.when(F.col("_any"), F.coalesce("_bridge", nothing)).otherwise(nothing) + F.coalesce("_run", nothing)
    return inside.join(carried, ["_range", *by]).select("_point.*", total.cast("double").alias("_total"))


def accumulate_to(
    points: DataFrame,
    readings: DataFrame,
    by: Sequence[str] = ("tag",),
    start: str | None = None,
    time: str = "ts",
    value: str = "value",
    mode: str = "increment",
    tie: str | None = None,
) -> DataFrame:
    """Quantity accumulated from ``start`` to each point (both inclusive); 0 when there is none.

    ``increment``: sum of the readings, as decimals so that it does not depend on arrival order.
    ``counter``: last minus first reading of a running counter.
    ``meter``: the steps of a counter that may start again at 0: a step up counts, after a step down what the counter shows then.
    The first reading only sets the start; null readings are left out.
    """
    by = list(by)
    used = readings if start is None else readings.filter(F.col(time) >= ntz(start))
    if mode == "counter":
        firsts = used.groupBy(*by).agg(F.min_by(value, F.struct(time, tie or value)).alias("_first"))
        last = asof_last_value(points, used, by, time, value, None, tie)
        gain = F.coalesce(F.col(value) - F.col("_first"), F.lit(0.0))
        return last.join(firsts, by, "left").withColumn(value, gain).drop("_first")
    if mode == "meter":
        return _metered(points, used, by, time, value, tie).select(*points.columns, F.col("_total").alias(value))
    if mode != "increment":
        raise ValueError(f"unknown mode {mode!r}")
    sampled = _sampled(points, used, by, time, value, exact(value), tie)
    return sampled.select(*points.columns, F.coalesce("_total", F.lit(0.0)).alias(value))


def tag_values_at_boundaries(
    transfers: DataFrame,
    entities: DataFrame,
    aliases: DataFrame,
    attributes: DataFrame,
    alias_name: str | Column,
    readings: DataFrame,
    start: str,
    end: str,
    tie: str | None = None,
) -> DataFrame:
    """Tank levels (as-of) and unit accumulations at every boundary of the transfers of a period.

    Both kinds of value come out of one pass over the readings.
    """
    live = interval_overlap(transfers, start, end)
    tags = entity_tags(live, entities, aliases, attributes, alias_name)
    # a transfer may begin before the period and end after it: its bounds are sampled all the same
    times = boundary_times(live, start, end)
    grid = sample_grid(tags.select("tag", "object_type", "alias_id"), times)
    counted = F.when(F.col("ts") >= ntz(start), exact("value"))
    sampled = _sampled(grid, readings, ["tag"], "ts", "value", counted, tie)
    chosen = F.when(F.col("object_type") == "Tank", F.col("_last")).otherwise(F.col("_total"))
    return sampled.select("tag", "object_type", "alias_id", F.coalesce(chosen, F.lit(0.0)).alias("value"), "ts")


def snapshot_at(
    points: DataFrame, states: DataFrame, by: str, at: str, time: str = "ts", tie: str | None = None
) -> DataFrame:
    """Whole state row of each point as of a time; points without any state are absent.

    One combining aggregate over (time, row); nulls of the last row are kept. Of rows at one time the one
    with the largest ``tie`` counts, then the largest by the remaining columns in their order.
    """
    rest = [c for c in states.columns if c not in (by, time)]
    first = [tie] if tie else []
    ranked = F.struct(time, *first, *[c for c in rest if c not in first])
    wanted = points.select(by).distinct()
    return (
        states.filter(F.col(time) <= ntz(at))
        .join(wanted, by, "left_semi")
        .groupBy(by)
        .agg(F.max(ranked).alias("_row"))
        .select(*[F.col(by) if c == by else F.col(f"_row.{c}").alias(c) for c in states.columns])
    )


def period_accumulation(
    tags: DataFrame, readings: DataFrame, start: str, days: int, by: str = "tag", time: str = "ts", value: str = "value"
) -> DataFrame:
    """Per tag the sum over [start, start + days); null for a tag without readings."""
    if days < 1:
        raise ValueError(f"number of days must be at least 1, got {days}")
    stop = datetime.fromisoformat(start) + timedelta(days=days)
    sums = (
        readings.filter((F.col(time) >= ntz(start)) & (F.col(time) < ntz(str(stop))))
        .groupBy(by)
        .agg(F.sum(exact(value)).cast("double").alias("accumulation"))
    )
    return tags.join(sums, by, "left")


def active_tag_settings(
    settings: DataFrame, objects: DataFrame, attribute: str, name_like: str, ci: bool = True
) -> DataFrame:
    """(object, tag_id) from attribute settings: attribute name without case, object name by LIKE,
    not blank, not deleted."""
    named = folded(F.col("attribute"), ci) == F.lit(attribute.lower() if ci else attribute)
    live = settings.filter(
        named & (F.col("is_deleted") == 0) & blank_to_null(F.col("settings")).isNotNull()
    )
    scope = objects.filter(F.col("sf_name").like(name_like)).select("sf_id", "sf_name")
    return live.join(scope, F.col("af_element") == F.col("sf_id")).select(
        "sf_id", "sf_name", F.col("settings").alias("tag_id")
    )


def tag_id_list(tags: DataFrame, column: str = "tag_id") -> DataFrame:
    """The distinct tag ids of the settings, trimmed, without blanks, one row each: the list a source of
    readings is asked for, in the form a semi-join takes."""
    text = F.trim(F.col(column).cast("string"))
    return tags.select(text.alias("tag_id")).filter(F.col("tag_id") != "").distinct()
