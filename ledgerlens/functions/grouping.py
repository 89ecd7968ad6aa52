"""Skew-safe grouping helpers: everything here combines on the map side before a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(pick(ranked).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by ``order``, remaining columns breaking ties.

    A struct minimum instead of ROW_NUMBER: copies of one key are reduced in every map task, so a key
    that owns a third of the rows never meets in a single task.
    """
    return _best_per_key(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the largest by ``order``, in the same way."""
    return _best_per_key(df, keys, order, F.max)


def numbered(df: DataFrame, keys: Sequence[str], coarse: Sequence[Column], fine: Column, span: int = 10_000) -> DataFrame:
    """Adds ``position`` (from 0): the place of each row in its group, sorted by ``coarse`` and then ``fine``.

    ``fine`` is a whole number that tells the rows of a group apart, such as an id. A group is counted by
    ranges of the order, which hold at most ``span`` ids each; the ranges before give what a range starts
    from, so no task ever sorts more than one range, however many rows a group has. Null is a key like any.
    """
    ranged = df.withColumn("_range", F.struct(*[c.alias(f"_c{i}") for i, c in enumerate(coarse)], F.floor(fine / F.lit(span)).alias("_f")))
    ranged = ranged.withColumn("_fine", fine).withColumn("_key", F.struct(*keys))
    counts = ranged.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_key", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_key", "_range").orderBy("_fine")
    placed = ranged.withColumn("_place", F.row_number().over(within) - 1).join(starts, ["_key", "_range"])
    return placed.select(*df.columns, (F.col("_start") + F.col("_place")).alias("position"))


def listed_text(
    df: DataFrame,
    keys: Sequence[str],
    item: Column,
    coarse: Sequence[Column],
    fine: Column,
    separator: str = ", ",
    per_part: int = 10_000,
) -> DataFrame:
    """Items of a group as text: columns ``keys``, ``part``, ``items``.

    Items are numbered in their order (see ``numbered``) and a part is a stretch of ``per_part`` positions,
    in every group: the parts one after the other are the whole list. Null items are left out, rows with a
    null key have no list.
    """
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    items = df.withColumn("_item", item).filter(F.col("_item").isNotNull())
    cut = numbered(items, keys, coarse, fine).withColumn("part", F.floor(F.col("position") / F.lit(per_part)).cast("int"))
    entry = F.array_sort(F.collect_list(F.struct("position", "_item")))
    text = F.array_join(F.transform(entry, lambda e: e.getField("_item")), separator)
    return cut.groupBy(*keys, "part").agg(text.alias("items"))
