"""Change capture: what has changed between two states of a table, as pairs of rows and the columns that changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.session import staged

#: what one state leaves room for: the ids of a case below the number of the state
SPAN = 1 << 32


def _net(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct rows (columns below ``row``) with how many more there are after than before, where that isn't 0."""
    columns = after.columns
    both = before.select(*columns, F.lit(-1).alias("_n")).unionByName(after.select(*columns, F.lit(1).alias("_n")))
    return both.groupBy(F.struct(*columns).alias("row")).agg(F.sum("_n").alias("n")).filter("n <> 0")


def captured(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """operation, the keys, deleted, inserted, changed: one row per change between two states of a table with equal columns.

    ``deleted`` and ``inserted`` are whole rows as structs, null where there is none; ``changed`` names the columns that differ, in the
    table's order. ``operation`` is "update" (both rows), "insert" or "delete". Values are compared null-safe, rows as a multiset,
    so the order of rows, and rows that are equal on both sides, don't matter.

    A key that lost one row and got one is updated. Where a key lost or got several rows, or is null in some column, no row is told
    to follow from another: all of them are deletions and insertions, repeated rows each time. Both states are read once and
    meet in one aggregation over whole rows, combined on the map side; only rows that differ go further.
    """
    columns = after.columns
    if sorted(before.columns) != sorted(columns):
        raise ValueError(f"the states have different columns: {sorted(set(before.columns) ^ set(columns))}")
    kinds = dict(after.dtypes)
    before = before.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns])
    net = staged(_net(before, after).select(*[F.col(f"row.{k}").alias(k) for k in keys], "row", "n"), "captured")  # a key may own most of it
    lost, got = F.when(F.col("n") < 0, F.col("row")), F.when(F.col("n") > 0, F.col("row"))
    whole = net.filter(" and ".join(f"{k} is not null" for k in keys)) if keys else net.limit(0)
    count = F.sum(F.when(F.col("n") < 0, -F.col("n")).otherwise(0)), F.sum(F.when(F.col("n") > 0, F.col("n")).otherwise(0))
    by_key = whole.groupBy(*keys).agg(F.min(lost).alias("deleted"), F.min(got).alias("inserted"), count[0].alias("_lost"), count[1].alias("_got"))
    paired = by_key.filter("_lost = 1 and _got = 1").drop("_lost", "_got")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"deleted.{c}").eqNullSafe(F.col(f"inserted.{c}")), F.lit(c)) for c in columns]))
    updates = paired.select(F.lit("update").alias("operation"), *keys, "deleted", "inserted", changed.alias("changed"))

    alone = net.join(staged(paired.select(*keys), "updated_keys"), list(keys), "left_anti")
    each = alone.withColumn("_i", F.explode(F.sequence(F.lit(1), F.abs("n").cast("int"))))
    kind = F.when(F.col("n") < 0, F.lit("delete")).otherwise(F.lit("insert"))
    others = each.select(kind.alias("operation"), *keys, lost.alias("deleted"), got.alias("inserted"), F.array().cast("array<string>").alias("changed"))
    return updates.unionByName(others)


def writes(changes: DataFrame, column: str, state: int = 0) -> DataFrame:
    """The captured changes that wrote ``column``, as ``sync_group`` and ``change_log`` take them: id, case_id, measured, seq.

    That are the insertions, and the updates where it changed (a change to null is one); deletions write nothing. Rows need ``id``
    and ``case_id``. Between two states nothing tells an order: within a case the larger id counts as the later one, and any
    change of a later ``state`` as later than those before it.
    """
    wrote = (F.col("operation") == "insert") | F.array_contains("changed", column)
    seq = F.lit(state * SPAN).cast("long") + F.col("inserted.id").cast("long")
    return changes.filter(wrote).select("inserted.id", "inserted.case_id", F.col(f"inserted.{column}").alias("measured"), seq.alias("seq"))


def applied(before: DataFrame, changes: DataFrame) -> DataFrame:
    """The later state out of the earlier one and what was captured between them: rows deleted go, one for one, rows inserted come."""
    columns = before.columns
    gone = changes.filter("deleted is not null").select("deleted.*").select(*columns, F.lit(-1).alias("_n"))
    come = changes.filter("inserted is not null").select("inserted.*").select(*columns, F.lit(1).alias("_n"))
    held = before.select(*columns, F.lit(1).alias("_n")).unionByName(gone).unionByName(come)
    left = held.groupBy(*columns).agg(F.sum("_n").cast("int").alias("_n")).filter("_n > 0")
    return left.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*columns)


def described(changes: DataFrame, columns: Sequence[str]) -> Column:
    """Text of a change: ``column: old -> new`` for each of some columns that differ, as an audit line."""

    def line(c: str) -> Column:
        old, new = (F.coalesce(F.col(f"{side}.{c}").cast("string"), F.lit("null")) for side in ("deleted", "inserted"))
        return F.when(F.array_contains("changed", c), F.concat(F.lit(f"{c}: "), old, F.lit(" -> "), new))

    return F.array_join(F.array_compact(F.array(*[line(c) for c in columns])), ", ")
