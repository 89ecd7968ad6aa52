"""Snapshot tables: replacing, restoring, defaults, de-duplication, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.grouping import first_per_key, last_per_key
from ..functions.times import ntz
from ..sources.session import staged

# What an exchange table holds where the source has nothing.
NO_DATE = "1900-01-01"
NO_NUMBER = 0
NO_TEXT = ""


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Null to a default per column, in the column's own type; columns not named stay null."""
    types = dict(df.dtypes)
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(defaults[c]).cast(types[c])).alias(c) if c in defaults else F.col(c)
            for c in df.columns
        ]
    )


def typed_defaults(df: DataFrame, skip: Sequence[str] = ()) -> dict[str, object]:
    """Default map by column type: 0 for numbers and flags, '' for text, 1900-01-01 for times."""
    chosen = {}
    for name, dtype in df.dtypes:
        if name in skip:
            continue
        if dtype == "string":
            chosen[name] = NO_TEXT
        elif dtype.startswith(("timestamp", "date")):
            chosen[name] = NO_DATE
        elif dtype == "boolean":
            chosen[name] = False
        elif dtype.startswith(("int", "bigint", "smallint", "double", "float", "decimal")):
            chosen[name] = NO_NUMBER
    return chosen


def dedupe_exact(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key tuple (nulls equal): the smallest by ``order``, then by the remaining columns."""
    return first_per_key(df, list(keys), [F.col(c) for c in order])


def dedupe_ranked(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Best copy per key; ``order`` lists ascending rank columns (negate a number for descending)."""
    return first_per_key(df, [key], list(order))


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Newest row per key by ``order``."""
    return last_per_key(df, [key], [F.col(order)])


def require(df: DataFrame, message: str, condition: Column | None = None) -> DataFrame:
    """The same rows, or an error. With a condition every row must hold it, checked inside the plan.
    Without one there must be at least one row: a look at the first row only, for one-row lookups."""
    if condition is None:
        if df.isEmpty():
            raise ValueError(message)
        return df
    return df.filter(F.assert_true(F.coalesce(condition, F.lit(False)), F.lit(message)).isNull())


@dataclass(frozen=True)
class Split:
    """Rows that passed every check, the others with ``error_message``, and how many of them there are."""

    good: DataFrame
    bad: DataFrame
    failed: int
    rows: int


def split_once(df: DataFrame, checks: Mapping[str, Column]) -> Split:
    """``quarantine`` out of one pass: one job stores both kinds of rows in the shared folder, apart, and counts them on the way.

    However long ``df`` takes, it is worked out once; each side then reads its own part only.
    """
    marked = _marked(df, checks).withColumn("_bad", F.col("error_message") != "")
    seen = Observation()
    counted = marked.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("_bad").alias("failed"))
    stored = staged(counted, "split", by=("_bad",))
    numbers = seen.get
    good = stored.filter(~F.col("_bad")).drop("_bad", "error_message")
    return Split(good, stored.filter("_bad").drop("_bad"), numbers["failed"], numbers["rows"])


def _marked(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    failed = [F.when(F.coalesce(ok, F.lit(False)), F.lit(None)).otherwise(F.lit(name)) for name, ok in checks.items()]
    return df.withColumn("error_message", F.concat_ws("; ", *failed))


def quarantine(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every check, the others with ``error_message``). Unknown counts as failed."""
    marked = _marked(df, checks)
    good = marked.filter(F.col("error_message") == "").drop("error_message")
    return good, marked.filter(F.col("error_message") != "")


def replace_day(target: DataFrame, new: DataFrame, ts: str, day: str, strict: bool = True) -> DataFrame:
    """Backup after a run for ``day``: earlier rows of that run replaced by the new ones.

    ``strict``: rows are told apart by ``run_date``, so a re-run changes nothing, and rows past midnight
    stay with their run. ``strict=False`` deletes by the date of ``ts`` only.
    """
    run = date.fromisoformat(day)
    if strict:
        kept = target.filter(F.col("run_date") != F.lit(run))
        return kept.unionByName(new.withColumn("run_date", F.lit(run)))
    lo, hi = ntz(str(run)), ntz(str(run + timedelta(days=1)))
    kept = target.filter((F.col(ts) < lo) | (F.col(ts) >= hi) | F.col(ts).isNull())
    return kept.unionByName(new)


def restore_range(backup: DataFrame, year: int, month: int, day: int, days: int, ts: str = "ts") -> DataFrame:
    """Backup rows of [date, date + days): a half-open range that prunes files and row groups."""
    first = date(year, month, day)
    lo, hi = ntz(str(first)), ntz(str(first + timedelta(days=days)))
    return backup.filter((F.col(ts) >= lo) & (F.col(ts) < hi))
