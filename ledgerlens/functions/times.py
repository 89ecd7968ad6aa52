"""Time helpers. All clock values are TIMESTAMP_NTZ: plant data carries no zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def midnight(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def truncate(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def midnights_between(start: Column, end: Column) -> Column:
    """Calendar days between two times, counting midnights crossed rather than elapsed 24 h."""
    return F.datediff(end.cast("date"), start.cast("date"))


def shift(ts: Column, unit: str, amount: Column | int) -> Column:
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(unit, amount, ts)


def slot(ts: Column, width: str) -> Column:
    """Start of the fixed-width time slot a time falls in."""
    return F.window(ts, width).getField("start")


def ntz(text: str) -> Column:
    """Literal time; a foldable cast, so comparisons with it reach the scan."""
    return F.lit(text).cast("timestamp_ntz")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "dd.MM.yyyy")


def second_text(ts: Column) -> Column:
    return F.date_format(ts, "dd.MM.yyyy HH:mm:ss")
