"""Reporting periods and cases."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import rows_table
from ..functions.times import midnight, midnights_between, ntz, shift, truncate


def reporting_period(df: DataFrame, ts: str, shifts: DataFrame) -> DataFrame:
    """Adds period_start / period_end: the last closed shift-day as seen at each row's time.

    The day starts at the smallest start hour and lasts as long as that first shift says. Before the
    start hour the last closed period began two days back, otherwise one. The shift constants arrive as
    scalar subqueries: no join, whatever the size of ``df``.
    """
    start_hour = shifts.agg(F.min("start_hour")).scalar()
    duration = shifts.agg(F.min_by("duration", "start_hour")).scalar()
    opening = shift(midnight(F.col(ts)), "HOUR", start_hour)
    start = shift(opening, "DAY", F.when(opening > F.col(ts), F.lit(-2)).otherwise(F.lit(-1)))
    return df.withColumn("period_start", start).withColumn(
        "period_end", shift(F.col("period_start"), "HOUR", duration)
    )


def select_cases(cases: DataFrame, analyses: DataFrame, start: str, end: str, exact: bool = False) -> DataFrame:
    """Cases with their model, inside a period or exactly equal to it. Both predicates are plain and pushed down."""
    lo, hi = ntz(start), ntz(end)
    if exact:
        inside = (F.col("start_time") == lo) & (F.col("end_time") == hi)
    else:
        inside = (F.col("start_time") >= lo) & (F.col("end_time") <= hi)
    return cases.filter(inside).join(analyses, "analysis_id")


def is_cumulative(rule: str, cumulative: str | None = None) -> Column:
    """1 for a cumulative case. Rules: "span" (starts on the 1st, crosses more than one midnight),
    "analysis_id" or "name" equal to ``cumulative``."""
    if rule == "span":
        cond = (F.dayofmonth("start_time") == 1) & (
            midnights_between(F.col("start_time"), F.col("end_time")) > 1
        )
    elif rule in ("analysis_id", "name"):
        cond = F.lower(F.col(rule)) == F.lit(str(cumulative).lower())
    else:
        raise ValueError(f"unknown case rule {rule!r}")
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def case_kind(cases: DataFrame, rule: str = "span", cumulative: str | None = None) -> DataFrame:
    return cases.withColumn("is_cumulative", is_cumulative(rule, cumulative))


def month_to_date_cases(cases: DataFrame, case_id: int) -> DataFrame:
    """Daily cases of the given case's month (by start) that end no later than it.

    ``cases`` carries ``is_cumulative``. The one chosen row meets the others in an equi-join on the month,
    so the cases are read twice, whatever they are derived from.
    """
    chosen = cases.filter(F.col("case_id") == case_id).select(
        truncate(F.col("start_time"), "MONTH").alias("_month"), F.col("end_time").alias("_end")
    )
    daily = cases.filter(F.col("is_cumulative") == 0).withColumn("_month", truncate(F.col("start_time"), "MONTH"))
    return daily.join(chosen, "_month").filter(F.col("end_time") <= F.col("_end")).select(cases.columns)


@dataclass(frozen=True)
class CaseSets:
    """The cases a report compares. Three ids at most are known by name, the month's cases are a relation
    (or a few ids the caller knows). ``span``: from the earliest start to the latest end of them all, which
    cuts fact tables that keep the time at the scan."""

    current: int
    previous: int | None
    opening: int | None
    month: DataFrame | Sequence[int]
    is_cumulative: bool
    span: tuple[str, str] | None = None

    @property
    def snapshots(self) -> list[int]:
        return sorted({c for c in (self.current, self.previous, self.opening) if c is not None})

    def months(self, spark: SparkSession) -> DataFrame:
        """case_id of the month set, each once."""
        if isinstance(self.month, DataFrame):
            return self.month.select(F.col("case_id").cast("int").alias("case_id")).distinct()
        return rows_table(spark, "case_id int", [[c] for c in sorted(set(self.month))])

    def flagged(self, spark: SparkSession) -> DataFrame:
        """case_id, of_day, of_month: the current case and the month set, each case once."""
        now = rows_table(spark, "case_id int, of_day int, of_month int", [[self.current, 1, 0]])
        month = self.months(spark).select("case_id", F.lit(0).alias("of_day"), F.lit(1).alias("of_month"))
        return now.unionByName(month).groupBy("case_id").agg(F.max("of_day").alias("of_day"), F.max("of_month").alias("of_month"))


def resolve_case_sets(cases: DataFrame, case_id: int) -> CaseSets:
    """The case, its predecessor, the daily cases of its month up to it and the case before the first of
    them. Single rows are looked up; the month's cases stay a relation, however many they are."""
    chosen = cases.filter(F.col("case_id") == case_id).take(1)
    if not chosen:
        raise ValueError(f"case {case_id} not found")
    row = chosen[0]
    month_start = row.start_time.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    to_date = cases.filter(
        (F.col("is_cumulative") == 0)
        & (F.col("start_time") >= ntz(str(month_start)))
        & (F.col("end_time") <= ntz(str(row.end_time)))
        & (F.col("start_time") < shift(ntz(str(month_start)), "MONTH", 1))
    )
    opening = to_date.agg(F.min_by("prev_case_id", "case_id")).first()[0]
    own = row.is_cumulative == 1
    previous = opening if own else row.prev_case_id
    known = [c for c in (case_id, previous, opening) if c is not None]
    first, last = cases.filter(F.col("case_id").isin(known)).agg(F.min("start_time"), F.max("end_time")).first()
    span = (str(min(first, month_start)), str(max(last, row.end_time)))
    return CaseSets(case_id, previous, opening, (case_id,) if own else to_date.select("case_id"), own, span)


def case_sets(cases: DataFrame, case_id: int) -> DataFrame:
    """(role, case_id) for roles current, previous, month, opening; unknown predecessors are left out.

    A cumulative case is its own month set, and its previous case is the month opening.
    """
    sets, spark = resolve_case_sets(cases, case_id), cases.sparkSession
    single = [("current", sets.current), ("previous", sets.previous), ("opening", sets.opening)]
    rows = rows_table(spark, "role string, case_id int", [r for r in single if r[1] is not None])
    return rows.unionByName(sets.months(spark).select(F.lit("month").alias("role"), "case_id"))
