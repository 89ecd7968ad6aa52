"""Incremental totals: one stored partial sum per case and key, put together for any set of cases."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import EXACT, MONEY, exact
from ..sources import merge
from ..sources.session import staged


@dataclass(frozen=True)
class Totals:
    """Sums of ``measures`` of facts per (case_id, ``keys``), stored under ``path`` by the month of the case.

    A new day adds the sums of its own facts; a case that is stated anew has its sums replaced, and so has one that lost its
    facts. Only the partial sums of the months concerned are read and written again, never the facts of other cases. Sums are
    exact, so totals are those of the facts in whatever order days came; a sum of nothing but nulls is null.

    ``month`` makes the month (an int such as 202403) out of case_id.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    measures: tuple[str, ...]
    month: Column

    def _partial(self, facts: DataFrame) -> DataFrame:
        sums = [F.sum(exact(m)).cast(EXACT).alias(m) for m in self.measures]
        return facts.groupBy("case_id", *self.keys).agg(*sums).withColumn("month", self.month)

    def _stored(self) -> DataFrame:
        return merge.Store(self.spark, self.path).rows()

    def exists(self) -> bool:
        return merge.Store(self.spark, self.path).exists()

    def load(self, facts: DataFrame) -> None:
        """The first load, of all there is."""
        merge.store(self._partial(facts), self.path, ["month"])

    def restate(self, facts: DataFrame, cases: DataFrame | Sequence[int]) -> None:
        """The sums of some cases out of ``facts``, which hold these cases' rows (rows of other cases are left out). Cases without
        rows lose their sums. Complete or not at all."""
        if not isinstance(cases, DataFrame):
            cases = self.spark.createDataFrame([(int(c),) for c in cases], "case_id int")
        cases = staged(cases.select(F.col("case_id").cast("int").alias("case_id")).distinct().withColumn("month", self.month), "restated")
        new = self._partial(facts.join(cases.select("case_id"), "case_id", "left_semi"))
        months = [r.month for r in cases.select("month").distinct().collect()]  # of a calendar
        if not self.exists():
            return merge.store(new, self.path, ["month"])
        merge.Store(self.spark, self.path).recover()
        kept = self._stored().filter(F.col("month").isin(months)).join(cases.select("case_id"), "case_id", "left_anti")
        merge.replace_partitions(kept.unionByName(new), self.path, ["month"], emptied=[{"month": m} for m in months])

    def of(self, cases: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Totals over a set of cases: ``by`` (columns of ``cases``), the keys and the measures as ledger amounts.

        ``cases``: case_id, and what it is grouped by; a case may stand in several groups, once in each. Partial sums of other
        months aren't read.
        """
        wanted = staged(cases.select("case_id", *by).distinct().withColumn("month", self.month), "total_cases")
        months = [r.month for r in wanted.select("month").distinct().collect()]
        held = self._stored().filter(F.col("month").isin(months)).drop("month")
        sums = [F.sum(m).cast(MONEY).alias(m) for m in self.measures]
        return held.join(wanted.drop("month"), "case_id").groupBy(*by, *self.keys).agg(*sums)


def month_to_date(cases: DataFrame) -> DataFrame:
    """(as_of, case_id): for every daily case the daily cases of its month up to it. ``cases``: case_id (as 20240131), is_cumulative."""
    days = cases.filter("is_cumulative = 0").select("case_id", F.expr("case_id div 100").alias("_month"))
    asked = days.select(F.col("case_id").alias("as_of"), "_month")
    return asked.join(days, "_month").filter(F.col("case_id") <= F.col("as_of")).select("as_of", "case_id")
