"""Stored partial sums: equal to the full run whatever came when, and what is read and written."""

import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.plans.totals import Totals, month_to_date

FACTS = "case_id int, product string, div string, amount double"


def some(seed, n=300):
    rng = random.Random(seed)
    days = [20240100 + d for d in range(1, 32)] + [20240200 + d for d in range(1, 30)] + [20240301]
    return [(rng.choice(days), rng.choice(["oil", "tar", None]), rng.choice("NS"), rng.choice([None, 0.1, 2.5, 1e9])) for _ in range(n)]


def totals(spark, path):
    return Totals(spark, str(path), ("product", "div"), ("amount",), F.expr("case_id div 100").cast("int"))


def full(spark, rows):
    return tuples(spark.createDataFrame(rows, FACTS).groupBy("case_id", "product", "div").agg(F.sum(F.col("amount").cast("decimal(38,12)")).cast("decimal(18,3)").alias("amount")), "case_id", "product", "div", "amount")


def stored(spark, t):
    every = spark.createDataFrame([(c,) for c in {r[0] for r in some(0, 4000)} | {20240229}], "case_id int").withColumn("as_of", F.col("case_id"))
    return tuples(t.of(every, ["as_of"]), "as_of", "product", "div", "amount")


@pytest.mark.parametrize("seed", range(2))
def test_days_in_any_order_give_the_full_run(spark, tmp_path, seed):
    rows, t = some(seed), totals(spark, tmp_path / "t")
    days = sorted({r[0] for r in rows})
    random.Random(seed).shuffle(days)
    first, later = days[:50], days[50:]
    t.load(spark.createDataFrame([r for r in rows if r[0] in first], FACTS))
    for part in (later[:4], later[4:5], later[5:]):
        t.restate(spark.createDataFrame(rows, FACTS), part)  # rows of other cases don't count again
    assert stored(spark, t) == full(spark, rows)


def test_a_case_stated_anew_replaces_its_sums(spark, tmp_path):
    rows, t = some(5), totals(spark, tmp_path / "t")
    t.load(spark.createDataFrame(rows, FACTS))
    files = {p for p in (tmp_path / "t").rglob("*.parquet") if "month=202402" not in str(p)}
    changed = [(20240210, "oil", "N", 7.0), (20240210, "oil", "N", 1.0), (20240211, "new", "S", None)]
    t.restate(spark.createDataFrame(changed, FACTS), [20240210, 20240211, 20240212])  # the last one has no facts any more
    kept = [r for r in rows if r[0] not in (20240210, 20240211, 20240212)]
    assert stored(spark, t) == full(spark, kept + changed)
    assert {p for p in (tmp_path / "t").rglob("*.parquet") if "month=202402" not in str(p)} == files
    t.restate(spark.createDataFrame([], FACTS), [20240301])  # the only case of its month
    assert stored(spark, t) == full(spark, [r for r in kept + changed if r[0] != 20240301])


def test_the_first_day_makes_the_table_and_month_to_date_adds_up(spark, tmp_path):
    rows, t = [(20240101, "oil", "N", 1.0), (20240103, "oil", "N", 2.0), (20240201, "oil", "N", 4.0)], totals(spark, tmp_path / "t")
    assert not t.exists()
    for c in (20240103, 20240101, 20240201):
        t.restate(spark.createDataFrame(rows, FACTS), spark.createDataFrame([(c,)], "case_id int"))
    cases = spark.createDataFrame([(20240100 + d, 0) for d in (1, 2, 3)] + [(20240201, 0), (202401, 1)], "case_id int, is_cumulative int")
    got = tuples(t.of(month_to_date(cases), ["as_of"]).withColumn("amount", F.col("amount").cast("double")), "as_of", "amount")
    assert got == [(20240101, 1.0), (20240102, 1.0), (20240103, 3.0), (20240201, 4.0)]


def test_only_the_months_asked_for_are_read(spark, tmp_path):
    t = totals(spark, tmp_path / "t")
    t.load(spark.createDataFrame(some(7), FACTS))
    plan = t.of(spark.createDataFrame([(20240210,)], "case_id int"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "202402" in plan
