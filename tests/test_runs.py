"""Runs, the shared folder, and what reaches the scan."""

import os
import re

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerlens.operators import periods as P
from ledgerlens.operators import snapshots as S
from ledgerlens.plans import runs
from ledgerlens.sources import session as shared

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


def settings(table, *ids):
    objects = table("sf_id string, sf_name string", ("1", "T_1"), ("2", "M_1"))
    rows = [(i, "1", "TagID", 0) for i in ids] + [(i, "2", "TagID", 0) for i in ids]
    return table("settings string, af_element string, attribute string, is_deleted int", *rows), objects


def test_remains_run_loads_the_good_points_logs_the_others_and_raises(spark, table, tmp_path):
    states = table("sampling_point_id long, ts timestamp_ntz, mass double, name string", (5, at("2024-01-01"), None, None), (6, at("2024-01-01"), 2.0, "x"))
    paths = f"{tmp_path}/remains", f"{tmp_path}/errors"
    with pytest.raises(runs.RunError):
        runs.remains_run(*settings(table, "5", "five"), states, "2024-01-02 00:00:00", *paths)
    assert tuples(spark.read.parquet(paths[0]), "sampling_point_id", "mass", "name") == [(5, 0.0, "")]
    assert tuples(spark.read.parquet(paths[1]), "error_message") == [("id of a sampling point is no number: five",)]
    again = runs.remains_run(*settings(table, "5", "6"), states, "2024-01-02 00:00:00", *paths)
    assert tuples(again, "sampling_point_id", "mass", "name") == [(5, 0.0, ""), (6, 2.0, "x")]


def test_rows_are_told_apart_and_counted_in_one_pass(spark, table, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = table("id string", ("5",), ("x",), (None,), ("7",), ("7",)).mapInArrow(counted, "id string")
    split = S.split_once(rows, {"no number": F.col("id").try_cast("int").isNotNull(), "too large": F.col("id") != "7"})
    assert (split.rows, split.failed) == (5, 4)
    assert tuples(split.good, "id") == [("5",)]
    assert tuples(split.bad, "id", "error_message") == [("7", "too large"), ("7", "too large"), ("x", "no number"), (None, "no number; too large")]
    assert read.value == 5
    nothing = S.split_once(rows.limit(0), {"never": F.lit(False)})
    assert (nothing.rows, nothing.failed, nothing.good.count(), nothing.bad.count()) == (0, 0, 0, 0)


def test_remains_run_reads_the_settings_once(spark, table, tmp_path):
    path = str(tmp_path / "settings")
    made, objects = settings(table, "5", "five", "6")
    made.write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    states = table("sampling_point_id long, ts timestamp_ntz, mass double, name string", (5, at("2024-01-01"), None, None))
    with pytest.raises(runs.RunError, match="1 of 3"):
        runs.remains_run(spark.read.parquet(path).mapInArrow(counted, made.schema), objects, states, "2024-01-02 00:00:00", f"{tmp_path}/r", f"{tmp_path}/e")
    assert read.value == made.count()


def test_accumulation_run_fails_before_it_writes(spark, table, tmp_path):
    cases = table("case_id int, start_time timestamp_ntz, end_time timestamp_ntz", (1, at("2024-01-01"), at("2024-01-03")), (2, at("2024-01-01"), at("2024-01-01")))
    readings = table("tag_id string, ts timestamp_ntz, value double", ("5", at("2024-01-01 05:00"), 2.0), ("5", at("2024-01-02 23:00"), 3.0), ("5", at("2024-01-03"), 9.0))
    path = str(tmp_path / "out")
    for case, ids, message in ((3, ["5"], "no start"), (2, ["5"], "no whole day"), (1, [" "], "no tags")):
        with pytest.raises(ValueError, match=message):
            runs.accumulation_run(case, cases, *settings(table, *ids), readings, path)
    assert not os.path.exists(path)
    assert tuples(runs.accumulation_run(1, cases, *settings(table, "5", "7"), readings, path), "tag_id", "accumulation") == [("5", 5.0), ("7", 0.0)]


def test_a_failed_restore_leaves_the_current_table(spark, table, tmp_path):
    current = f"{tmp_path}/current"
    table("ts timestamp_ntz, value double", (at("2024-01-01"), 1.0)).write.parquet(current)
    bad = table("ts timestamp_ntz, value double, run_date date", (at("2024-02-01"), 2.0, at("2024-02-01").date()))
    bad.withColumn("value", F.raise_error(F.lit("broken")).cast("double")).createOrReplaceTempView("bad")
    with pytest.raises(Exception):
        runs._reloaded(spark.table("bad"), current)
    assert tuples(spark.read.parquet(current), "value") == [(1.0,)]


def test_a_month_of_many_cases(spark, table):
    """No bound on the cases of a month: they stay a relation."""
    rows = [(i, 0, at("2024-01-02"), at("2024-01-03"), i - 1) for i in range(1, 1001)]
    cases = spark.createDataFrame(rows, "case_id int, is_cumulative int, start_time timestamp_ntz, end_time timestamp_ntz, prev_case_id int")
    sets = P.resolve_case_sets(cases, 500)
    assert sets.months(spark).count() == 1000 and (sets.previous, sets.opening) == (499, 0)
    assert sets.span == ("2024-01-01 00:00:00", "2024-01-03 00:00:00")


def test_without_a_named_folder_there_is_a_plain_error(spark, monkeypatch):
    class Unnamed:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            getConf = staticmethod(dict)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(Unnamed)


def test_tuning_leaves_the_sessions_writes_and_times_alone(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.sources.partitionOverwriteMode", "spark.sql.session.timeZone", "spark.checkpoint.dir")}
    shared.tune(spark)
    assert before == {k: spark.conf.get(k, None) for k in before}


def scans(df, table):
    """Pushed filters of every scan of a driver table."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "3000")
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet[^\n]*?PushedFilters: \[([^\]]*)\]", text)


@needs_tables
@pytest.mark.parametrize("name, most", [("tank_balance", 1), ("tank_scope", 1), ("warehouse_topup", 2), ("topped_up_balances", 1), ("shipment_totals", 2)])
def test_scans_of_line_items(spark, name, most):
    assert 1 <= len(scans(entry.queries()[name](spark, SF), "lineitem")) <= most


@needs_tables
@pytest.mark.parametrize("name", ["snapshots_by_role", "production_from_balance", "compare_snapshots", "append_missing_opening", "blend_balance_daily"])
def test_the_cases_time_reaches_the_scan(spark, name):
    found = scans(entry.queries()[name](spark, SF), "lineitem")
    assert found and all("GreaterThanOrEqual(l_shipdate" in f and "LessThanOrEqual(l_shipdate" in f for f in found)


@needs_tables
@pytest.mark.parametrize("name, table", [("flow_total", "orders"), ("meter_adjustment", "orders")])
def test_the_cases_time_reaches_the_values(spark, name, table):
    assert any("GreaterThanOrEqual(o_orderdate" in f for f in scans(entry.queries()[name](spark, SF), table))


@needs_tables
def test_month_to_date_reads_orders_twice(spark):
    assert len(scans(entry.queries()["month_to_date_cases"](spark, SF), "orders")) <= 2


@needs_tables
def test_calls_of_the_balance_function_share_one_reading(spark):
    assert not scans(entry.queries()["tank_balance_function"](spark, SF), "lineitem")
