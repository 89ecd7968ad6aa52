import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from ledgerlens.operators import snapshots as S
from ledgerlens.sources import sinks


def test_fill_defaults_by_type_keeps_the_id(table):
    rows = table(
        "id int, name string, mass double, ok boolean, ts timestamp_ntz", (None, None, None, None, None), (1, "a", 2.0, True, at("2024-01-01"))
    )
    out = S.fill_defaults(rows, S.typed_defaults(rows, skip=["id"]))
    assert tuples(out, "id", "name", "mass", "ok", "ts") == [
        (1, "a", 2.0, True, at("2024-01-01")), (None, "", 0.0, False, at("1900-01-01")),
    ]


def test_dedupe_exact_keeps_smallest_name_and_treats_nulls_as_equal(table):
    rows = table("tag int, position string, amount double, full_name string", (1, "p", 2.0, "b"), (1, "p", 2.0, "a"), (None, "p", None, "z"), (None, "p", None, "y"))
    once = S.dedupe_exact(rows, ["tag", "position", "amount"], ["full_name"])
    assert tuples(once, "tag", "full_name") == [(1, "a"), (None, "y")]
    assert tuples(S.dedupe_exact(once, ["tag", "position", "amount"], ["full_name"]), "tag", "full_name") == [(1, "a"), (None, "y")]


def test_dedupe_ranked(table):
    rows = table("id int, type int, case_id int", (1, 1024, 9), (1, None, 8), (1, 5, 3), (1, 5, 4), (2, 1024, 1), (2, None, 0))
    order = [F.when(F.col("type") == 1024, 1).otherwise(0), F.when(F.col("type").isNull(), 1).otherwise(0), -F.col("case_id")]
    assert tuples(S.dedupe_ranked(rows, "id", order), "id", "type", "case_id") == [(1, 5, 4), (2, None, 0)]


def test_latest_per_key(table):
    rows = table("id int, log_id int, text string", (1, 7, "old"), (3, 7, "new"), (2, 8, "only"))
    assert tuples(S.latest_per_key(rows, "log_id", "id"), "log_id", "text") == [(7, "new"), (8, "only")]


def test_require(table):
    rows = table("n int", (1,), (0,))
    assert S.require(rows, "none").count() == 2
    with pytest.raises(ValueError, match="no case"):
        S.require(rows.filter("n > 5"), "no case")
    with pytest.raises(Exception, match="wrong number of days"):
        S.require(rows, "wrong number of days", F.col("n") >= 1).collect()


def test_quarantine_names_every_failed_check_and_unknown_fails(table):
    good, bad = S.quarantine(table("n int", (5,), (-1,), (None,)), {"negative": F.col("n") >= 0, "small": F.col("n") > -5})
    assert tuples(good, "n") == [(5,)]
    assert tuples(bad, "n", "error_message") == [(-1, "negative"), (None, "negative; small")]


BACKUP = "tag string, value double, ts timestamp_ntz"


def test_replace_day_strict_twice_is_once(spark, table):
    kept = table(BACKUP + ", run_date date", ("a", 1.0, at("2024-01-01 09:00"), at("2024-01-01").date()), ("a", 2.0, at("2024-01-02 07:00"), at("2024-01-01").date()))
    new = table(BACKUP, ("a", 10.0, at("2024-01-01 09:00")), ("a", 20.0, at("2024-01-02 07:00")))
    once = S.replace_day(kept, new, "ts", "2024-01-01")
    twice = S.replace_day(once, new, "ts", "2024-01-01")
    assert tuples(once, "value") == tuples(twice, "value") == [(10.0,), (20.0,)]


def test_replace_day_by_date_repeats_rows_past_midnight(table):
    kept = table(BACKUP, ("a", 1.0, at("2024-01-01 09:00")), ("a", 2.0, at("2024-01-02 07:00")))
    new = table(BACKUP, ("a", 1.0, at("2024-01-01 09:00")), ("a", 2.0, at("2024-01-02 07:00")))
    assert tuples(S.replace_day(kept, new, "ts", "2024-01-01", strict=False), "value") == [(1.0,), (2.0,), (2.0,)]


def test_restore_range_is_half_open(table):
    rows = table(BACKUP, ("a", 1.0, at("2024-05-15")), ("a", 2.0, at("2024-05-18 23:59:59")), ("a", 3.0, at("2024-05-19")), ("a", 4.0, at("2024-05-14 23:59")))
    assert tuples(S.restore_range(rows, 2024, 5, 15, 4), "value") == [(1.0,), (2.0,)]


def test_full_reload_replaces_and_may_read_its_target(spark, table, tmp_path):
    path = str(tmp_path / "current")
    sinks.full_reload(table("n int", (1,), (2,)), path)
    sinks.full_reload(spark.read.parquet(path).filter("n = 2"), path)
    assert tuples(spark.read.parquet(path), "n") == [(2,)]
    with pytest.raises(Exception):
        sinks.full_reload(table("n int", (1,)).select(F.raise_error(F.lit("stop")).alias("n")), path)
    assert tuples(spark.read.parquet(path), "n") == [(2,)]  # a failed load leaves the old content


def test_replace_day_sink_touches_one_partition(spark, table, tmp_path):
    path = str(tmp_path / "backup")
    sinks.replace_day(table("n int", (1,)), path, "2024-01-01")
    sinks.replace_day(table("n int", (2,)), path, "2024-01-02")
    sinks.replace_day(table("n int", (3,)), path, "2024-01-02")
    assert tuples(spark.read.parquet(path), "n") == [(1,), (3,)]


def test_error_log(spark, table, tmp_path):
    _, bad = S.quarantine(table("n int", (-1,)), {"negative": F.col("n") >= 0})
    path = str(tmp_path / "errors")
    sinks.append_errors(bad, path)
    sinks.append_errors(bad, path)
    assert tuples(spark.read.parquet(path), "error_message") == [("negative",), ("negative",)]
