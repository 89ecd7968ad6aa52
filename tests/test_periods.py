from conftest import at, tuples

from ledgerlens.operators import periods as P

CASES = "case_id int, analysis_id string, start_time timestamp_ntz, end_time timestamp_ntz, prev_case_id int"


def cases(table):
    rows = [
        (1, "D", at("2024-02-28"), at("2024-02-29"), None),
        (2, "D", at("2024-02-29"), at("2024-03-01"), 1),  # over the month end: belongs to February
        (3, "D", at("2024-03-01"), at("2024-03-02"), 2),
        (4, "D", at("2024-03-02"), at("2024-03-03"), 3),
        (5, "D", at("2024-03-03"), at("2024-03-04"), 4),
        (6, "M", at("2024-03-01"), at("2024-04-01"), None),
    ]
    return table(CASES, *rows)


def analyses(table):
    return table("analysis_id string, model_id string, name string", ("D", "md", "daily"), ("M", "mm", "cumulative"))


def kinded(table):
    return P.case_kind(cases(table), "analysis_id", "m")


def test_reporting_period_before_and_after_start_hour(spark, table):
    clock = table(
        "n int, ts timestamp_ntz", (1, at("2024-05-10 07:59:59")), (2, at("2024-05-10 08:00:00")), (3, at("2024-05-10 23:00:00"))
    )
    shifts = table("start_hour int, duration int", (20, 12), (8, 24))
    out = P.reporting_period(clock, "ts", shifts)
    assert tuples(out, "n", "period_start", "period_end") == [
        (1, at("2024-05-08 08:00"), at("2024-05-09 08:00")),
        (2, at("2024-05-09 08:00"), at("2024-05-10 08:00")),
        (3, at("2024-05-09 08:00"), at("2024-05-10 08:00")),
    ]


def test_select_cases_contained_and_exact(table):
    inside = P.select_cases(cases(table), analyses(table), "2024-03-01", "2024-03-03")
    assert tuples(inside, "case_id", "model_id") == [(3, "md"), (4, "md")]
    exact = P.select_cases(cases(table), analyses(table), "2024-03-01", "2024-04-01", exact=True)
    assert tuples(exact, "case_id") == [(6,)]


def test_case_kind_rules(table):
    span = P.case_kind(cases(table), "span")
    assert tuples(span.filter("is_cumulative = 1"), "case_id") == [(6,)]  # one day from the 1st is daily
    named = P.case_kind(cases(table).join(analyses(table), "analysis_id"), "name", "CUMULATIVE")
    assert tuples(named.filter("is_cumulative = 1"), "case_id") == [(6,)]


def test_day_difference_counts_midnights(table):
    rows = table(CASES, (1, "D", at("2024-03-01 23:00"), at("2024-03-03 01:00"), None))
    assert P.case_kind(rows, "span").first().is_cumulative == 1


def test_month_to_date_by_start(table):
    assert tuples(P.month_to_date_cases(kinded(table), 4), "case_id") == [(3,), (4,)]
    assert tuples(P.month_to_date_cases(kinded(table), 2), "case_id") == [(1,), (2,)]


def test_case_sets_daily_and_cumulative(table):
    assert tuples(P.case_sets(kinded(table), 4), "role", "case_id") == [
        ("current", 4), ("month", 3), ("month", 4), ("opening", 2), ("previous", 3),
    ]
    assert tuples(P.case_sets(kinded(table), 6), "role", "case_id") == [
        ("current", 6), ("month", 6), ("opening", 2), ("previous", 2),
    ]


def test_case_sets_without_predecessor(table):
    assert tuples(P.case_sets(kinded(table), 1), "role", "case_id") == [("current", 1), ("month", 1)]


def test_case_sets_missing_case(table):
    import pytest

    with pytest.raises(ValueError, match="case 99 not found"):
        P.case_sets(kinded(table), 99)


def test_period_filter_reaches_the_scan(spark, tmp_path, table):
    path = str(tmp_path / "cases")
    cases(table).write.parquet(path)
    plan = P.select_cases(spark.read.parquet(path), analyses(table), "2024-03-01", "2024-03-03")
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(start_time" in text and "LessThanOrEqual(end_time" in text
