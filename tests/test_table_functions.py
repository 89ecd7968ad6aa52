"""Operators called from SQL: defaults, names, lateral use and its plan."""

import pytest
from conftest import at, tuples

from ledgerlens.operators import timeseries as T
from ledgerlens.sources.table_functions import overlap_function, table_function


@pytest.fixture
def stock(spark):
    rows = [(c, d, p, float(10 * c + i)) for c in (1, 2, 3) for d in ("N", "S") for i, p in enumerate(["oil", "tar", None])]
    df = spark.createDataFrame(rows, "case_id int, division string, product string, measured double")
    table_function("stock_of", df, {"case_id": ("int", "r.case_id = {}"), "division": ("string", "r.division = {}"), "product": ("string", "r.product LIKE {}")}, ("case_id",), {"division": "'N'"})
    table_function("stock_all", df, {"least": ("double", "r.measured >= {}"), "case_id": ("int", "r.case_id = {}")})
    return rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_defaults_and_named_parameters(spark, stock):
    def got(sql):
        return sorted((tuple(r) for r in spark.sql(sql).collect()), key=repr)

    want = lambda keep: sorted((r for r in stock if keep(*r)), key=repr)
    assert got("SELECT * FROM stock_of(2)") == want(lambda c, d, p, m: c == 2 and d == "N")
    assert got("SELECT * FROM stock_of(2, NULL)") == want(lambda c, d, p, m: c == 2)
    assert got("SELECT * FROM stock_of(1, product => 't%')") == want(lambda c, d, p, m: c == 1 and d == "N" and p == "tar")
    assert got("SELECT * FROM stock_all()") == want(lambda *r: True)
    assert got("SELECT * FROM stock_all(least => 21)") == want(lambda c, d, p, m: m >= 21)
    assert got("SELECT * FROM stock_of(NULL)") == []


def test_lateral_calls_are_equi_joins(spark, stock):
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW wanted AS SELECT * FROM VALUES (1, 'x'), (3, 'y'), (3, 'z'), (9, 'n'), (NULL, 'u') AS t(case_id, name)")
    out = spark.sql("SELECT w.name, t.* FROM wanted w, LATERAL stock_of(w.case_id, 'S') t")
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)
    assert sorted(tuple(r)[:2] for r in out.collect()) == [("x", 1)] * 3 + [("y", 3)] * 3 + [("z", 3)] * 3
    summed = spark.sql("SELECT w.name, s.total FROM wanted w, LATERAL (SELECT sum(measured) AS total FROM stock_of(w.case_id, NULL)) s")
    assert dict(summed.collect())["x"] == sum(m for c, _, _, m in stock if c == 1) and dict(summed.collect())["n"] is None


def test_filters_reach_the_scan(spark, table, tmp_path):
    table("case_id int, v double, w double", (1, 1.0, 2.0), (2, 2.0, 3.0)).write.parquet(str(tmp_path / "t"))
    table_function("stored_of", spark.read.parquet(str(tmp_path / "t")), {"case_id": ("int", "r.case_id = {}")})
    out = spark.sql("SELECT v FROM stored_of(2)")
    assert "EqualTo(case_id,2)" in plan(out) and "ReadSchema: struct<case_id:int,v:double>" in plan(out)
    assert out.collect() == [(2.0,)]
    assert spark.sql("SELECT v FROM stored_of()").count() == 2


def test_overlap_as_a_function(spark, table):
    rows = [(1, at("2024-01-01"), at("2024-01-05")), (2, at("2024-01-04"), None), (3, at("2024-01-09"), at("2024-01-02")), (4, None, None), (5, at("2024-02-01"), at("2024-02-02"))]
    df = table("id int, start_time timestamp_ntz, end_time timestamp_ntz", *rows)
    overlap_function("live", df)
    for a, b in [("2024-01-05", "2024-01-09"), ("2024-01-03", "2024-01-03"), ("2024-02-02", "2024-03-01"), ("2023-01-01", "2023-02-01")]:
        got = spark.sql(f"SELECT id FROM live(TIMESTAMP_NTZ '{a}', TIMESTAMP_NTZ '{b}')")
        assert tuples(got, "id") == tuples(T.interval_overlap(df, a, b), "id")
    assert tuples(spark.sql("SELECT id FROM live(until => TIMESTAMP_NTZ '2024-01-04')"), "id") == [(1,), (2,)]
    assert spark.sql("SELECT id FROM live()").count() == 4


def test_refused(spark, table):
    df = table("a int", (1,))
    with pytest.raises(ValueError, match="no name"):
        table_function("x; drop", df, {})
    with pytest.raises(ValueError, match="come first"):
        table_function("x", df, {"a": ("int", "r.a = {}"), "b": ("int", "r.a < {}")}, required=("b",))
    with pytest.raises(ValueError, match="no such"):
        table_function("x", df, {"a": ("int", "r.a = {}")}, required=("c",))
