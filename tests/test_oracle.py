"""Every registered query against its SQL on the driver tables, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from check import oracle_connection, rows_of
from ledgerlens import bindings

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


# the corpus operators have their own tests
OWN = bindings.queries()


def test_every_query_has_an_oracle():
    assert set(OWN) == set(bindings.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    rel = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got, want = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(rel.columns, rel.fetchall())
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
