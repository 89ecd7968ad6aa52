"""Copy-on-write: what is rewritten, what stays, failures before and while a change is moved in."""

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.operators import ledger as L
from ledgerlens.plans import runs
from ledgerlens.sources import merge

ROWS = [(f"k{i}", ["a", "b:c/d", "e f", None][i % 4], i % 2, float(i)) for i in range(40)]
SCHEMA = "k string, part string, half int, v double"


def how(**changed):
    update, insert = {"v": F.col("w") + F.col("v")}, {"part": F.col("at"), "v": F.col("w")}
    return dict(on=("k", "key"), update=update, insert=insert, defaults={"half": 0}, by=["part", "half"]) | changed


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def beside(path):
    return [p.name for p in path.parent.iterdir() if p.name.startswith(path.name + "__")]


@pytest.fixture
def stored(spark, tmp_path):
    path = tmp_path / "table"
    merge.store(spark.createDataFrame(ROWS, SCHEMA).repartition(2), str(path), ["part", "half"])
    return path


def source(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, at string, w double")


def whole(spark, path):
    return tuples(spark.read.schema(SCHEMA).parquet(str(path)), "k", "part", "half", "v")


def expected(spark, rows):
    target = spark.createDataFrame(ROWS, SCHEMA)
    return tuples(L.upsert_measures(target, rows, *[how()[x] for x in ("on", "update", "insert", "defaults")]), "k", "part", "half", "v")


def test_only_touched_partitions_are_rewritten(spark, stored):
    before = files(stored)
    rows = source(spark, ("k1", "x", 10.0), ("k5", "x", 20.0), ("new1", "e f", 1.0), ("new2", "neu=1", 2.0), (None, None, 3.0))
    done = merge.merge_into(str(stored), rows, **how())
    assert done == {"rewritten": 1, "added_to": 3}
    assert whole(spark, stored) == expected(spark, rows)
    after = files(stored)
    kept = {f for f in before if not f.startswith("part=b%3Ac%2Fd")}
    assert kept <= after and not (before - kept) & after and beside(stored) == []


def test_null_partitions_and_a_second_merge(spark, stored):
    first, second = source(spark, ("k3", "x", 1.0), ("new", None, 5.0)), source(spark, ("new", "x", 7.0), ("k3", "x", 2.0))
    assert merge.merge_into(str(stored), first, **how())["rewritten"] == 1
    merge.merge_into(str(stored), second, **how())
    got = {r[0]: r for r in whole(spark, stored)}
    assert got["new"] == ("new", None, 0, 12.0) and got["k3"] == ("k3", None, 1, 6.0) and len(got) == 41


def test_nothing_to_do(spark, stored):
    before = files(stored)
    assert merge.merge_into(str(stored), source(spark), **how()) == {"rewritten": 0, "added_to": 0}
    assert files(stored) == before and whole(spark, stored) == expected(spark, source(spark))


def test_what_is_refused_changes_nothing(spark, stored):
    before = files(stored)
    with pytest.raises(ValueError, match="repeats"):
        merge.merge_into(str(stored), source(spark, ("k1", "x", 1.0), ("k1", "x", 2.0)), **how())
    with pytest.raises(ValueError, match="can't be updated"):
        merge.merge_into(str(stored), source(spark, ("k1", "x", 1.0)), **how(update={"half": F.lit(1)}))
    assert files(stored) == before and beside(stored) == []


def test_a_failure_while_writing_leaves_the_table(spark, stored):
    before = files(stored)
    broken = how(update={"v": F.raise_error(F.lit("stop")).cast("double")})
    with pytest.raises(Exception, match="stop"):
        merge.merge_into(str(stored), source(spark, ("k1", "x", 1.0)), **broken)
    assert files(stored) == before and whole(spark, stored) == expected(spark, source(spark))
    rows = source(spark, ("k2", "x", 1.0))
    merge.merge_into(str(stored), rows, **how())  # clears the rest of the failed one away
    assert whole(spark, stored) == expected(spark, rows) and beside(stored) == []


@pytest.mark.parametrize("steps", range(1, 12))
def test_a_crash_while_moving_is_made_good(spark, stored, monkeypatch, steps):
    """Stops after each possible rename: the table is as before or, once recovered, as after."""
    rows = source(spark, ("k1", "x", 10.0), ("k2", "x", 20.0), ("new1", "e f", 1.0), ("new2", "neu", 2.0))
    left = [steps]
    real = merge.Store._renamed

    def renamed(self, a, b):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("crash")
        real(self, a, b)

    monkeypatch.setattr(merge.Store, "_renamed", renamed)
    try:
        merge.merge_into(str(stored), rows, **how())
        crashed = False
    except OSError:
        crashed = True
    monkeypatch.setattr(merge.Store, "_renamed", real)
    merge.Store(spark, str(stored)).recover()
    assert whole(spark, stored) == expected(spark, rows) and beside(stored) == []
    assert crashed or steps > 5


@pytest.mark.parametrize("steps", range(1, 8))
def test_a_crash_while_partitions_are_replaced(spark, tmp_path, monkeypatch, steps):
    path = str(tmp_path / "t")
    merge.store(spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "c int, v double"), path, ["c"])
    left = [steps]
    real = merge.Store._renamed

    def renamed(self, a, b):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("crash")
        real(self, a, b)

    monkeypatch.setattr(merge.Store, "_renamed", renamed)
    try:
        merge.replace_partitions(spark.createDataFrame([(2, 5.0), (4, 6.0)], "c int, v double"), path, ["c"], emptied=[{"c": 3}, {"c": 9}])
    except OSError:
        pass
    monkeypatch.setattr(merge.Store, "_renamed", real)
    merge.Store(spark, path).recover()
    assert tuples(spark.read.parquet(path), "c", "v") == [(1, 1.0), (2, 5.0), (4, 6.0)] and beside(tmp_path / "t") == []


def test_replace_partitions_reads_its_own_table(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.replace_partitions(spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "c int, v double"), path, ["c"])
    before = files(tmp_path / "t")
    own = spark.read.parquet(path)
    assert merge.replace_partitions(own.filter("c = 2").select((F.col("v") * 10).alias("v"), "c"), path, ["c"], emptied=[{"c": 3}]) == 1
    assert tuples(spark.read.parquet(path), "c", "v") == [(1, 1.0), (2, 20.0)]
    assert {f for f in before if f.startswith("c=1")} < files(tmp_path / "t")


LEDGER = "id int, case_id int, name string, open_mass double, coming_mix double, end_mass double, measured_day double, measured_accum double"


def test_a_run_writes_its_own_case_only(spark, tmp_path):
    ledger = spark.createDataFrame([(i, 1 + i % 3, f"mix {i}", 10.0, 0.0, 0.0, 3.0, 30.0) for i in range(12)], LEDGER)
    facts = spark.createDataFrame([(1, 4, 0, 2.5), (1, 0, 0, 1.5), (2, 4, 0, 9.0)], "case_id int, s int, is_input int, received double")
    rules = [{"s": 4, "is_input": 0, "target_id": 3}, {"s": 0, "is_input": 0, "target_id": 0}]
    kinds = spark.createDataFrame([(1, 0), (2, 0)], "case_id int, is_cumulative int")

    def run(case, source, target, by_case):
        out = runs.incoming_run(case, rules, facts, ["s"], "is_input", "received", source, kinds, "mix 3%", str(tmp_path / target), by_case)
        return tuples(out, *ledger.columns)

    assert run(1, ledger, "by_case", True) == run(1, ledger, "whole", False)
    before = files(tmp_path / "by_case")
    stored = spark.read.schema(LEDGER).parquet(str(tmp_path / "by_case"))
    assert run(2, stored, "by_case", True) == run(2, spark.read.parquet(str(tmp_path / "whole")), "whole2", False)
    assert {f for f in before if not f.startswith("case_id=2")} <= files(tmp_path / "by_case")
    assert run(7, stored, "by_case", True) == tuples(spark.read.parquet(str(tmp_path / "whole2")), *ledger.columns)  # a case without rows
