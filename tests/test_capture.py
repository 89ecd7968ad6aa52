"""Changes between two states: pairs, columns, nulls, repeated keys and rows; what follows from them."""

import random
from collections import Counter

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.operators import capture as C
from ledgerlens.operators import ledger as L

STATE = "id int, case_id int, measured double, note string"
KEYS = ["id", "case_id"]


def state(spark, *rows):
    return spark.createDataFrame(list(rows), STATE)


def shown(out):
    rows = out.select("operation", "id", "case_id", "deleted", "inserted", "changed").collect()
    return sorted(((r[0], r[1], r[2], r[3] and tuple(r[3]), r[4] and tuple(r[4]), tuple(r[5])) for r in rows), key=repr)


def test_pairs_and_the_columns_that_changed(spark):
    before = state(spark, (1, 10, 1.0, "a"), (2, 10, 2.0, "b"), (3, 10, None, None), (4, 10, 4.0, "d"), (5, 10, 5.0, None))
    after = state(spark, (1, 10, 1.0, "a"), (2, 10, 2.5, "b"), (3, 10, 3.0, "c"), (6, 10, 6.0, "f"), (5, 10, None, None))
    assert shown(C.captured(before, after, ["id", "case_id"])) == [
        ("delete", 4, 10, (4, 10, 4.0, "d"), None, ()),
        ("insert", 6, 10, None, (6, 10, 6.0, "f"), ()),
        ("update", 2, 10, (2, 10, 2.0, "b"), (2, 10, 2.5, "b"), ("measured",)),
        ("update", 3, 10, (3, 10, None, None), (3, 10, 3.0, "c"), ("measured", "note")),
        ("update", 5, 10, (5, 10, 5.0, None), (5, 10, None, None), ("measured",)),
    ]


def test_repeated_and_null_keys_are_never_paired(spark):
    before = state(spark, (1, 10, 1.0, "x"), (1, 10, 2.0, "x"), (2, 10, 1.0, "y"), (2, 10, 1.0, "y"), (None, 10, 1.0, "z"), (3, 10, 1.0, "k"), (3, 10, 9.0, "k"))
    after = state(spark, (1, 10, 3.0, "x"), (1, 10, 4.0, "x"), (2, 10, 1.0, "y"), (None, 10, 2.0, "z"), (3, 10, 1.0, "k"), (3, 10, 8.0, "k"))
    assert shown(C.captured(before, after, ["id", "case_id"])) == sorted([
        ("delete", 1, 10, (1, 10, 1.0, "x"), None, ()), ("delete", 1, 10, (1, 10, 2.0, "x"), None, ()),
        ("insert", 1, 10, None, (1, 10, 3.0, "x"), ()), ("insert", 1, 10, None, (1, 10, 4.0, "x"), ()),
        ("delete", 2, 10, (2, 10, 1.0, "y"), None, ()),
        ("delete", None, 10, (None, 10, 1.0, "z"), None, ()), ("insert", None, 10, None, (None, 10, 2.0, "z"), ()),
        ("update", 3, 10, (3, 10, 9.0, "k"), (3, 10, 8.0, "k"), ("measured",)),
    ], key=repr)


def some(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(12)]), rng.randrange(2), rng.choice([None, 1.0, 2.0]), rng.choice(["a", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_what_is_captured_turns_one_state_into_the_other(spark, seed):
    old, new = some(seed, 60), some(seed + 10, 70)
    before, after = state(spark, *old), state(spark, *new)
    changes = C.captured(before.select("note", "measured", "id", "case_id"), after, ["id", "case_id"])
    got = Counter(tuple(r) for r in C.applied(before, changes).collect())
    assert got == Counter(new)
    rows = shown(changes)
    assert Counter(r[3] for r in rows if r[3]) == Counter(old) - Counter(new) and Counter(r[4] for r in rows if r[4]) == Counter(new) - Counter(old)


def test_equal_and_empty_states(spark):
    rows = state(spark, *some(1, 20))
    assert shown(C.captured(rows, rows, KEYS)) == [] == shown(C.captured(state(spark), state(spark), KEYS))
    assert {r[0] for r in shown(C.captured(state(spark), rows, KEYS))} == {"insert"}
    with pytest.raises(ValueError, match="different columns"):
        C.captured(rows.drop("note"), rows, ["id"])


def test_groups_follow_from_two_states(spark):
    members = spark.createDataFrame([(48, 1), (57, 1), (94, 1)], "id int, group_id int")
    before = state(spark, (48, 10, 1.0, "a"), (57, 10, None, "b"), (94, 10, 5.0, "c"), (48, 5, 1.0, "d"), (57, 11, 7.0, "e"))
    after = state(spark, (48, 10, 1.0, "A"), (57, 10, 4.0, "b"), (94, 10, 5.0, "c"), (48, 5, 2.0, "d"), (57, 11, None, "e"), (94, 11, 2.0, "n"))
    changes = C.captured(before, after, ["id", "case_id"])
    assert tuples(C.writes(changes, "measured", 2), "id", "case_id", "measured", "seq") == [
        (48, 5, 2.0, 2 * C.SPAN + 48), (57, 10, 4.0, 2 * C.SPAN + 57), (57, 11, None, 2 * C.SPAN + 57), (94, 11, 2.0, 2 * C.SPAN + 94)]
    synced = L.sync_group(after, C.writes(changes, "measured"), members, 10)
    assert tuples(synced, "id", "case_id", "measured", "synced") == [
        (48, 10, 4.0, 1), (48, 5, 2.0, 0), (57, 10, 4.0, 0), (57, 11, 2.0, 1), (94, 10, 4.0, 1), (94, 11, 2.0, 0)]
    log = L.change_log(C.writes(changes, "measured"), members, 10)
    assert log.filter("info like 'skipped%'").count() == 1 and log.filter("step = 0").count() == 4
    text = changes.select("id", C.described(changes, ["measured", "note"]).alias("text")).filter("text <> ''")
    assert tuples(text, "id", "text") == [(48, "measured: 1.0 -> 2.0"), (48, "note: a -> A"), (57, "measured: 7.0 -> null"), (57, "measured: null -> 4.0")]


def test_a_hot_key_does_not_meet_in_one_task(spark):
    before, after = (spark.range(n).select(F.lit(1).alias("id"), F.lit(1).alias("case_id"), F.col("id").cast("double").alias("measured")) for n in (2000, 3000))
    assert C.captured(before, after, ["id", "case_id"]).groupBy("operation").count().collect() == [("insert", 1000)]
    assert "Window" not in C.captured(before, after, ["id", "case_id"])._jdf.queryExecution().executedPlan().toString()
