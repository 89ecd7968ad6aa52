import random

from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.operators import ledger as L
from ledgerlens.streaming import sync

TX = "id int, a int, b int, measured double, reconciled double"


def test_lookup_measure_takes_the_ordered_first_and_null_when_absent(table):
    tasks = table("task_id int, k1 int, k2 int", (1, 5, 6), (2, 9, 9))
    view = table("x int, y int, row int, measured double", (5, 6, 2, 20.0), (5, 6, 1, 10.0))
    out = L.lookup_measure(tasks, view, {"k1": "x", "k2": "y"}, "measured", "row")
    assert tuples(out, "task_id", "new_value") == [(1, 10.0), (2, None)]


def test_reassign_measure(table):
    tx = table(TX, (3, 1, 1, 7.0, 7.0), (2, 1, 1, 8.0, 8.0), (4, 1, 2, 9.0, 9.0), (5, 2, 2, 1.0, 1.0), (1, 1, 1, 6.0, 6.0)).selectExpr("1 AS case_id", "*")
    live = tx.filter("id <> 1")  # row 1 matches the key but is not alive
    tasks = table(
        "task_id int, ta int, tb int, new_value double",
        (1, 1, 1, 100.0), (2, 1, 2, None), (3, 8, 8, 50.0), (4, 2, 2, 5.0), (5, 2, 2, 6.0),
    )
    out = L.reassign_measure(tx, live, tasks, {"ta": "a", "tb": "b"})
    assert tuples(out, "id", "measured", "reconciled") == [
        (1, 6.0, 6.0), (2, 100.0, 0.0), (3, 0.0, 0.0), (4, 9.0, 9.0), (5, 6.0, 0.0),
    ]


def test_reassign_measure_changes_only_matched_rows_of_a_case(table):
    """Ids recur across cases, live rows are listed twice: the output has the input's rows."""
    schema = "case_id int, id int, a int, b int, measured double, reconciled double"
    tx = table(schema, (1, 1, 1, 1, 7.0, 7.0), (1, 2, 1, 1, 8.0, 8.0), (2, 1, 1, 1, 9.0, 9.0), (2, 2, 5, 5, 3.0, 3.0), (3, 1, 1, 1, 4.0, 4.0))
    live = tx.filter("case_id < 3")
    tasks = table("task_id int, ta int, tb int, new_value double", (1, 1, 1, 100.0))
    out = L.reassign_measure(tx, live.unionByName(live), tasks, {"ta": "a", "tb": "b"})
    assert tuples(out, "case_id", "id", "measured", "reconciled") == [
        (1, 1, 100.0, 0.0), (1, 2, 0.0, 0.0), (2, 1, 100.0, 0.0), (2, 2, 3.0, 3.0), (3, 1, 4.0, 4.0),
    ]
    of_one = L.reassign_measure(tx, live.filter("case_id = 1"), tasks, {"ta": "a", "tb": "b"})
    assert tuples(of_one.filter("case_id <> 1"), "id", "measured") == [(1, 4.0), (1, 9.0), (2, 3.0)]


def test_live_transactions(table):
    tx = table(
        "id int, case_id int, source_id int, dest_id int, product_id int, second_product_id int",
        (1, 10, 21, 31, 1, 2), (2, 10, 21, 31, 1, 3), (3, 10, 22, 31, 1, 2), (4, 10, 23, 31, 1, 2),
        (5, 10, 21, 32, 1, 2), (6, 11, 21, 31, 1, 2), (7, 10, 21, 31, 1, 2),
    )
    cases = table("case_id int, analysis_id string", (10, "D"), (11, "M"))
    analyses = table("analysis_id string, name string", ("D", "daily"), ("M", "cumulative"))
    objects = table(
        "id int, object_type_id int, is_deleted int",
        *[(i, None, 0) for i in (1, 2, 3, 4, 5, 6)], (7, None, 1), (21, 1, 0), (22, 2, 0), (23, 1, 1), (31, 3, 0), (32, 3, 1),
    )
    types = table("id int, code_name string", (1, "Tank"), (2, "Pipe"), (3, "Pipe"))
    products = table("id int, is_deleted int", (1, 0), (2, 0), (3, 1))
    out = L.live_transactions(tx, cases, analyses, objects, types, products, "daily", ["Tank", "Node"])
    assert tuples(out, "id") == [(1,)]
    assert L.live_transactions(tx, cases, analyses, objects, types, products, "daily", ["Tank"], case_id=11).count() == 0


def brute_rules(rules, facts):
    out = {}
    for p1, p2, src, dst, flag, target in rules:
        for a, b, c, d, is_input, value in facts:
            if p1 in (0, a) and p2 in (0, b) and src in (0, c) and dst in (0, d) and is_input == (flag or 0):
                out[target] = out.get(target, 0) + (value or 0)
    return out


def test_wildcard_rules_against_brute_force(spark):
    rng = random.Random(3)
    keys = ["p1", "p2", "src", "dst"]
    facts = [(*[rng.randrange(0, 4) for _ in keys], rng.randrange(2), rng.choice([None, 1.5, 2.0, 4.25])) for _ in range(400)]
    facts += [(1, 1, 1, 1, 1, 0.5)] * 200  # one hot key
    rules = [(*[rng.randrange(0, 4) for _ in keys], rng.choice([None, 0, 1]), rng.randrange(5)) for _ in range(40)]
    f = spark.createDataFrame(facts, "p1 int, p2 int, src int, dst int, is_input int, reconciled double")
    want = brute_rules(rules, facts)

    def got(r):
        return {x.target_id: x.sum_value for x in L.wildcard_rule_sum(r, f, keys, "is_input", "reconciled").collect()}

    assert got([dict(zip([*keys, "is_input", "target_id"], r)) for r in rules]) == want
    as_table = spark.createDataFrame(rules, "p1 int, p2 int, src int, dst int, is_input int, target_id int")
    assert got(as_table) == want


def test_no_wildcard_rules_no_sums(table):
    facts = table("k int, is_input int, v double", (1, 0, 2.0))
    assert L.wildcard_rule_sum([], facts, ["k"], "is_input", "v").collect() == []


def test_wildcard_targets_without_facts_disappear(table):
    facts = table("k int, is_input int, v double", (1, 0, 2.0))
    rules = [{"k": 1, "is_input": None, "target_id": 7}, {"k": 2, "is_input": 0, "target_id": 8}]
    assert tuples(L.wildcard_rule_sum(rules, facts, ["k"], "is_input", "v"), "target_id", "sum_value") == [(7, 2.0)]


LEDGER = "id int, case_id int, name string, open_mass double, coming_mix double, end_mass double, measured_day double, measured_accum double"


def test_apply_incoming_then_override_reads_the_new_sum(table):
    ledger = table(
        LEDGER, (1, 1, "mix a", 10.0, 0.0, 0.0, 3.0, 30.0), (2, 2, "mix b", 10.0, 0.0, 0.0, None, None), (3, 1, "mix c", 1.0, 5.0, 9.0, 1.0, 1.0)
    )
    kinds = table("case_id int, is_cumulative int", (1, 0), (2, 1))
    sums = table("target_id int, sum_value double", (1, 4.0), (2, 6.0))
    out = L.apply_incoming(ledger, sums, kinds)
    assert tuples(out, "id", "coming_mix", "end_mass") == [(1, 4.0, 11.0), (2, 6.0, 16.0), (3, 5.0, 9.0)]
    assert tuples(L.apply_incoming(ledger, sums, kinds, case_id=1), "id", "coming_mix")[1] == (2, 0.0)
    fixed = L.override_rows(
        out, F.col("name").like("%mix a%"), {"open_mass": 0, "measured_day": F.col("coming_mix"), "end_mass": 0}
    )
    assert tuples(fixed, "id", "open_mass", "measured_day", "end_mass")[0] == (1, 0.0, 4.0, 0.0)


def test_upsert_reads_the_row_as_it_was(table):
    target = table("k string, a double, b double", ("x", 1.0, 10.0), ("y", 2.0, 20.0), (None, 3.0, 30.0))
    source = table("key string, v double", ("x", 5.0), ("z", None))
    out = L.upsert_measures(
        target, source, ("k", "key"), {"a": F.col("v"), "b": F.col("a") + F.col("v")}, {"a": F.col("v")}, {"b": 0}
    )
    assert tuples(out, "k", "a", "b") == [("x", 5.0, 6.0), ("y", 2.0, 20.0), ("z", None, 0.0), (None, 3.0, 30.0)]


METERS = "id int, case_id int, measured double"
CHANGES = "id int, case_id int, measured double, seq int"
MEMBERS = "id int, group_id int"


def sync_tables(table):
    meters = table(METERS, (48, 10, 1.0), (57, 10, None), (94, 10, 5.0), (48, 11, 1.0), (57, 11, 2.0), (48, 5, 1.0), (57, 5, 2.0), (1, 10, 9.0))
    changes = table(CHANGES, (57, 10, 4.0, 1), (48, 10, 5.0, 2), (1, 10, 77.0, 3), (48, 5, 8.0, 4), (94, 11, None, 5))
    return meters, changes, table(MEMBERS, (48, 1), (57, 1), (94, 1))


def test_sync_group_latest_per_case_and_cut_off(table):
    meters, changes, members = sync_tables(table)
    out = L.sync_group(meters, changes, members, min_case=10)
    assert tuples(out, "id", "case_id", "measured", "synced") == [
        (1, 10, 9.0, 0), (48, 10, 5.0, 1), (48, 11, 1.0, 0), (48, 5, 1.0, 0),
        (57, 10, 5.0, 1), (57, 11, 2.0, 0), (57, 5, 2.0, 0), (94, 10, 5.0, 0),
    ]
    again = L.sync_group(out.drop("synced"), changes, members, min_case=10)
    assert again.filter("synced = 1").count() == 0


def test_change_log(table):
    _, changes, members = sync_tables(table)
    out = L.change_log(changes, members, 10)
    assert tuples(out.filter("seq in (1, 3, 4)"), "seq", "step", "info") == [
        (1, 0, "started"), (1, 2, "applied: value 4.0, case 10"), (1, 3, "finished"),
        (3, 0, "started"), (3, 3, "finished"),
        (4, 0, "started"), (4, 1, "skipped: case 5 < 10"),
    ]


def test_stream_equals_batch_and_replay_changes_nothing(spark, table, tmp_path):
    meters, changes, members = sync_tables(table)
    source, sink = str(tmp_path / "in"), str(tmp_path / "sink")
    changes.repartition(5).write.parquet(source)

    def run(progress):
        stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(source)
        sync.sync_group_stream(stream, members, 10, sink, str(tmp_path / progress)).awaitTermination()
        return tuples(sync.synced_meters(meters, members, sink), "id", "case_id", "measured")

    want = tuples(L.sync_group(meters, changes, members, 10), "id", "case_id", "measured")
    assert run("first") == want
    assert run("second") == want  # every batch again, from the start


def test_stream_before_the_first_change_and_over_many_batches(spark, table, tmp_path):
    meters, changes, members = sync_tables(table)
    sink = str(tmp_path / "sink")
    assert tuples(sync.synced_meters(meters, members, sink).filter("synced = 1"), "id") == []
    source = str(tmp_path / "in")
    changes.repartition(5).write.parquet(source)
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(source)
    sync.sync_group_stream(stream, members, 10, sink, str(tmp_path / "progress")).awaitTermination()
    assert len(list((tmp_path / "sink").glob("state=*"))) <= 2  # states don't pile up
    assert sync.stored_changes(spark, sink).count() == sync.stored_changes(spark, sink).select("case_id", "group_id").distinct().count()
