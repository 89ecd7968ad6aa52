import random
from datetime import timedelta

import pytest
from conftest import at, tuples
from pyspark.sql import functions as F

from ledgerlens.operators import timeseries as T

READING = "tag string, ts timestamp_ntz, value double"


def test_interval_overlap_branches(table):
    rows = table(
        "id int, start_time timestamp_ntz, end_time timestamp_ntz",
        (1, at("2024-01-01"), at("2024-01-02")),  # before
        (2, at("2024-01-01"), at("2024-01-05")),  # ends on the lower bound
        (3, at("2024-01-06"), at("2024-01-06 12:00")),  # inside
        (4, at("2024-01-01"), at("2024-02-01")),  # spans
        (5, at("2024-01-01"), None),  # open
        (6, at("2024-01-10"), None),  # starts on the upper bound
        (7, at("2024-01-10 00:00:01"), None),  # after
    )
    out = T.interval_overlap(rows, "2024-01-05", "2024-01-10")
    assert tuples(out, "id") == [(2,), (3,), (4,), (5,), (6,)]
    times = T.boundary_times(out, "2024-01-05", "2024-01-10")
    assert [t.ts for t in times.orderBy("ts").collect()] == [
        at("2024-01-01"), at("2024-01-05"), at("2024-01-06"), at("2024-01-06 12:00"), at("2024-01-10"), at("2024-02-01"),
    ]


def test_tag_catalog_drops_empty_and_missing(table):
    docs = table(
        "object_id int, properties string",
        (1, '<Properties TagName="A"/>'), (1, '<Properties TagName="A"/>'), (2, "<Properties/>"),
        (3, '<Properties TagName=""/>'), (4, '<Properties Unit="t" TagName="B"/>'), (5, None),
    )
    assert tuples(T.tag_catalog(docs, "properties", "/Properties/@TagName"), "object_id", "tag") == [(1, "A"), (4, "B")]


def test_tag_catalog_parses_grouped_documents_only(table):
    docs = table("object_id int, properties string", (1, '<Properties TagName="A"/>'))
    plan = T.tag_catalog(docs, "properties", "/Properties/@TagName")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Aggregate"):]
    assert "xpath" not in below.split("\n", 1)[1]


def test_entity_tags_by_source_destination_and_both(table):
    transfers = table(
        "source_uid string, destination_uid string, source_node string, dest_node string",
        ("U1", "T1", "N1", "N2"), ("X1", "T2", "N3", "N3"), ("U1", "T1", "N1", "N2"),
    )
    entities = table("uid string, type string", ("U1", "Unit"), ("T1", "Tank"), ("T2", "Tank"), ("X1", "Other"))
    aliases = table(
        "alias_id string, alias_name string, node_id string, module_id string",
        ("a1", "Flow", "N1", None), ("a2", "Flow", "N2", None), ("a3", "Flow", "N3", None),
        ("a4", "Mass", None, "T1"), ("a5", "Level", None, "T1"), ("a6", "Mass", None, "U1"), ("a7", "Mass", None, "T2"),
    )
    attributes = table(
        "object_id string, properties string", *[(f"a{i}", f'<Properties TagName="t{i}"/>') for i in range(1, 8)]
    )
    out = T.entity_tags(transfers, entities, aliases, attributes, "Mass")
    # N3 belongs to a transfer without a unit; U1 is a module of a transfer that has a tank
    assert tuples(out, "tag", "object_type") == [
        ("t1", "Unit"), ("t2", "Unit"), ("t4", "Tank"), ("t6", "Tank"), ("t7", "Tank"),
    ]


def test_asof_edges(table):
    points = table(
        "tag string, ts timestamp_ntz",
        ("a", at("2024-01-01 00:00")), ("a", at("2024-01-01 10:00")), ("a", at("2024-01-05")), ("b", at("2024-01-05")), ("c", at("2024-01-05")),
    )
    readings = table(
        READING,
        ("a", at("2024-01-01 10:00"), 5.0),  # exactly at a point
        ("a", at("2024-01-01 10:30"), 6.0),
        ("b", at("2024-01-05 00:00:01"), 1.0),  # only later
        ("c", at("2024-01-04"), 2.0), ("c", at("2024-01-04 23:00"), None),  # last one is null
    )
    assert tuples(T.asof_last_value(points, readings), "tag", "ts", "value") == [
        ("a", at("2024-01-01 00:00"), 0.0), ("a", at("2024-01-01 10:00"), 5.0), ("a", at("2024-01-05"), 6.0),
        ("b", at("2024-01-05"), 0.0), ("c", at("2024-01-05"), 0.0),
    ]
    assert tuples(T.asof_last_value(points, readings, default=None).filter("tag = 'b'"), "value") == [(None,)]


@pytest.mark.parametrize("ranges", ["1", "4", "40"])
def test_asof_and_accumulate_against_brute_force_with_a_hot_tag(spark, ranges):
    """A hot tag takes several ranges; what was seen is carried from one to the next."""
    rng = random.Random(7)
    base = at("2024-01-01")
    moments = rng.sample(range(0, 4 * 86400, 60), 600)
    readings = [("hot", base + timedelta(seconds=s), rng.randrange(1000) / 8) for s in moments[:300]]
    readings += [(f"t{i % 20}", base + timedelta(seconds=s), rng.randrange(1000) / 8) for i, s in enumerate(moments[300:])]
    points = [
        (i, rng.choice(["hot", "hot", "t1", "t2", "none"]), base + timedelta(seconds=rng.randrange(0, 5 * 86400)))
        for i in range(200)
    ]
    start = "2024-01-02 03:00:00"
    p = spark.createDataFrame(points, "id int, tag string, ts timestamp_ntz")
    r = spark.createDataFrame(readings, READING)

    def last(tag, ts):
        seen = [(t, v) for g, t, v in readings if g == tag and t <= ts]
        return max(seen)[1] if seen else 0.0

    def total(tag, ts):
        return sum(v for g, t, v in readings if g == tag and at(start) <= t <= ts)

    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {x.id: x.value for x in T.asof_last_value(p, r).collect()}
        assert got == {i: last(tag, ts) for i, tag, ts in points}
        got = {x.id: x.value for x in T.accumulate_to(p, r, start=start).collect()}
        assert got == {i: total(tag, ts) for i, tag, ts in points}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_of_readings_at_one_time_the_named_column_decides(spark, table):
    rows = [("a", at("2024-01-01"), v, k) for k, v in enumerate([3.0, None, 7.0, 5.0])]
    points = table("tag string, ts timestamp_ntz", ("a", at("2024-01-01")))
    for seed in range(4):
        mixed = random.Random(seed).sample(rows, 4)
        r = spark.createDataFrame(mixed, "tag string, ts timestamp_ntz, value double, seq int").repartition(3, "seq")
        assert tuples(T.asof_last_value(points, r, tie="seq"), "value") == [(5.0,)]
        assert tuples(T.asof_last_value(points, r), "value") == [(7.0,)]
        state = r.withColumnRenamed("tag", "point")
        at_point = points.withColumnRenamed("tag", "point")
        assert tuples(T.snapshot_at(at_point, state, "point", "2024-01-01 00:00:00", tie="seq"), "value", "seq") == [(5.0, 3)]
        assert tuples(T.snapshot_at(at_point, state, "point", "2024-01-01 00:00:00"), "value", "seq") == [(7.0, 2)]


def test_small_and_large_amounts_keep_their_value(table):
    readings = table(READING, ("a", at("2024-01-01"), 4e-7), ("a", at("2024-01-02"), 4e-7), ("b", at("2024-01-01"), 1e13), ("b", at("2024-01-02"), 1e13))
    points = table("tag string, ts timestamp_ntz", ("a", at("2024-01-03")), ("b", at("2024-01-03")))
    assert tuples(T.accumulate_to(points, readings), "tag", "value") == [("a", 8e-7), ("b", 2e13)]
    assert tuples(T.period_accumulation(points.select("tag"), readings, "2024-01-01", 5), "tag", "accumulation") == [("a", 8e-7), ("b", 2e13)]


def test_accumulate_counter(table):
    points = table("tag string, ts timestamp_ntz", ("a", at("2024-01-03")), ("b", at("2024-01-03")))
    readings = table(READING, ("a", at("2024-01-01"), 100.0), ("a", at("2024-01-02"), 130.0), ("a", at("2024-01-04"), 500.0))
    out = T.accumulate_to(points, readings, start="2024-01-01", mode="counter")
    assert tuples(out, "tag", "value") == [("a", 30.0), ("b", 0.0)]


def test_readings_are_sorted_by_ranges_and_read_once(spark, table, tmp_path):
    table(READING, ("a", at("2024-01-01"), 1.0)).write.parquet(f"{tmp_path}/r")
    points = table("tag string, ts timestamp_ntz", ("a", at("2024-01-01")))
    plan = T.asof_last_value(points, spark.read.parquet(f"{tmp_path}/r"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert f"{tmp_path}/r" not in text  # what is left of the plan starts from the sorted rows
    assert "windowspecdefinition(_range" in text and "max_by" in text


def test_snapshot_at_keeps_nulls_of_the_last_row(table):
    states = table(
        "point int, ts timestamp_ntz, level double, name string",
        (1, at("2024-01-01"), 1.0, "x"), (1, at("2024-01-02"), None, "y"), (1, at("2024-01-03"), 9.0, "z"),
        (2, at("2024-01-03"), 5.0, "w"), (3, at("2024-01-01"), 7.0, "v"),
    )
    points = table("point int", (1,), (2,))
    out = T.snapshot_at(points, states, "point", "2024-01-02 00:00:00")
    assert tuples(out, "point", "ts", "level", "name") == [(1, at("2024-01-02"), None, "y")]


def test_period_accumulation(table):
    readings = table(READING, ("a", at("2024-01-01"), 1.5), ("a", at("2024-01-02 23:59"), 2.0), ("a", at("2024-01-03"), 4.0))
    out = T.period_accumulation(table("tag string", ("a",), ("b",)), readings, "2024-01-01", 2)
    assert tuples(out, "tag", "accumulation") == [("a", 3.5), ("b", None)]
    with pytest.raises(ValueError, match="at least 1"):
        T.period_accumulation(table("tag string", ("a",)), readings, "2024-01-01", 0)


def test_active_tag_settings(table):
    objects = table("sf_id string, sf_name string", ("1", "T_1"), ("2", "T"), ("3", "TX1"), ("4", "M_1"))
    settings = table(
        "settings string, af_element string, attribute string, is_deleted int",
        ("10", "1", "TagID", 0), ("11", "1", "tagid", 1), ("  ", "3", "tagid", 0), ("12", "3", "tagid", 0),
        ("13", "2", "TagID", 0), ("14", "4", "TagID", 0), ("15", "1", "Other", 0), (None, "1", "TagID", 0),
    )
    # '_' is a wildcard: TX1 matches, a bare T does not
    assert tuples(T.active_tag_settings(settings, objects, "TagID", "T_%"), "tag_id") == [("10",), ("12",)]


def test_tag_id_list_is_distinct_and_without_blanks(table):
    tags = table("tag_id string", ("7 ",), ("7",), (" 8",), ("  ",), ("",), (None,))
    assert tuples(T.tag_id_list(tags), "tag_id") == [("7",), ("8",)]


def test_sample_grid_is_complete(table):
    tags = table("tag string", ("a",), ("b",))
    times = table("ts timestamp_ntz", (at("2024-01-01 05:00"),), (at("2024-01-01 06:00"),), (at("2024-03-01"),))
    assert T.sample_grid(tags, times).count() == 6


def test_overlap_with_many_periods_against_brute_force(spark):
    rng = random.Random(11)
    base = at("2024-01-01")

    def moment():
        return base + timedelta(hours=rng.randrange(0, 24 * 20))

    intervals = [(i, *sorted([moment(), moment()])) for i in range(80)]
    intervals = [(i, a, None if i % 7 == 0 else b) for i, a, b in intervals] + [(100, base - timedelta(days=400), None), (101, None, base)]
    intervals += [(102, base - timedelta(days=9), base - timedelta(days=8)), (103, base, base + timedelta(days=900))]
    periods = [(i, *sorted([moment(), moment()])) for i in range(12)] + [(50, base, base)]
    df = spark.createDataFrame(intervals, "id int, start_time timestamp_ntz, end_time timestamp_ntz")
    side = spark.createDataFrame(periods, "period_id int, period_start timestamp_ntz, period_end timestamp_ntz")
    want = sorted((p, i) for p, lo, hi in periods for i, a, b in intervals if a is not None and a <= hi and (b is None or b >= lo))
    assert tuples(T.interval_overlap_periods(df, side), "period_id", "id") == sorted(want, key=repr)


def overlapping(spark, intervals, periods, slot):
    df = spark.createDataFrame(intervals, "id int, start_time timestamp_ntz, end_time timestamp_ntz")
    side = spark.createDataFrame(periods, "period_id int, period_start timestamp_ntz, period_end timestamp_ntz")
    return df, side, T.interval_overlap_periods(df, side, slot=slot)


@pytest.mark.parametrize("slot", [1, 60, 3600, 86_400, 10**7])
def test_overlap_with_periods_of_any_length_and_slot(spark, slot):
    rng = random.Random(slot)
    base = at("2024-01-01")
    when = lambda: base + timedelta(seconds=rng.choice([3600, 86_400, 1]) * rng.randrange(-40, 90))
    intervals = [(i, when(), rng.choice([None, when(), when()])) for i in range(120)] + [(200, None, base), (201, None, None), (202, at("2030-01-01"), None)]
    periods = [(i, *sorted((when(), when()))) for i in range(40)] + [(50, base, base), (51, None, base), (52, base, None), (53, base, at("2023-12-01"))]
    _, _, out = overlapping(spark, intervals, periods, slot)
    want = []
    for p, lo, hi in periods:
        for i, a, b in intervals:
            if None not in (lo, hi, a) and lo <= hi and a <= hi and (lo <= a or (b is not None and lo <= b <= hi) or b is None or b >= hi):
                want.append((p, i))
    assert tuples(out, "period_id", "id") == sorted(want, key=repr)


def test_an_interval_becomes_few_nodes_however_long(spark):
    slots = spark.createDataFrame([(a, b, 20) for a, b in [(0, 2**20 - 1), (1, 2**20 - 2), (12345, 2**20 - 1), (7, 7), (0, 0), (2**19 - 1, 2**19)]], "a long, b long, d int")
    nodes = slots.select("a", "b", F.explode(T._nodes(F.col("a"), F.col("b"), F.col("d"))).alias("n")).select("a", "b", "n.*").collect()
    for a, b, _ in slots.collect():
        own = [(r.node, r.whole) for r in nodes if (r.a, r.b) == (a, b)]
        ranges = []
        for node, whole in own:
            h = 21 - node.bit_length()
            lo = (node << h) - 2**20
            hi = lo + 2**h - 1
            assert (a <= lo and hi <= b) if whole else (lo <= b and hi >= a and not (a <= lo and hi <= b))
            ranges += [(lo, hi)] * whole
        ranges.sort()
        assert ranges[0][0] == a and ranges[-1][1] == b and all(x[1] + 1 == y[0] for x, y in zip(ranges, ranges[1:]))
        assert len(set(own)) == len(own) <= 4 * 20 and (b < 2**20 - 1 or len(own) <= 2 * 21)
    assert len([r for r in nodes if (r.a, r.b) == (12345, 2**20 - 1)]) <= 40  # open at the end


def test_overlap_with_periods_is_an_equi_join(spark):
    _, _, out = overlapping(spark, [(1, at("2024-01-01"), None)], [(1, at("2024-01-01"), at("2024-02-01"))], 3600)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert tuples(overlapping(spark, [(1, at("2024-01-01"), None)], [], 60)[2], "id") == []


@pytest.mark.parametrize("seed", range(4))
def test_meter_with_resets_at_any_place(spark, seed):
    """One key with most rows, so that it goes over several ranges, and resets anywhere; against a walk over its readings."""
    rng = random.Random(seed)
    base, rows, level = at("2024-01-01"), [], {}
    for i in range(400):
        tag = rng.choice(["a"] * 8 + ["b", "c"])
        level[tag] = rng.choice([0.0, 0.25, -1.0]) if rng.random() < 0.1 else level.get(tag, 5.0) + rng.randrange(0, 40) / 8
        rows.append((tag, base + timedelta(minutes=rng.randrange(0, 3000)), None if rng.random() < 0.05 else level[tag]))
    rows.append(("d", base, 3.0))
    points = [(t, base + timedelta(minutes=m), n) for n, (t, m) in enumerate((t, m) for t in "abcde" for m in range(-100, 3200, 150))]
    start = base + timedelta(minutes=200) if seed % 2 else None
    want = []
    for tag, ts, n in points:
        seen = sorted((x, v) for t, x, v in rows if t == tag and v is not None and x <= ts and (start is None or x >= start))
        steps = [b - a if b >= a else max(b, 0.0) for (_, a), (_, b) in zip(seen, seen[1:])]
        want.append((n, round(sum(steps), 6)))
    out = T.accumulate_to(
        spark.createDataFrame(points, "tag string, ts timestamp_ntz, n int"), spark.createDataFrame(rows, READING).repartition(3), mode="meter", start=str(start) if start else None
    )
    assert sorted((r.n, round(r.value, 6)) for r in out.collect()) == want
    assert "ts" in out.columns and out.filter("value < 0").isEmpty()
