"""Shards of dirty rows, the ring's plan, and the query."""

import os
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlens.llm import sharding
from ledgerlens.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


def hold(rows, got, shards=8):
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_of_dirty_rows(spark, shards):
    rows = [(i, f"text {i}") for i in range(200)] + [(7, "é" * 40_000)] * 90 + [(None, None)] * 20 + [(300, None), (301, "")]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "doc_id long, text string, cell int, shard int")
    hold(rows, sharding.sharded(df, shards).collect(), shards)
    assert sharding.sharded(df.limit(0), shards).collect() == []


def test_overflow_goes_clockwise_and_the_rest_stays():
    counts = {c: 3 for c in range(0, sharding.CELLS, 2)}
    runs = sharding.plan(counts, 8)
    total = sum(counts.values())
    room = Counter()
    for cell, first, behind, home, shard, slot in runs:
        assert slot == room[shard]
        room[shard] += behind - first
    assert sorted(room.values()) == [total // 8] * 8
    homes = Counter()
    for cell, first, behind, home, shard, slot in runs:
        homes[home] += behind - first
    moved = sum(b - a for _, a, b, home, shard, _ in runs if home != shard)
    assert moved == sum(max(0, n - total // 8) for n in homes.values())


def test_one_more_shard_takes_from_all_and_moves_little_else():
    counts = {c: 5 for c in range(sharding.CELLS)}

    def homes(shards):
        return {cell: home for cell, _, _, home, _, _ in sharding.plan(counts, shards)}

    before, after = homes(8), homes(9)
    assert all(after[c] in (before[c], 8) for c in before)


def test_a_single_hot_cell():
    runs = sharding.plan({17: 1001}, 8)
    assert sorted(b - a for _, a, b, _, _, _ in runs) == [125] * 7 + [126]


@needs_tables
def test_query_and_plan(spark):
    df = QUERIES["op8_hash_ring"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    hold(rows, df.collect())
    again = {(r["doc_id"], r["shard"]) for r in QUERIES["op8_hash_ring"](spark, SF).collect()}
    assert {(r["doc_id"], r["shard"]) for r in df.collect()} == again
