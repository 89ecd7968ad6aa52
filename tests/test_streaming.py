"""The state of the meter groups' stream: what a batch touches, order of arrival, restarts, replays, expiry, merged segments."""

import random

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.operators import ledger as L
from ledgerlens.streaming import sync

CHANGES = "id int, case_id int, measured double, seq int"
MEMBERS = [(i, i // 3) for i in range(300)]


class Feed:
    """A folder that gets one file of changes after another, and the stream over it."""

    def __init__(self, spark, root):
        self.spark, self.source, self.sink, self.root = spark, str(root / "in"), str(root / "sink"), root
        self.rows, self.members = [], spark.createDataFrame(MEMBERS, "id int, group_id int")

    def add(self, *rows):
        self.rows += rows
        self.spark.createDataFrame(list(rows), CHANGES).coalesce(1).write.mode("append").parquet(self.source)

    def run(self, checkpoint="progress", min_case=10, **kw):
        stream = self.spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(self.source)
        query = sync.sync_group_stream(stream, self.members, min_case, self.sink, str(self.root / checkpoint), **kw)
        query.awaitTermination()
        return query

    def stored(self):
        return tuples(sync.stored_changes(self.spark, self.sink), "case_id", "group_id", "seq", "new_value")

    def expected(self, rows=None):
        latest = L.latest_changes(self.spark.createDataFrame(self.rows if rows is None else rows, CHANGES), self.members, 10)
        return tuples(latest, "case_id", "group_id", "seq", "new_value")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def some(seed, n, first):
    rng = random.Random(seed)
    rows = [(rng.randrange(320), rng.choice([9, 10, 11, 12]), rng.choice([None, rng.random()]), first + i) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_a_batch_touches_what_it_changes(spark, feed):
    feed.add(*[(i, 10, float(i), i) for i in range(300)])
    feed.run()
    feed.add((4, 10, -1.0, 1000), (5, 10, -2.0, 1001), (290, 11, -3.0, 1002))
    progress = feed.run().lastProgress
    state = progress["stateOperators"][0]
    assert state["numRowsUpdated"] == 2 and state["numRowsTotal"] == 101
    assert "RocksDB" in str(state) or any("rocksdb" in k.lower() for k in state["customMetrics"])
    newest = sorted(p for p in (feed.root / "sink").glob("segment-0-1-*"))
    assert spark.read.parquet(str(newest[0])).count() == 2  # only those two pairs are written
    assert feed.stored() == feed.expected()


def test_late_changes_lose_whatever_the_batch(feed):
    feed.add((0, 10, 5.0, 50))
    feed.add((1, 10, 4.0, 40), (3, 10, 1.0, 1))  # older than what is known of its group
    feed.add((2, 10, None, 60))
    feed.add((2, 10, 7.0, 55))
    feed.run()
    assert feed.stored() == [(10, 0, 60, None), (10, 1, 1, 1.0)] == feed.expected()


def test_restart_goes_on_and_replay_changes_nothing(feed):
    for n in range(3):
        feed.add(*some(n, 200, 200 * n))
    feed.run()
    assert feed.stored() == feed.expected()
    for n in range(3, 5):
        feed.add(*some(n, 200, 200 * n))
    feed.run()
    want = feed.expected()
    assert feed.stored() == want
    feed.run("another")  # every batch once more, under another checkpoint
    assert feed.stored() == want


def test_segments_are_merged_and_a_broken_merge_does_no_harm(spark, feed, monkeypatch):
    monkeypatch.setattr(sync, "FAN", 3)
    for n in range(11):
        feed.add(*some(n, 60, 60 * n))
    feed.run()
    levels = sync._segments(spark, feed.sink)
    assert {level: len(names) for level, names in levels.items()} == {0: 2, 2: 1}
    assert feed.stored() == feed.expected()
    # a merge that stored its segment and broke off before the old ones were hidden
    names = levels[0]
    sync._merged(sync._read(spark, names)).write.parquet(f"{feed.sink}/segment-1-99-x")
    assert feed.stored() == feed.expected()
    # a segment that was never completed isn't read
    sync._read(spark, names).limit(1).withColumn("seq", F.lit(10**9).cast("long")).write.parquet(f"{feed.sink}/segment-0-77-x")
    (feed.root / "sink" / "segment-0-77-x" / "_SUCCESS").unlink()
    assert feed.stored() == feed.expected()
    feed.add((0, 10, 1.0, 10**6))
    feed.run()  # a new start clears it away
    assert not (feed.root / "sink" / "segment-0-77-x").exists() and feed.stored() == feed.expected()


def test_cases_close_by_their_time(spark, feed):
    day = F.to_timestamp(F.col("case_id").cast("string"), "yyyyMMdd")
    feed.add((0, 20240101, 1.0, 1), (3, 20240102, 2.0, 2))
    feed.add((0, 20240210, 3.0, 3))
    feed.add((6, 20240211, 9.0, 4))
    progress = feed.run(case_time=day, keep="30 days").lastProgress
    assert progress["stateOperators"][0]["numRowsTotal"] == 2  # January left the state
    feed.add((0, 20240101, 99.0, 5), (1, 20240210, 4.0, 6))  # one for a closed case, one for an open one
    feed.run(case_time=day, keep="30 days")
    assert feed.stored() == [(20240101, 0, 1, 1.0), (20240102, 1, 2, 2.0), (20240210, 0, 6, 4.0), (20240211, 2, 4, 9.0)]
    with pytest.raises(ValueError):
        feed.run(keep="30 days")


def test_settings_of_the_session_stay(spark, feed):
    before = {k: spark.conf.get(k, None) for k in sync.STATE_STORE}
    feed.add((0, 10, 1.0, 1))
    feed.run()
    assert before == {k: spark.conf.get(k, None) for k in sync.STATE_STORE}
