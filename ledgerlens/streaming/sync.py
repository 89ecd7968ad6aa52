"""Meter groups kept in step over a stream of changes."""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ledger import spread_changes
from ..sources.catalog import conform


LATEST = "case_id int, group_id bigint, seq bigint, new_value double"
FAN = 8  # segments of one level that are merged into one of the next

# The state lives in RocksDB; a checkpoint writes what a batch changed, not the whole state.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _with_conf(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _segments(spark: SparkSession, sink: str) -> dict[int, list[str]]:
    """Folders of the segments stored completely, by level, oldest first."""
    pattern, fs = _path(spark, f"{sink}/segment-*/_SUCCESS")
    levels: dict[int, list[tuple[int, str]]] = {}
    for found in fs.globStatus(pattern) or []:
        folder = found.getPath().getParent()
        level, batch = map(int, re.match(r"segment-(\d+)-(\d+)-", folder.getName()).groups())
        levels.setdefault(level, []).append((batch, folder.toString()))
    return {level: [name for _, name in sorted(names)] for level, names in levels.items()}


def _sweep(spark: SparkSession, sink: str) -> None:
    """Drop what a stream that ended has left hidden: merged segments, and ones it didn't complete."""
    pattern, fs = _path(spark, f"{sink}/segment-*")
    for found in fs.globStatus(pattern) or []:
        done, _ = _path(spark, f"{found.getPath().toString()}/_SUCCESS")
        if not fs.exists(done):
            fs.delete(found.getPath(), True)


def _merged(changes: DataFrame) -> DataFrame:
    return changes.groupBy("case_id", "group_id").agg(
        F.max("seq").alias("seq"), F.max_by("new_value", "seq").alias("new_value")
    )


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(LATEST).parquet(*folders)


def sync_group_stream(
    changes: DataFrame,
    members: DataFrame,
    min_case: int,
    sink: str,
    checkpoint: str,
    case_time: Column | None = None,
    keep: str | None = None,
) -> StreamingQuery:
    """Runs through what is available: the last change per (case, group) is kept in the state store, and every micro-batch
    stores the (case, group) pairs that it changed.

    ``changes``: id, case_id, measured, seq, as a stream. The largest ``seq`` of a group decides, in whatever order and batch
    changes arrive; cases before ``min_case`` are skipped. Changes are combined on the map side, so a pair with most of the rows
    costs one row a task.

    With ``case_time`` (a TIMESTAMP made of a change's columns, the same for all changes of a case) and ``keep`` (such as
    ``"40 days"``) a case stays open until the watermark, the latest case time less ``keep``, passes it: then its pairs leave the
    state, what they were stays stored, and later changes of that case are ignored, as those before ``min_case`` are.
    Without them every case stays open.

    State and storage follow the batch. A batch writes one segment of the pairs it changed; ``FAN`` segments of a level are
    merged into one of the next, so a row is rewritten a logarithmic number of times, and the big meter table never. A batch that
    is replayed after a failure starts from the state before it and overwrites its own segment; a merge that broke off leaves
    its segments beside each other, which reading resolves by ``seq``. Segments that were merged go one batch later, or when the stream
    starts again; one stream at a time writes to a sink.
    """
    if (case_time is None) != (keep is None):
        raise ValueError("case_time and keep belong together")
    spark = changes.sparkSession
    origin = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]  # batches of another checkpoint are other batches
    keys = ["case_id", "group_id"]
    fresh = changes.filter(F.col("case_id") >= min_case).join(members.select("id", "group_id"), "id")
    if keep is not None:
        fresh = fresh.withColumn("_open", case_time.cast("timestamp")).withWatermark("_open", keep)
        keys = ["_open", *keys]
    last = fresh.groupBy(*keys).agg(F.max("seq").alias("seq"), F.max_by("measured", "seq").alias("new_value"))
    merged_before: list[str] = []
    _sweep(spark, sink)

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        conform(batch, LATEST).write.mode("overwrite").parquet(f"{sink}/segment-0-{batch_id}-{origin}")
        for folder in merged_before:
            path, fs = _path(session, folder)
            fs.delete(path, True)
        merged_before.clear()
        level = 0
        while len(names := _segments(session, sink).get(level, [])) >= FAN:
            target = f"{sink}/segment-{level + 1}-{batch_id}-{origin}"
            _merged(_read(session, names)).write.mode("overwrite").parquet(target)
            for name in names:  # out of sight for new readers, there for those at work
                path, fs = _path(session, f"{name}/_SUCCESS")
                fs.delete(path, False)
            merged_before.extend(names)
            level += 1

    with _with_conf(spark, STATE_STORE):
        return (
            last.writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def stored_changes(spark: SparkSession, sink: str) -> DataFrame:
    """Last value per (case, group); empty before the first change. ``seq`` decides, so a pair may be in several segments."""
    folders = [name for names in _segments(spark, sink).values() for name in names]
    return _merged(_read(spark, folders)) if folders else spark.createDataFrame([], LATEST)


def synced_meters(meters: DataFrame, members: DataFrame, sink: str) -> DataFrame:
    """Meters as the stream has left them."""
    return spread_changes(meters, stored_changes(meters.sparkSession, sink), members)
