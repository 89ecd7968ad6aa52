"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings: safe to set on a session somebody else created.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE split a skewed join even when that costs one more shuffle for the next aggregate
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    for key, value in TUNING.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see, as the session names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not named:
        raise ValueError(
            "spark.checkpoint.dir is not set: name a folder that the driver and all executors share"
        )
    return named.rstrip("/")


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name for one run, never used again."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def staged(df, purpose: str, by: tuple[str, ...] = (), batch: int | None = None, once: bool = False, made: list | None = None):
    """The same rows, stored once in the shared folder and read back.

    For a result several branches start from: it is computed once, survives the loss of executors, and
    each branch still prunes columns and partitions. ``batch`` bounds the bytes of the Arrow batches that go
    to Python for it: an executor holds such a batch twice for each task, so long texts count. With ``once``
    the shuffle files go with the end of the writing, not when the driver happens to collect its garbage.
    The folder's name is added to ``made``, for ``dropped``.
    """
    spark = df.sparkSession
    path = run_dir(spark, purpose)
    wanted = ({BATCH: str(batch)} if batch else {}) | ({DROP: "true"} if once else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*by) if by else writer).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, made: list[str]) -> None:
    """Deletes what ``staged`` stored, once nothing reads it any more: later results must stand on other stored rows."""
    while made:
        path = spark._jvm.org.apache.hadoop.fs.Path(made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
