"""Sinks: full reload and day replacement of stored tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def full_reload(df: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = ()) -> None:
    """Replace the whole table, partitioned by the columns ``by``. The result is written beside the target and moved in only when complete,
    so a failed job leaves the old content. ``df`` may read the target itself."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    staged, old = f"{path}__new_{mark}", f"{path}__old_{mark}"
    writer = df.write.format(fmt).mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).save(staged)
    jvm, target, fs = _file_system(spark, path)
    had = fs.exists(target)
    if had and not fs.rename(target, jvm.org.apache.hadoop.fs.Path(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), target):
        if had:
            fs.rename(jvm.org.apache.hadoop.fs.Path(old), target)
        raise OSError(f"cannot move the new content to {path}")
    if had:
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), True)


def replace_day(df: DataFrame, path: str, day: str, fmt: str = "parquet") -> None:
    """Store the rows of one run under its run date; a re-run replaces that partition and no other."""
    (
        df.withColumn("run_date", F.lit(day).cast("date"))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .save(path)
    )


def append_errors(bad: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add the messages of quarantined rows to the error log."""
    bad.select("error_message").write.format(fmt).mode("append").save(path)
