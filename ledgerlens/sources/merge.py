"""Copy-on-write changes of stored, partitioned tables: only the partitions a change touches are written again."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import upsert_measures
from .session import staged
from .sinks import _file_system

READY = "_READY"  # marks a change that is written completely


def _join(*parts: str) -> str:
    return "/".join(p for p in parts if p)


def _dealt(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a partition in one task, or in several if they are many: Spark sees to the sizes when it knows them."""
    return rows.hint("rebalance", *by)


class Store:
    """A folder of parquet files by partition columns, and the changes written beside it.

    A change is a folder ``<path>__change_<mark>``: the new partitions below ``new``, and then a marker. Without the marker the change
    never happened. With it the change is moved into place partition by partition, the old files aside; ``recover`` takes up such
    a move again after a crash, so the table gets all of a change or nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm, self.root, self.fs = _file_system(spark, self.path)

    def at(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path(_join(*parts))

    def exists(self) -> bool:
        return self.fs.exists(self.root)

    def schema(self):
        return self.spark.read.parquet(self.path).schema

    def rows(self, folders: Sequence[str] | None = None) -> DataFrame:
        """The table, or the rows of some partition folders (relative to it) and no others."""
        reader = self.spark.read.schema(self.schema())
        if folders is None:
            return reader.parquet(self.path)
        return reader.option("basePath", self.path).parquet(*[_join(self.path, f) for f in folders])

    def folders(self, below: str, depth: int, prefix: str = "") -> list[str]:
        """Partition folders under ``below``, relative to it."""
        found = []
        for status in self.fs.listStatus(self.at(below, prefix)):
            name = status.getPath().getName()
            if status.isDirectory() and "=" in name:
                inner = _join(prefix, name)
                found += [inner] if depth == 1 else self.folders(below, depth - 1, inner)
        return sorted(found)

    def folders_of(self, rows: DataFrame) -> list[str]:
        """Partition folders of some of the table's own files (column ``file``); as many at most as the table has partitions."""
        root = F.regexp_replace("file", "/[^/]*$", "")
        base = self.fs.makeQualified(self.root).toUri().getPath()
        names = (unquote(re.sub("^[a-z0-9]+:(//[^/]*)?", "", r[0])) for r in rows.select(root).distinct().collect())
        return sorted(n[len(base) :].strip("/") for n in names)

    def write(self, rows: DataFrame, by: Sequence[str]) -> str:
        """A change that is ready to be moved in; gives its folder."""
        change = f"{self.path}__change_{uuid.uuid4().hex}"
        _dealt(rows, by).write.mode("errorifexists").partitionBy(*by).parquet(_join(change, "new"))
        return change

    def apply(self, change: str, by: Sequence[str], replaced: Sequence[str]) -> None:
        """Moves a change in: partitions in ``replaced`` get the new files in place of the old, others in addition."""
        written = self.folders(_join(change, "new"), len(by))
        there = [f for f in replaced if self.fs.exists(self.at(self.path, f))]
        text = "\n".join([str(len(by)), *[("new " if f in written else "gone ") + f for f in there]])
        out = self.fs.create(self.at(change, READY + "_"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self._renamed(self.at(change, READY + "_"), self.at(change, READY))
        self._move(change)

    def recover(self) -> None:
        """Finishes changes that broke off while they were moved in, and drops those that were never complete."""
        for status in self.fs.globStatus(self.at(self.path + "__change_*")) or []:
            change = status.getPath().toString()
            if self.fs.exists(self.at(change, READY)):
                self._move(change)
            else:
                self.fs.delete(status.getPath(), True)

    def _renamed(self, source, target) -> None:
        if not self.fs.rename(source, target):
            raise OSError(f"cannot move {source.toString()} to {target.toString()}")

    def _text(self, path) -> str:
        held = self.fs.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(held)).decode()
        finally:
            held.close()

    def _aside(self, change: str, folder: str) -> None:
        """Moves the old files of a partition out, unless an attempt before has done so."""
        target, old = self.at(self.path, folder), self.at(change, "old", folder)
        if not self.fs.exists(old) and self.fs.exists(target):
            self.fs.mkdirs(old.getParent())
            self._renamed(target, old)

    def _move(self, change: str) -> None:
        depth, *lines = self._text(self.at(change, READY)).split("\n")
        replaced, gone = ([x.split(" ", 1)[1] for x in lines if x.startswith(kind)] for kind in ("new ", "gone "))
        for folder in self.folders(_join(change, "new"), int(depth)):
            if folder in replaced:
                self._aside(change, folder)
            new = self.at(change, "new", folder)
            self.fs.mkdirs(self.at(self.path, folder))
            for status in self.fs.listStatus(new):  # file by file, so that a second attempt takes up the rest
                self._renamed(status.getPath(), self.at(self.path, folder, status.getPath().getName()))
            self.fs.delete(new, True)
        for folder in gone:
            self._aside(change, folder)
        self.fs.delete(self.at(change), True)


def store(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """A new table by partition columns, as the functions below expect it."""
    _dealt(df, by).write.mode("errorifexists").partitionBy(*by).parquet(path)


def merge_into(
    path: str,
    source: DataFrame,
    on: tuple[str, str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    defaults: Mapping[str, object],
    by: Sequence[str],
) -> dict[str, int]:
    """``upsert_measures`` into a stored table partitioned by ``by``: rows that match get ``update``, other source rows are inserted.

    The partitions with matching rows are found by key and file name alone; they are read in full and written again, and no other
    is read in full or written. A row that is inserted goes to the partition its columns name, also as an additional file. Files of
    other partitions stay as they are, and so does the whole table if the merge fails; a merge that breaks off while its
    complete result is moved in is finished by the next one (or ``Store.recover``).

    The source key must be unique, else ValueError and nothing changes; a source row whose key is null matches nothing and is
    inserted. Partition columns and the key can't be updated. Gives the numbers of partitions rewritten and added to.
    """
    spark, (key, source_key) = source.sparkSession, on
    if moved := {key, *by} & set(update):
        raise ValueError(f"columns that can't be updated: {sorted(moved)}")
    table = Store(spark, path)
    table.recover()
    source = staged(source, "merge_source")  # it is read for its keys and for its rows
    repeated = source.filter(F.col(source_key).isNotNull()).groupBy(source_key).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"the key {source_key} of the source repeats")
    wanted = source.select(F.col(source_key).alias("_wanted")).filter("_wanted is not null")
    held = table.rows().select(key, F.col("_metadata.file_path").alias("file"))
    touched = table.folders_of(held.join(wanted, F.col(key) == F.col("_wanted"), "left_semi"))
    target = table.rows(touched) if touched else table.rows().limit(0)
    change = table.write(upsert_measures(target, source, on, update, insert, defaults), by)
    written = table.folders(_join(change, "new"), len(by))
    table.apply(change, by, touched)
    return {"rewritten": len(touched), "added_to": len(set(written) - set(touched))}


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], emptied: Sequence[Mapping[str, object]] = ()) -> int:
    """The partitions that ``df`` has rows of hold these rows and no others; all other partitions keep their files.

    ``df`` may read the table itself. ``emptied`` names partitions by their column values that lose their rows if ``df`` has none
    of them. The table is made if it isn't there. Complete or not at all, as above. Gives the number of partitions written.
    """
    table = Store(df.sparkSession, path)
    table.recover()
    change = table.write(df, by)
    written = table.folders(_join(change, "new"), len(by))
    gone = ["/".join(f"{c}={values[c]}" for c in by) for values in emptied]
    table.apply(change, by, sorted({*written, *gone}))
    return len(written)
