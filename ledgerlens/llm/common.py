"""Helpers of the operators on pairs: blocks of large groups, groups out of sorted Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import dropped, staged

KEY = ("key", "bi", "bj")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbers(column: pa.Array, kind=np.int64) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False)).astype(kind, copy=False)


def fixed(column: pa.Array, kind=np.uint8) -> np.ndarray:
    """A binary column whose values have one length, as a matrix."""
    n = len(column)
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]].view(kind).reshape(n, -1)


def lists(column: pa.Array, kind) -> list[np.ndarray]:
    """A list column as views into one array."""
    values = numbers(column.flatten(), kind)
    at = np.concatenate([[0], np.cumsum(numbers(column.value_lengths()))])
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def listed(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    at = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat, type=kind))


def blocks(members: DataFrame, size: int, weight=None) -> DataFrame:
    """The rows of every group with two or more rows, dealt so that any two rows of a group meet in one task.

    ``members`` has ``key`` (long) and ``id`` (long). A group of more than ``size`` rows (or of more than ``size`` units of
    ``weight``) is split into blocks by the hash of its ids, and each two blocks meet under their own (key, bi, bj); ``b`` is
    the row's own block. Rows of one (key, bi, bj) follow one another in a partition.
    """
    weighed = F.ceil(F.greatest(F.count(F.lit(1)), F.sum(weight) if weight is not None else F.lit(0)) / F.lit(size))
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), weighed.cast("int").alias("nb")).filter("n >= 2")
    counts = staged(counts, "group_sizes")  # a plain side of the join, so that Spark splits a large group's partition
    return dealt(members.join(counts.drop("n"), "key"))


def dealt(members: DataFrame) -> DataFrame:
    """``members`` of groups of ``nb`` blocks each, as ``blocks`` deals them."""
    own = F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    rows = (
        members.withColumn("b", own)
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .withColumn("bi", F.least("b", "o"))
        .withColumn("bj", F.greatest("b", "o"))
        .drop("o", "nb")
    )
    return rows.repartition(parts(members.sparkSession), *KEY).sortWithinPartitions(*KEY)


def groups(batches: Iterable[pa.RecordBatch], decode: Callable[[pa.RecordBatch], dict]) -> Iterator[dict]:
    """The decoded rows of each (key, bi, bj), also when a group goes over several batches.

    ``decode`` gives arrays (or lists) by name; only one group and one batch are held at a time.
    """
    held: list[dict] = []
    last = None

    def joined():
        if len(held) == 1:
            return held[0]
        return {k: np.concatenate([h[k] for h in held]) if isinstance(held[0][k], np.ndarray) else sum((list(h[k]) for h in held), []) for k in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([numbers(batch.column(k)) for k in KEY], axis=1)
        rows = decode(batch)
        cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(marks)]):
            mark = tuple(marks[a])
            if last is not None and mark != last:
                yield {**joined(), "same": last[1] == last[2]}
                held = []
            last = mark
            held.append({k: v[a:b] for k, v in rows.items()})
    if held:
        yield {**joined(), "same": last[1] == last[2]}


class Forest:
    """Union by least position within one block."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def of(self, i: int) -> int:
        return int(self.root[i])

    def join(self, i: int, j: int) -> None:
        a, b = self.root[i], self.root[j]
        if a != b:
            self.root[self.root == max(a, b)] = min(a, b)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Joins the positions of all pairs at once."""
        while True:
            a, b = self.root[i], self.root[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            up = np.arange(len(self.root))
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
            while (further := up[up] != up).any():
                up[further] = up[up[further]]
            self.root = up[self.root]

    def edges(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, id of its root) for every row that isn't its own root."""
        moved = np.flatnonzero(self.root != np.arange(len(self.root)))
        return ids[moved], ids[self.root[moved]]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); component is the smallest id reachable.

    Large-star and small-star rounds until the edges stay as they are; each round is written to the shared folder, and the one
    before goes. Nothing but two numbers a round reaches the driver. An id with any share of the edges has one row of least
    neighbours, which is stored too: the join back to the edges then stands on two plain shuffles, whose large partitions Spark
    splits.
    """
    now = _ordered(edges.select("a", "b"))
    made: list[str] = []
    now, seen = _round(now, True, made)
    while True:
        before, made = made, []
        now, new = _round(now, False, made, before)
        dropped(edges.sparkSession, before)
        if new == seen:
            break
        seen = new
    leaves = now.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    roots = now.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return leaves.union(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()


def _round(edges: DataFrame, plain: bool, made: list, between: list | None = None) -> tuple[DataFrame, tuple]:
    """``made`` gets the folder of the result, ``between`` those of what it is made from."""
    out = staged(edges if plain else _small(_large(edges, between), between), "components", once=True, made=made)
    total = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))).first()
    return out, tuple(total)


def _large(edges: DataFrame, made: list) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select(F.col("hi"), F.col("lo")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least", once=True, made=made)
    return both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small(edges: DataFrame, made: list) -> DataFrame:
    edges = staged(edges, "stars", once=True, made=made)
    least = staged(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least", once=True, made=made)
    moved = edges.join(least, "hi").filter("lo <> m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    return moved.union(least.select(F.col("m").alias("lo"), "hi")).distinct()
