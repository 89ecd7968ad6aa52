"""Approximate nearest neighbours: a prefix forest over sorted arrays of long hash strings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import KEY, groups, lists, numbers, parts
from .rabitq import rotations, usable

TREES = 32
BITS = 32  # length of a hash string
SHARE = 0.6  # ascend until the trees together hold this share of the shard's rows as candidates
SHARD = 4096  # candidates of one forest
QUERIES = 1024  # queries that meet a forest at once


class PrefixForest:
    """For every tree the sorted hash strings of the vectors, as numbers whose high bits come first."""

    def __init__(self, vectors: np.ndarray):
        self.planes = rotations(vectors.shape[1], TREES * BITS)
        strings = self.strings(vectors)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)
        self.count = len(vectors)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        bits = (vectors @ self.planes.T > 0).reshape(len(vectors), TREES, BITS)
        return (bits.astype(np.uint64) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)

    def ranges(self, strings: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, where the strings with its first ``length`` bits begin and end."""
        rest = (np.uint64(1) << (np.uint64(BITS) - length.astype(np.uint64))) - np.uint64(1)
        low = strings & ~rest[:, None]
        high = strings | rest[:, None]
        begin, end = np.empty(strings.shape, np.int64), np.empty(strings.shape, np.int64)
        for t in range(TREES):
            begin[:, t] = np.searchsorted(self.sorted[:, t], low[:, t], side="left")
            end[:, t] = np.searchsorted(self.sorted[:, t], high[:, t], side="right")
        return begin, end

    def candidates(self, queries: np.ndarray, least: int):
        """Positions for each query: from the longest match, all trees ascend together until they hold enough."""
        strings = self.strings(queries)
        enough = TREES * self.count if self.count <= 10 * least else max(math.ceil(SHARE * self.count), TREES * least)
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), BITS, np.int64)
        while (low < high).any():  # the longest prefix length that still has enough; fewer bits never have less
            middle = (low + high + 1) // 2
            begin, end = self.ranges(strings, middle)
            has = (end - begin).sum(axis=1) >= enough
            low, high = np.where(has, middle, low), np.where(has, high, middle - 1)
        begin, end = self.ranges(strings, low)
        for q in range(len(queries)):
            found = np.zeros(self.count, bool)
            for t in range(TREES):
                found[self.order[begin[q, t] : end[q, t], t]] = True
            yield np.flatnonzero(found)


def _searched(k: int):
    """Rows of a shard and of a block of queries -> the k nearest candidates here of each query."""

    def decode(x):
        return {"id": numbers(x.column("id")), "query": numbers(x.column("query"), bool), "v": lists(x.column("embedding"), np.float64), "ids": lists(x.column("ids"), np.int64)}

    def run(batches):
        for g in groups(batches, decode):
            dims = np.array([len(v) for v in g["v"]])
            for dim in np.unique(dims[g["query"]]):
                asked = np.flatnonzero(g["query"] & (dims == dim))
                there = np.flatnonzero(~g["query"] & (dims == dim))
                if not len(there):
                    continue
                wanted, vectors = np.stack([g["v"][i] for i in asked]), np.stack([g["v"][i] for i in there])
                ids = [g["ids"][i] for i in there]
                out: list[list] = [[], [], []]
                for q, (row, near) in enumerate(zip(asked, PrefixForest(vectors).candidates(wanted, k + 1))):
                    own = int(g["id"][row])
                    scores = np.einsum("ij,j->i", vectors[near], wanted[q])
                    if len(near) > k + 1:
                        least = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                        near, scores = near[scores >= least], scores[scores >= least]
                    members = [ids[i] for i in near]
                    flat, values = np.concatenate(members), np.repeat(scores, [len(m) for m in members])
                    flat, values = flat[flat != own], values[flat != own]
                    best = np.lexsort((flat, -values))[:k]
                    for column, x in zip(out, (np.full(len(best), own), flat[best], values[best])):
                        column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row that meets ``queries`` (a condition on vec_id).

    Nearness is the inner product in double precision of the vectors as they are; ties go to the smaller vec_id; a query's own
    vec_id is no candidate. Equal vectors are one candidate with its k + 1 smallest ids, more can't be among the nearest. The
    candidates are dealt to shards at random, each with its own forest, and meet the queries in blocks; the shards' best are
    merged. A query with fewer than k candidates gets all.

    Null or zero vectors, those with null or non-finite components and rows without vec_id take no part; vectors meet only those
    of their own length. Rows that repeat both vec_id and vector count once; of a vec_id with several vectors each is searched,
    and the k nearest are over them all. An empty table gives an empty result; other columns are left out.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("embedding"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("embedding"))).distinct()
    first = Window.partitionBy("embedding").orderBy("id")
    ranked = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    classes = ranked.groupBy("embedding").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = staged(classes.withColumn("embedding", F.col("embedding").cast("array<double>")), "forest_classes")
    asked = rows.filter(queries(F.col("id"))).withColumn("embedding", F.col("embedding").cast("array<double>"))
    shards = max(1, -(-classes.count() // SHARD))
    strips = max(1, -(-asked.count() // QUERIES))
    there = classes.select(
        F.lit(0).cast("long").alias("key"),
        F.pmod(F.xxhash64(F.lit(3), "embedding"), F.lit(shards)).cast("int").alias("bi"),
        F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("bj"),
        F.lit(None).cast("long").alias("id"), F.lit(False).alias("query"), "embedding", "ids",
    )
    sought = asked.select(
        F.lit(0).cast("long").alias("key"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("bi"),
        F.pmod(F.xxhash64(F.lit(4), "id"), F.lit(strips)).cast("int").alias("bj"),
        "id", F.lit(True).alias("query"), "embedding", F.array().cast("array<long>").alias("ids"),
    )
    met = there.withColumn("id", F.lit(-1).cast("long")).unionByName(sought)
    met = met.repartition(max(parts(vectors.sparkSession), shards * strips), *KEY).sortWithinPartitions(*KEY)
    found = met.mapInArrow(_searched(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
