"""Shards by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import parts

NODES = 128  # virtual nodes of a shard
CELLS = 4096  # equal arcs of the ring; what reaches the driver and goes out again is bounded by it


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(position, shard) of the virtual nodes, clockwise; a position is a 64-bit number."""

    def at(shard: int, node: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest(), "big")

    return sorted((at(s, n), s) for s in range(shards) for n in range(nodes))


def plan(counts: dict[int, int], shards: int, nodes: int = NODES, cells: int = CELLS) -> list[tuple[int, int, int, int, int, int]]:
    """(cell, first rank, behind the last rank, home shard, shard, slot of the first) for the keys counted in each cell.

    A shard's load is bounded by its even share, so counts differ by one at most. Every shard keeps its own keys up to the bound,
    cell after cell; keys beyond it go on clockwise, to the next virtual nodes whose shard still has room.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    order = ring(shards, nodes)
    places = [p for p, _ in order]
    width = 2**64 // cells
    out, over, used = [], [], [0] * shards
    for cell in sorted(counts):
        first = bisect_left(places, cell * width)
        home = order[first % len(order)][1]
        kept = min(counts[cell], room[home] - used[home])
        if kept:
            out.append((cell, 0, kept, home, home, used[home]))
            used[home] += kept
        if kept < counts[cell]:
            over.append((cell, kept, counts[cell], home, first))
    for cell, rank, last, home, node in over:
        while rank < last:
            shard = order[node % len(order)][1]
            n = min(last - rank, room[shard] - used[shard])
            if n:
                out.append((cell, rank, rank + n, home, shard, used[shard]))
                used[shard] += n
                rank += n
            node += 1
    return out


def sharded(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard of every row of ``docs``.

    The law is ``rows``: the bound on a shard's load is its even share of the rows. home_shard is where the ring alone would put
    the row; grown_shard is null. Slots of a shard are gapless from 0.

    Rows are counted by cell of the ring, the cells' counts are dealt out by ``plan``, and every row finds its shard and slot by its
    rank in its cell. Ranks are counted in strips of a cell, so one doc_id may have any share of the rows. The text itself isn't
    shuffled. Null text has size 1 and the checksum of no bytes; rows without doc_id share one cell; rows that repeat are rows of
    their own; an empty table gives an empty result; other columns are left out.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    cell = F.floor(F.shiftrightunsigned(F.xxhash64(F.col(doc_id).cast("string")), 32) / F.lit(2**32 // CELLS)).cast("int")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        cell.alias("cell"),
        F.pmod(F.monotonically_increasing_id(), F.lit(parts(spark))).cast("int").alias("strip"),
    )
    rows = staged(rows, "shard_rows")  # stored, so that strips stay as they are
    counts = rows.groupBy("cell", "strip").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["cell"]: r["n"] for r in counts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # CELLS rows at most
    kinds = "cell int, first long, behind long, home_shard int, shard int, slot_first long"
    runs = spark.createDataFrame(plan(totals, shards), kinds)  # bounded by CELLS and the number of virtual nodes
    before = Window.partitionBy("cell").orderBy("strip").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("cell", "strip", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("cell", "strip").orderBy("doc_id", "size", "text_crc32")
    ranked = (
        rows.withColumn("place", F.row_number().over(within) - 1)
        .join(base.hint("merge"), ["cell", "strip"])
        .withColumn("rank", F.col("base") + F.col("place"))
    )
    return (
        ranked.join(F.broadcast(runs), "cell")
        .filter("rank >= first and rank < behind")
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("slot_first") + F.col("rank") - F.col("first")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "home_shard",
        )
    )
