"""Hard negatives of anchors among all vectors: exact integer inner products, many candidates at once in one wide integer."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import numbers, parts

SCALE = 256  # a component x counts as floor(SCALE * x)
POSITIVES = 5  # of an anchor
NEGATIVES = 5  # of a positive
LOW, HIGH = 80, 100  # percent of the positive's score that a negative's may have
ANCHORS = 1024  # anchors that meet a block of candidates
ROWS = 4096  # candidates of a block
PACK = 1024  # candidates in one wide integer

CELL = ("group", "dim", "ab", "cb")
_EXACT = pa.decimal128(38, 0)
_MOST = 10**38 - 1


def quantised(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component: int64, or whole numbers of any size where a component needs them."""
    with np.errstate(over="ignore"):
        q = np.floor(vectors * scale)
    if not q.size or np.abs(q).max() < 2**31:
        return q.astype(np.int64)
    whole = np.frompyfunc(lambda x: math.floor(Fraction(x) * scale), 1, 1)
    return whole(vectors)


def _fields(column: np.ndarray, width: int) -> int:
    """Whole numbers from 0 as the fields of one integer, the first the lowest."""
    if width <= 8:
        return int.from_bytes(column.astype(f"<u{width}").tobytes(), "little")
    return int.from_bytes(b"".join(int(x).to_bytes(width, "little") for x in column), "little")


def _unpacked(wide: int, count: int, width: int) -> np.ndarray:
    held = wide.to_bytes(count * width, "little")
    if width <= 8:
        return np.frombuffer(held, f"<u{width}").astype(np.int64)
    return np.array([int.from_bytes(held[i : i + width], "little") for i in range(0, len(held), width)], object)


class Packed:
    """Candidates as wide integers, one per component: its values of all candidates, made positive by a bias, side by side.

    A component of an anchor, made positive too, times that integer is its product with every candidate; the sums of these hold
    all inner products in their fields, which are wide enough for the largest sum that can occur, so nothing carries over.
    """

    def __init__(self, rows: np.ndarray, anchors: np.ndarray):
        self.count, dim = rows.shape
        lowest, highest = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
        least, most = (int(anchors.min()), int(anchors.max())) if anchors.size else (0, 0)
        self.bias, self.shift = max(0, -lowest), max(0, -least)
        bits = (dim * (max(highest, 0) + self.bias) * (max(most, 0) + self.shift)).bit_length()
        self.width = 4 if bits <= 32 else 8 if bits <= 55 else -(-bits // 8)
        self.packs = [_fields(rows[:, i] + self.bias, self.width) for i in range(dim)]
        # sum (a+s)(c+b) = sum ac + b sum a + s sum c + dim s b
        sums = rows.sum(axis=1) if self.width <= 8 else rows.astype(object).sum(axis=1)
        self.fixed = self.shift * sums + dim * self.shift * self.bias

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The inner product of an anchor with every candidate: int64, or whole numbers of at most 38 digits."""
        wide = sum(a * pack for a, pack in zip((anchor + self.shift).tolist(), self.packs) if a)
        exact = _unpacked(wide, self.count, self.width) - self.fixed - self.bias * int(anchor.sum())
        return exact if exact.dtype != object else np.clip(exact, -_MOST, _MOST)


def products(anchors: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """For each anchor its inner products with all rows."""
    packs = [Packed(rows[i : i + PACK], anchors) for i in range(0, len(rows), PACK)]
    for anchor in anchors:
        yield np.concatenate([p.scores(anchor) for p in packs]) if packs else np.zeros(0, np.int64)


def first(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of some places those of the k highest scores, highest first, ties to the earlier place."""
    if scores.dtype != object and len(places) > k:
        least = np.partition(scores[places], len(places) - k)[len(places) - k]
        places = places[scores[places] >= least]
    return places[np.argsort(-scores[places], kind="stable")[:k]]


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (group, dim, ab, cb), also when they go over several batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([numbers(batch.column(k)) for k in CELL], axis=1)
        cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(marks)]):
            if last is not None and tuple(marks[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(marks[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sides(batches, scale: int):
    """anchors (ids, labels, vectors, wanted), rows (ids, labels, vectors) of each cell."""
    for cell in _cells(batches):
        dim = cell.column("dim")[0].as_py()
        asks = numbers(cell.column("asks").combine_chunks(), bool)
        flat = numbers(pa.concat_arrays([c.flatten() for c in cell.column("v").chunks]), np.float64)
        q = quantised(flat.reshape(len(cell), dim), scale)
        ids, labels = numbers(cell.column("id").combine_chunks()), numbers(cell.column("label").combine_chunks())
        if asks.any() and not asks.all():
            wanted = cell.column("wanted").filter(pa.array(asks)).to_pylist()
            yield (ids[asks], labels[asks], q[asks], wanted), (ids[~asks], labels[~asks], q[~asks])


def _exact(values: list[int]) -> pa.Array:
    if all(abs(v) < 2**63 for v in values):
        return pa.array(values, pa.int64()).cast(_EXACT)
    return pa.array([Decimal(v) for v in values], _EXACT)


def _positives(scale: int, k: int):
    """Cells of one label -> the k best other rows here of each anchor."""

    def run(batches):
        for (ids, _, anchors, _), (others, _, rows) in _sides(batches, scale):
            out: tuple[list, list, list] = ([], [], [])
            for anchor, scores in zip(ids, products(anchors, rows)):
                best = first(scores, np.flatnonzero(others != anchor), k)
                out[0].extend([anchor] * len(best))
                out[1].extend(others[best])
                out[2].extend(scores[best].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), _exact(out[2])], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(scale: int, k: int, low: int, high: int):
    """Cells of all labels -> for each positive of an anchor the k best rows here that fit it."""

    def run(batches):
        for (ids, labels, anchors, wanted), (others, theirs, rows) in _sides(batches, scale):
            out: tuple[list, ...] = ([], [], [], [], [])
            for anchor, label, positives, scores in zip(ids, labels, wanted, products(anchors, rows)):
                foreign = np.flatnonzero(theirs != label)
                there = scores[foreign]
                for p in positives:
                    score = int(p["positive_score"])
                    # 100 * score lies within a long, as a field has 55 bits at most; the bounds are cut to that range
                    floor, roof = -(-low * score // 100), high * score // 100
                    if there.dtype != object:
                        floor, roof = max(-(2**62), min(2**62, floor)), max(-(2**62), min(2**62, roof))
                    best = first(scores, foreign[(there >= floor) & (there <= roof)], k)
                    out[0].extend([anchor] * len(best))
                    out[1].extend([p["positive_id"]] * len(best))
                    out[2].extend([score] * len(best))
                    out[3].extend(others[best])
                    out[4].extend(scores[best].tolist())
            columns = [pa.array(x, pa.int64()) for x in (out[0], out[1], out[3])]
            yield pa.RecordBatch.from_arrays([*columns[:2], _exact(out[2]), columns[2], _exact(out[4])], ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _met(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """Anchors and rows of one (group, dim), dealt so that every block of anchors meets every block of rows in one cell.

    Blocks are by the hash of ids, in the order of ids within; a row goes out once for each block of anchors and an anchor once
    for each block of rows, so a hot group only means more cells.
    """
    key = ["group", "dim"]
    sizes = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(ANCHORS)).cast("int").alias("na"))
    sizes = sizes.join(rows.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(ROWS)).cast("int").alias("nc")), key)
    sizes = staged(sizes, "negative_groups")  # a plain side of the joins, so that Spark splits a hot group's partition

    def dealt(df: DataFrame, own: str, other: str, into: str, across: str, salt: int) -> DataFrame:
        block = F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(own)).cast("int").alias(into)
        laid = df.join(sizes, key).withColumn(across, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return laid.select(*key, block, across, "asks", "id", "label", "v", "wanted")

    both = dealt(asked, "na", "nc", "ab", "cb", 1).unionByName(dealt(rows, "nc", "na", "cb", "ab", 2))
    return both.repartition(parts(rows.sparkSession), *CELL).sortWithinPartitions(*CELL, "asks", "id")


def _best(df: DataFrame, keys: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Callable[[Column], Column],
    relabel: Callable[[Column, Column], Column] = lambda vec_id, label: label,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of every anchor.

    A component x counts as floor(scale * x); the score of two rows is the exact inner product of these. Anchors are the rows that
    meet ``anchors`` (a condition on vec_id). Their positives are the ``positives`` best other rows of their label, by score, ties
    to the smaller vec_id. For each, the ``negatives`` best rows of other labels whose score is between ``low`` and ``high`` percent
    of the positive's, in the same order. An anchor without positives, or a positive without fitting rows, has no row.

    The scores come out of products with wide integers that hold a component of up to 1024 candidates each (``Packed``). Every row
    meets every anchor in a cell of two blocks: first the rows of an anchor's label, then all rows, where those of its own label
    are left out; cells give at most k rows for each anchor or positive.

    ``label`` is a whole number and ``relabel`` (of vec_id and label) is applied first. Rows with a null label, vector or vec_id, or
    with a null or non-finite component take no part. Vectors meet only those of their own length; empty ones score 0 with each
    other. Rows that share a vec_id count once, as the smallest label and vector. Scores of more than 38 digits count as ones of
    38, and are returned as the nearest long, as all beyond a long are. An empty table gives an empty result; other columns are
    left out.
    """
    sound = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False)))
    rows = rows.select("id", relabel(F.col("id"), F.col("label")).cast("long").alias("label"), "v").filter("label is not null")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("one")).select("id", "one.*")
    rows = staged(rows.withColumn("dim", F.size("v")), "negative_rows")
    wanted = "array<struct<positive_id: bigint, positive_score: decimal(38,0)>>"
    plain = rows.withColumn("asks", F.lit(False)).withColumn("wanted", F.lit(None).cast(wanted))
    asked = rows.filter(anchors(F.col("id"))).withColumn("asks", F.lit(True))

    by_label = _met(asked.withColumn("group", F.col("label")).withColumn("wanted", F.lit(None).cast(wanted)), plain.withColumn("group", F.col("label")))
    found = by_label.mapInArrow(_positives(scale, positives), "anchor_id long, positive_id long, positive_score decimal(38,0)")
    best = _best(found, ["anchor_id"], "positive_score", "positive_id", positives)
    listed = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("wanted"))
    listed = staged(listed, "negative_positives")

    whole = F.lit(0).cast("long")
    everything = _met(asked.join(listed, "id").withColumn("group", whole), plain.withColumn("group", whole))
    columns = "anchor_id long, positive_id long, positive_score decimal(38,0), negative_id long, negative_score decimal(38,0)"
    mined = everything.mapInArrow(_negatives(scale, negatives, low, high), columns)
    chosen = _best(mined, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)

    def as_long(column: str) -> Column:
        bound = [F.lit(x).cast("decimal(38,0)") for x in (-(2**63), 2**63 - 1)]
        return F.greatest(F.least(F.col(column), bound[1]), bound[0]).cast("long").alias(column)

    return chosen.select("anchor_id", "positive_id", "rank", "negative_id", as_long("positive_score"), as_long("negative_score"))
