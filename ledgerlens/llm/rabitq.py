"""Near-duplicate embeddings: randomised-rotation binary codes whose bounds decide which pairs are computed exactly."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.session import dropped, staged
from .common import Forest, components, dealt, groups, lists, numbers

LEAST = 0.9  # cosine of a link
SURE = 4.0  # width of the bounds: a true value lies above the upper bound with probability below 1e-4
ROUNDING = 1e-5  # more than what single precision adds to a bound
MISS = 0.002  # probability that a pair at LEAST shares no table
CELL = 1024  # vectors of a table's cell, on the average
ROUND = 4  # tables at most whose rows are on disk at once
BLOCK = 4096  # rows of a block of one cell or cluster
STEP = 256  # rows of a block compared at once
GATHERED = 1 << 15  # pairs of rows put together at once
COUNTED = 4 << 20  # keys counted at once
SEED = 77


@functools.lru_cache(8)
def rotations(dim: int, rows: int) -> np.ndarray:
    """Rows of random orthonormal matrices, the same in every task."""
    rng = np.random.Generator(np.random.PCG64(SEED + dim))
    found = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-rows // dim))]
    return np.concatenate(found)[:rows]


def usable(column) -> F.Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(fine & F.exists(column, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Codes:
    """Binary codes of unit vectors with what the unbiased estimate needs.

    A rotated vector o is kept as its signs x (times 1/sqrt(dim)) and the factor <x, o>; a vector q's inner product with o is
    estimated as <x, q> / <x, o>, off by at most SURE * sqrt((1 - f^2) / f^2 / (dim - 1)). q is kept in 8 bits a component, and
    the signs are theirs.
    """

    def __init__(self, small: np.ndarray, factor: np.ndarray, scale: np.ndarray):
        self.small, self.factor, self.scale, self.dim = small, factor, scale, small.shape[1]

    @classmethod
    def of(cls, units: np.ndarray) -> Codes:
        dim = units.shape[1]
        turned = units @ rotations(dim, dim).T
        scale = np.abs(turned).max(axis=1) / 127
        small = np.rint(turned / scale[:, None]).astype(np.int8)
        factor = np.where(small > 0, turned, -turned).sum(axis=1) / math.sqrt(dim)
        return cls(small, factor, scale)

    def stored(self) -> pa.Array:
        """A binary value a row: dim bytes and two doubles."""
        tail = np.stack([self.factor, self.scale], axis=1).astype(np.float64).view(np.uint8)
        flat = np.ascontiguousarray(np.concatenate([self.small.view(np.uint8), tail], axis=1))
        at = np.arange(len(flat) + 1, dtype=np.int32) * np.int32(flat.shape[1])
        return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(at), pa.py_buffer(flat)])

    @classmethod
    def read(cls, values: list[bytes]) -> Codes:
        """Of values of one length."""
        flat = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
        tail = np.ascontiguousarray(flat[:, -16:]).view(np.float64)
        return cls(np.ascontiguousarray(flat[:, :-16]).view(np.int8), tail[:, 0], tail[:, 1])

    @functools.cached_property
    def slack(self) -> np.ndarray:
        """How far at most the 8-bit vector is from the vector."""
        return self.scale * math.sqrt(self.dim) / 2

    @functools.cached_property
    def data(self) -> np.ndarray:
        """Rows whose product with a row of ``query`` is 0 or more where the upper bound reaches LEAST."""
        f2 = np.square(self.factor)
        wide = SURE * np.sqrt(np.maximum(0, 1 - f2) / f2 / max(self.dim - 1, 1e-9))
        signs = np.where(self.small > 0, 1, -1) / math.sqrt(self.dim)
        return np.concatenate([signs, np.ones((len(f2), 1)), (self.factor * (wide - LEAST))[:, None]], axis=1).astype(np.float32)

    @functools.cached_property
    def query(self) -> np.ndarray:
        near = self.small * self.scale[:, None]
        return np.concatenate([near, self.slack[:, None], np.ones((len(near), 1))], axis=1).astype(np.float32)

    def possible(self, rows: slice, others: np.ndarray | slice) -> np.ndarray:
        """Whether the pair's upper bound, taken from either side, reaches LEAST."""
        return (self.data[rows] @ self.query[others].T >= -ROUNDING) & (self.query[rows] @ self.data[others].T >= -ROUNDING)

    def pairs(self, side: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The possible pairs of a block's rows, or of the rows of two blocks."""
        if same:
            left = right = np.arange(len(side))
        else:
            left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min())
        data, query, others, asked = self.data[left], self.query[left], self.data[right], self.query[right]
        for a in range(0, len(left), STEP):
            rows, first = slice(a, a + STEP), a if same else 0
            may = data[rows] @ asked[first:].T >= -ROUNDING
            if dense := np.count_nonzero(may) * 16 > may.size:
                may &= query[rows] @ others[first:].T >= -ROUNDING
            i, j = np.divmod(np.flatnonzero(may), max(1, may.shape[1]))
            i, j = i + a, j + first
            if same:
                i, j = i[i < j], j[i < j]
            if not dense:
                ok = _dots(query, others, i, j) >= -ROUNDING
                i, j = i[ok], j[ok]
            if len(i):
                yield left[i], right[j]

    def close(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether a pair may reach LEAST by the 8-bit vectors, which tells nearly all unlike pairs that the signs let through."""
        at = slice(0, self.dim)
        return _dots(self.query[:, at], self.query[:, at], i, j) + self.slack[i] + self.slack[j] * (1 + self.slack[i]) >= LEAST - ROUNDING


def _dots(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Products of rows of x with rows of y."""
    out = np.empty(len(i), x.dtype)
    for a in range(0, len(i), GATHERED):
        at = slice(a, a + GATHERED)
        out[at] = np.einsum("ij,ij->i", x[i[at]], y[j[at]])
    return out


@functools.lru_cache(64)
def agreement(count: int) -> float:
    """Probability that vectors of cosine LEAST have the same nearest of ``count`` Gaussian directions and their opposites.

    Products with a Gaussian direction are normal with that correlation, in any dimension; this adds up over both largest ones.
    """
    step = 0.02
    x = np.arange(step / 2, 8, step)
    rest = 1 - LEAST**2
    one, other = (np.exp(-(x[:, None] ** 2 - 2 * c * x[:, None] * x + x**2) / (2 * rest)) / (2 * math.pi * math.sqrt(rest)) * step**2 for c in (LEAST, -LEAST))
    below = np.pad(2 * (one + other).cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
    below = (below[1:, 1:] + below[1:, :-1] + below[:-1, 1:] + below[:-1, :-1]) / 4
    return float(2 * count * (one * np.minimum(below, 1) ** (count - 1)).sum())


def levels(bits: int) -> list[int]:
    """Bits of the directions that make a key: one family, or two where that were too many products."""
    return [b for b in ((bits,) if bits <= 10 else (bits - bits // 2, bits // 2)) if b]


def tables(count: int) -> tuple[int, int]:
    """(bits of a key, tables): keys grow with the logarithm of the rows, tables follow from MISS."""
    bits = max(0, math.ceil(math.log2(max(1, count) / CELL)))
    same = math.prod(agreement(1 << (b - 1)) for b in levels(bits))
    return bits, math.ceil(math.log(MISS) / math.log(1 - same)) if same < 1 else 1


@functools.lru_cache(256)
def directions(dim: int, table: int, level: int, count: int) -> np.ndarray:
    """Columns of independent normal numbers, the same in every task."""
    rng = np.random.Generator(np.random.PCG64([SEED, dim, table, level]))
    return rng.standard_normal((dim, count), dtype=np.float32)


def keys(units: np.ndarray, bits: int, table: int) -> np.ndarray:
    """The cell of every vector in a table: its length, the table, and the nearest direction of each family."""
    n, dim = units.shape
    cell = np.full(n, (dim << 40) + (table << 32), np.int64)
    inside = np.zeros(n, np.int64)
    for k, b in enumerate(levels(bits)):
        found = units @ directions(dim, table, k, 1 << (b - 1))
        most = np.abs(found).argmax(axis=1)
        inside = (inside << b) + 2 * most + (found[np.arange(n), most] > 0)
    return cell + inside


def _matrices(vectors: list[np.ndarray]):
    """Positions and matrix of the vectors of each length."""
    sizes = np.array([len(v) for v in vectors])
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, np.stack([vectors[i] for i in at]).astype(np.float64)


def _cells(bits: int, count: int):
    """embedding -> key, n: how many vectors of a part of the rows are in a cell."""

    def counted(held):
        key, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n, pa.int64())], ["key", "n"])

    def run(batches):
        held, total = [], 0
        for batch in batches:
            for _, _, matrix in _matrices(lists(batch.column("embedding"), np.float64)):
                units = unit(matrix).astype(np.float32)
                held += [keys(units, bits, t) for t in range(count)]
                total += len(units) * count
            if total > COUNTED:
                yield counted(held)
                held, total = [], 0
        if held:
            yield counted(held)

    return run


def _hashed(bits: int, chosen: range):
    """id, embedding -> a row for each of the tables: key, id, code."""

    def run(batches):
        for batch in batches:
            ids = numbers(batch.column("id"))
            for _, at, matrix in _matrices(lists(batch.column("embedding"), np.float64)):
                units = unit(matrix)
                code, own, single = Codes.of(units).stored(), pa.array(ids[at]), units.astype(np.float32)
                for t in chosen:
                    yield pa.RecordBatch.from_arrays([pa.array(keys(single, bits, t)), own, code], ["key", "id", "code"])

    return run


def _alike(batches):
    """Rows of a cell's blocks -> a spanning forest of the pairs that the bounds don't shut out."""
    decode = lambda x: {"id": numbers(x.column("id")), "b": numbers(x.column("b")), "code": x.column("code").to_pylist()}
    for g in groups(batches, decode):
        n = len(g["id"])
        if n < 2:
            continue
        codes, forest = Codes.read(g["code"]), Forest(n)
        for i, j in codes.pairs(g["b"], g["same"]):
            apart = forest.root[i] != forest.root[j]
            i, j = i[apart], j[apart]
            near = codes.close(i, j)
            forest.link(i[near], j[near])
            if not forest.root.any():
                break
        a, b = forest.edges(g["id"])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _linked(batches):
    """Rows of a cluster's blocks -> id, weight of the links found here, id of the root in this block's forest."""

    def decode(x):
        return {"id": numbers(x.column("id")), "b": numbers(x.column("b")), "n": numbers(x.column("n")), "v": lists(x.column("embedding"), np.float64)}

    for g in groups(batches, decode):
        ids, weight, n = g["id"], g["n"], len(g["id"])
        forest, links = Forest(n), np.zeros(n, np.int64)
        for _, at, matrix in _matrices(g["v"]):
            units = unit(matrix)
            for i, j in Codes.of(units).pairs(g["b"][at], g["same"]):
                hit = _dots(units, units, i, j) >= LEAST  # the exact recomputation
                i, j = at[i[hit]], at[j[hit]]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                forest.link(i, j)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[forest.root])], ["a", "links", "b"])


def _several(sizes: DataFrame) -> DataFrame:
    """key, nb of the groups of several blocks, out of key, n of all; at most one in BLOCK rows is such a group."""
    large = sizes.filter(F.col("n") > BLOCK).select("key", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("nb"))
    return F.broadcast(staged(large, "large_groups", once=True))


def _blocks(rows: DataFrame, several: DataFrame) -> DataFrame:
    """The rows dealt by key as ``blocks`` deals them, in one shuffle."""
    return dealt(rows.join(several, "key", "left").withColumn("nb", F.coalesce("nb", F.lit(1))))


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two rows are linked if their vectors' cosine, in double precision, is at least 0.9. n_links counts the other rows linked
    directly, component_id is the smallest vec_id reachable.

    1. Equal vectors form one class with a row count, so copies never meet in pairs.
    2. Tables of random keys, the nearest of many Gaussian directions, give cells; in blocks of a cell, binary codes and their
       bounds shut out pairs that can't reach 0.9, and 8-bit codes most of those left. The rest's components are clusters. A few
       tables go at once, and what they shuffle is dropped before the next.
    3. In blocks of a cluster, with all its vectors, the same bounds pick the pairs that are computed exactly; these decide.

    Null or zero vectors and those with a null or non-finite component link with nothing, and vectors of different length never
    link. Rows that share a vec_id but not the vector are versions of one vector: their links add up. Rows without vec_id count
    as links of others. An empty table gives an empty result; other columns are left out.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    same = [F.xxhash64(F.lit(1), "embedding").alias("h1"), F.xxhash64(F.lit(2), "embedding").alias("h2")]
    fine = rows.filter(usable(F.col("embedding")))
    kind = F.col("embedding") if vectors.schema[embedding].dataType == T.ArrayType(T.FloatType()) else F.col("embedding").cast("array<double>")
    classes = (
        fine.groupBy("embedding")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
        .select("id", "n", *same, kind.alias("embedding"))
    )
    classes = staged(classes, "vector_classes", once=True)
    known = classes.filter("id is not null")
    bits, count = tables(known.count())
    cells = known.select("embedding").mapInArrow(_cells(bits, count), "key long, n long")
    several = _several(cells.groupBy("key").agg(F.sum("n").alias("n")))
    found, made = [], []
    rounds = math.ceil(count / ROUND)
    for k in range(rounds):
        chosen = range(k, count, rounds)
        hashed = known.select("id", "embedding").mapInArrow(_hashed(bits, chosen), "key long, id long, code binary")
        found.append(staged(_blocks(hashed, several).mapInArrow(_alike, "a long, b long").distinct(), "alike", once=True, made=made))
    soft = components(functools.reduce(DataFrame.union, found))
    dropped(vectors.sparkSession, made)
    soft = soft.select("id", F.col("component").alias("key"))
    members = known.join(soft, "id").select("key", "id", "n", "embedding")
    several = _several(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    found = staged(_blocks(members, several).mapInArrow(_linked, "a long, links long, b long"), "vector_links", once=True)
    links = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("a <> b").select("a", "b"))
    result = (
        classes.select("id", "n", "h1", "h2")
        .join(links, "id", "left")
        .join(joined, "id", "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    )
    part = F.when(usable(F.col("embedding")), F.struct(*same))
    return (
        rows.select("vec_id", part.alias("k"))
        .select("vec_id", "k.h1", "k.h2")
        .join(result, ["h1", "h2"], "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
