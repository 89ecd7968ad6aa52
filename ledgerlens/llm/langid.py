"""Language of a text: the nearest of several centroids per language among normalised TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import staged
from .lookup import sliced
from .shingles import mix

DIMS = 1 << 15  # coordinates: n-grams are hashed into them
GRAMS = (1, 2, 3)  # letters of an n-gram; blanks around words count as letters
CENTROIDS = 4  # of a language
SEEDS = 200  # rows of a language that seed its centroids (those with the smallest hash of the text)
ROUNDS = 8  # of the clustering of these
OUTLIERS = 0.01  # share of a centroid's own documents that lie beyond its distance of rejection
SHARP = 40.0  # how fast the score rises with the lead over the next language
STEP = 1 << 20  # bytes of text worked on at once

UNKNOWN = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point the small letter it stands for, 32 (a blank) if it is none."""
    if not _LETTER:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTER.append(table)
    return _LETTER[0]


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, coordinate, occurrences) of the n-grams of each text, sorted by text and coordinate.

    Letters count as small ones, whatever lies between words as one blank; n-grams of blanks alone don't count.
    """
    joined = "  ".join(t or "" for t in texts) + "  "
    at = np.repeat(np.arange(len(texts)), [len(t or "") + 2 for t in texts])
    points = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == 32
    kept = np.ones(len(points), bool)
    kept[1:] = ~(blank[1:] & blank[:-1] & (at[1:] == at[:-1]))
    points, at = points[kept].astype(np.uint64), at[kept]
    codes = []
    for n in GRAMS:
        if len(points) < n:
            continue
        code = np.full(len(points) - n + 1, n, np.uint64)
        for i in range(n):
            code = code << np.uint64(20) | points[i : len(points) - n + 1 + i]
        inner = at[: len(code)] == at[n - 1 :]
        if n < 3:  # a blank with blanks tells nothing
            some = np.zeros(len(code), bool)
            for i in range(n):
                some |= points[i : len(code) + i] != 32
            inner &= some
        place = (mix(code[inner]) & np.uint64(DIMS - 1)).astype(np.int64)
        codes.append(at[: len(code)][inner] * DIMS + place)
    found = np.sort(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([first, [len(found)]]))
    return found[first] // DIMS, found[first] % DIMS, counts


def weighed(text: np.ndarray, place: np.ndarray, counts: np.ndarray, idf: np.ndarray, size: int) -> np.ndarray:
    """TF-IDF weights, each text's of length 1 (or all 0): (1 + ln occurrences) * idf."""
    weights = (1 + np.log(counts)) * idf[place]
    length = np.sqrt(np.bincount(text, weights * weights, minlength=size))
    return weights / np.where(length > 0, length, 1)[text]


def cosines(text: np.ndarray, place: np.ndarray, weights: np.ndarray, centroids: np.ndarray, size: int) -> np.ndarray:
    """Of each text with each centroid (coordinate by centroid, of length 1)."""
    out = np.zeros((size, centroids.shape[1]))
    if len(text):
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        for k in range(centroids.shape[1]):
            out[text[first], k] = np.add.reduceat(weights * centroids[place, k], first)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(length > 0, length, 1)


def clustered(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: at most ``k`` centroids of length 1. The first seed is the row nearest the mean, each next one the row
    farthest from those before; rows that are no different give fewer centroids."""
    rows = rows[(rows != 0).any(axis=1)]
    if not len(rows):
        return np.zeros((0, rows.shape[1]))
    seeds = [int(np.argmax(rows @ rows.mean(axis=0)))]
    near = rows @ rows[seeds[0]]
    while len(seeds) < k and near.min() < 1 - 1e-9:
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, rows @ rows[seeds[-1]])
    centroids = rows[seeds]
    for _ in range(ROUNDS):
        own = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = _unit(sums)
    return centroids


def _batches(batches) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    for batch in sliced(batches, "text", STEP):
        yield batch, vectors(batch.column("text").to_pylist())


def _spread(batches):
    """text, n -> place, n: in how many documents each coordinate occurs; place -1 counts the documents."""
    total = np.zeros(DIMS + 1, np.int64)
    for batch, (_, place, _) in _batches(batches):
        total[:DIMS] += np.bincount(place, minlength=DIMS)
        total[DIMS] += batch.num_rows
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(held == DIMS, -1, held)), pa.array(total[held])], ["place", "n"])


def _gathered(shared):
    """lang, text -> centroid, place, weight: the sums of the documents' vectors by the nearest centroid of their language."""

    def run(batches):
        idf, centroids, owner, names = shared.value
        if not len(owner):
            return
        code = {name: i for i, name in enumerate(names)}
        sums = np.zeros((centroids.shape[1], DIMS))
        for batch, (text, place, counts) in _batches(batches):
            weights = weighed(text, place, counts, idf, batch.num_rows)
            near = cosines(text, place, weights, centroids, batch.num_rows)
            own = np.array([code.get(name, -1) for name in batch.column("lang").to_pylist()])
            near[own[:, None] != owner[None, :]] = -1
            best = np.where(own >= 0, np.argmax(near, axis=1), -1)[text]
            kept = best >= 0
            np.add.at(sums, (best[kept], place[kept]), weights[kept])
        centroid, place = np.nonzero(sums)
        for a in range(0, len(place), 1 << 16):
            part = slice(a, a + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(centroid[part], pa.int32()), pa.array(place[part], pa.int32()), pa.array(sums[centroid[part], place[part]])], ["centroid", "place", "weight"])

    return run


def _judged(shared):
    """doc_id, held_out, lang, text -> has (a letter), centroid (the nearest, -1 without any), cosine and score instead of text."""

    def run(batches):
        idf, centroids, owner, names = shared.value
        letters = _letters()
        for batch in sliced(batches, "text", STEP):
            texts = batch.column("text").to_pylist()
            size = len(texts)
            text, place, counts = vectors(texts)
            has = np.zeros(size, bool)
            has[text] = True
            near = cosines(text, place, weighed(text, place, counts, idf, size), centroids, size)
            best, cosine, score = np.full(size, -1), np.zeros(size), np.zeros(size)
            if len(owner):
                by = np.stack([near[:, owner == i].max(axis=1) for i in np.unique(owner)], axis=1)
                cosine = near.max(axis=1)
                best = np.where(near == cosine[:, None], owner[None, :], len(names)).argmin(axis=1)  # ties: the more frequent
                score = 1 / np.exp(SHARP * (by - cosine[:, None])).sum(axis=1)
            columns = [batch.column("doc_id"), batch.column("held_out"), batch.column("lang"), pa.array(has), pa.array(best, pa.int32()), pa.array(np.clip(cosine, 0, 1)), pa.array(np.clip(score, 0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang", "has", "centroid", "cosine", "score"])

    return run


def _sparse(shared):
    """lang, text -> lang, places, weights."""

    def run(batches):
        idf = shared.value
        for batch, (text, place, counts) in _batches(batches):
            weights = weighed(text, place, counts, idf, batch.num_rows)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            columns = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (place, weights)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), *columns], ["lang", "places", "weights"])

    return run


def _grouped(k: int):
    """The seeds of one language -> its clusters: lang, cluster, places, weights."""

    def run(seeds: pa.Table) -> pa.Table:
        rows = np.zeros((len(seeds), DIMS))
        order = sorted(zip(seeds.column("places").to_pylist(), seeds.column("weights").to_pylist()))  # the same clusters whatever came first
        for row, (places, weights) in zip(rows, order):
            row[places] = weights
        found = clustered(rows, k)
        places = [np.flatnonzero(c) for c in found]
        return pa.table({
            "lang": pa.array([seeds.column("lang")[0].as_py()] * len(found), pa.string()),
            "cluster": pa.array(range(len(found)), pa.int32()),
            "places": pa.array([p.tolist() for p in places], pa.list_(pa.int64())),
            "weights": pa.array([c[p].tolist() for c, p in zip(found, places)], pa.list_(pa.float64())),
        })

    return run


class Model(NamedTuple):
    """Weights of the coordinates, centroids as columns, the language each belongs to, and the languages, the most frequent first."""

    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    names: list[str]


def fitted(rows: DataFrame, centroids: int = CENTROIDS, seeds: int = SEEDS) -> Model:
    """The model of labelled texts (lang, text; no nulls).

    Document frequencies are counted over all of them. At most ``seeds`` different texts of each language (those with the smallest
    hash) are clustered, a language in a task; then each of all the texts joins the nearest of its language's clusters, and the
    sums of these, brought to length 1, are the centroids. What reaches the driver is one number a coordinate and the centroids.
    """
    context = rows.sparkSession.sparkContext
    spread = rows.select("text").mapInArrow(_spread, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    times = dict(zip(spread["place"], spread["n"]))
    total = times.pop(-1, 0)
    held = np.zeros(DIMS)
    held[list(times)] = list(times.values())
    idf = np.where(held > 0, np.log((1 + total) / (1 + held)) + 1, 0.0)

    hashed = rows.withColumn("hash", F.xxhash64("text"))
    different = hashed.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("n"))
    different = staged(different, "language_hashes")
    sizes = different.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang")
    names = [r.lang for r in sizes.collect()]
    drawn = different.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).filter(F.col("place") <= seeds)
    chosen = hashed.join(F.broadcast(drawn.select("lang", "hash")), ["lang", "hash"])  # ``seeds`` numbers a language
    chosen = chosen.groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text")
    sparse = chosen.mapInArrow(_sparse(context.broadcast(idf)), "lang string, places array<long>, weights array<double>")
    kinds = "lang string, cluster int, places array<long>, weights array<double>"
    found = sparse.groupBy("lang").applyInArrow(_grouped(centroids), kinds).orderBy("lang", "cluster").toArrow().to_pylist()
    owner = np.array([names.index(r["lang"]) for r in found], np.int64)
    first = np.zeros((DIMS, len(found)))
    for k, r in enumerate(found):
        first[r["places"], k] = r["weights"]

    model = Model(idf, first, owner, names)
    sums = rows.mapInArrow(_gathered(context.broadcast(model)), "centroid int, place int, weight double")
    sums = sums.groupBy("centroid", "place").agg(F.sum("weight").alias("weight")).toArrow()
    moved = np.zeros(first.shape)
    moved[sums.column("place").to_numpy(), sums.column("centroid").to_numpy()] = sums.column("weight").to_numpy()
    empty = ~(moved != 0).any(axis=0)
    moved[:, empty] = first[:, empty]
    return Model(idf, _unit(moved.T).T, owner, names)


def languages(
    docs: DataFrame,
    learn: Column,
    held_out: Column,
    centroids: int = CENTROIDS,
    seeds: int = SEEDS,
    outliers: float = OUTLIERS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cosine, accepted: one row per row of ``docs``.

    The vector of a text holds the TF-IDF weights of its n-grams of 1 to 3 letters, hashed into ``DIMS`` coordinates, with length 1.
    Each language has up to ``centroids`` centroids (``fitted``, from the rows that meet ``learn`` and have a text and a language);
    the nearest of all by cosine gives ``lang_pred``. ``score`` (0 to 1) grows with its lead over the best of each other language.

    Distance decides on rejection: a centroid reaches as far as all but the farthest ``outliers`` share of the learnt documents of
    its language that it is nearest to. Beyond that ``accepted`` is false, and the score falls in proportion to the cosine;
    ``lang_pred`` still is the nearest language, for the caller to keep or drop.

    A text that is null or has no letter is ``und`` with score and cosine 0, not accepted; so is any if nothing is learnt. Texts
    with letters, none of them in a learnt text, get the most frequent language with a score of 0. Ties go to the more frequent
    language. Texts are read whole, repeated rows are judged each for itself, the language of a row never is an input of its
    prediction; an empty table gives an empty result, other columns are left out. Bounded by the model: ``DIMS`` numbers a centroid.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                       F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    learnt = rows.filter("learn and text is not null and lang is not null").select("lang", "text")
    model = fitted(learnt, centroids, seeds)
    asked = rows.withColumn("lang", F.expr("if(learn, lang, null)")).select("doc_id", "held_out", "lang", "text")
    kinds = f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang string, has boolean, centroid int, cosine double, score double"
    judged = staged(asked.mapInArrow(_judged(docs.sparkSession.sparkContext.broadcast(model)), kinds), "languages")
    spark = docs.sparkSession
    owners = spark.createDataFrame([(k, model.names[o]) for k, o in enumerate(model.owner)], "centroid int, lang_pred string")
    right = judged.filter("has").join(F.broadcast(owners), "centroid").filter("lang = lang_pred")
    reach = right.groupBy("centroid").agg(F.percentile_approx("cosine", outliers, 10_000).alias("reach"))
    known = owners.join(reach, "centroid", "left")
    out = judged.join(F.broadcast(known), "centroid", "left")  # a row a centroid
    told = F.col("has") & F.col("lang_pred").isNotNull()
    near = F.coalesce(F.col("cosine") >= F.col("reach"), F.lit(False))
    fair = F.when(near | (F.coalesce("reach", F.lit(0.0)) <= 0), F.col("score")).otherwise(F.col("score") * F.col("cosine") / F.col("reach"))
    return out.select(
        "doc_id", "held_out",
        F.when(told, F.col("lang_pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(told & (F.col("cosine") > 0), fair).otherwise(F.lit(0.0)).alias("score"),
        F.when(told, F.col("cosine")).otherwise(F.lit(0.0)).alias("cosine"),
        (told & near).alias("accepted"),
    )
