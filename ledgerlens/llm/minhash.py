"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import staged
from .common import Forest, blocks, components, fixed, groups, lists, listed, numbers
from .lookup import STEP, sliced
from .shingles import band_keys, mix, shingle_sets, signature

SIZE = 220  # coordinates of a signature
ROWS = 5  # coordinates of a band: at a similarity of 0.75 a pair misses all 44 bands with probability 7e-6
NUM, DEN = 75, 100  # link if DEN * intersection >= NUM * union
LOOSE = 0.6  # estimates below are 5 standard deviations from 0.75
BLOCK = 512  # rows of a block of one bucket or cluster
HEAVY = 4000  # shingles that count as one more row of a block

_SALT = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_EDGE = "a long, b long"


def _identity(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set of shingles."""
    return tuple(int(mix(s ^ salt).sum(dtype=np.uint64).view(np.int64)) for salt in _SALT)


def _as_signed(s: np.ndarray) -> np.ndarray:
    return s.view(np.int64)


def _sketches(batches):
    """doc_id, text -> doc_id, n_shingles, k1, k2, sig (one byte a coordinate), bands."""
    for batch in sliced(batches, "text"):
        n, k1, k2, sigs, bands = [], [], [], [], []
        for s in shingle_sets(batch.column("text")):
            n.append(len(s))
            one, two = _identity(s)
            k1.append(one)
            k2.append(two)
            sig = signature(s, SIZE) if len(s) else None
            sigs.append(None if sig is None else sig.astype(np.uint8).tobytes())
            bands.append(np.zeros(0, np.int64) if sig is None else _as_signed(band_keys(sig, ROWS)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sigs, pa.binary()), listed(bands, pa.int64())],
            ["doc_id", "n_shingles", "k1", "k2", "sig", "bands"],
        )


def _edges(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _alike(batches):
    """Rows of a bucket's blocks -> a spanning forest of the pairs whose signatures agree in LOOSE of the coordinates."""
    decode = lambda x: {"id": numbers(x.column("id")), "b": numbers(x.column("b")), "sig": fixed(x.column("sig"))}
    for g in groups(batches, decode):
        ids, sig, side, n = g["id"], g["sig"], g["b"], len(g["id"])
        forest = Forest(n)
        for i in range(n - 1):
            others = np.flatnonzero(forest.root[i + 1 :] != forest.root[i]) + i + 1
            if not g["same"]:
                others = others[side[others] != side[i]]
            if len(others):
                for j in others[(sig[others] == sig[i]).sum(axis=1) >= LOOSE * SIZE]:
                    forest.join(i, int(j))
        a, b = forest.edges(ids)
        if len(a):
            yield _edges(a, b)


def _with_sets(batches):
    """key, id, text -> key, id, k1, sig, shingles."""
    for batch in sliced(batches, "text"):
        sets = list(shingle_sets(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("id"),
                pa.array([_identity(s)[0] for s in sets], pa.int64()),
                pa.array([signature(s, SIZE).astype(np.uint8).tobytes() for s in sets], pa.binary()),
                listed([_as_signed(s) for s in sets], pa.int64()),
            ],
            ["key", "id", "k1", "sig", "shingles"],
        )


def _linked(batches):
    """Rows of a cluster's blocks -> a spanning forest of the pairs whose full sets are similar enough."""
    decode = lambda x: {"id": numbers(x.column("id")), "b": numbers(x.column("b")), "sig": fixed(x.column("sig")), "s": lists(x.column("shingles"), np.int64)}
    for g in groups(batches, decode):
        ids, sig, side, sets, n = g["id"], g["sig"], g["b"], g["s"], len(g["id"])
        sizes = np.array([len(s) for s in sets])
        forest = Forest(n)
        for i in range(n - 1):
            others = np.flatnonzero(forest.root[i + 1 :] != forest.root[i]) + i + 1
            if not g["same"]:
                others = others[side[others] != side[i]]
            fits = DEN * np.minimum(sizes[others], sizes[i]) >= NUM * np.maximum(sizes[others], sizes[i])
            others = others[fits]
            if not len(others):
                continue
            agree = (sig[others] == sig[i]).sum(axis=1)
            order = np.argsort(-agree, kind="stable")
            for j in others[order[agree[order] >= LOOSE * SIZE]].tolist():
                if forest.root[i] == forest.root[j]:
                    continue
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if DEN * both >= NUM * (sizes[i] + sizes[j] - both):
                    forest.join(i, j)
        a, b = forest.edges(ids)
        if len(a):
            yield _edges(a, b)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Shingles are five consecutive words (runs of bytes other than space and 0x09-0x0D, A-Z lower-cased); documents are linked
    if the intersection of their sets is 0.75 of the union or more. component_id is the smallest doc_id reachable by links.

    1. One pass gives every text its set's identity, a signature and band keys (circulant MinHash). Equal sets become one class
       with its smallest doc_id, so exact copies never meet in pairs.
    2. Buckets of equal band keys are compared by signature in blocks, and leave a spanning forest of the alike; its components
       are clusters. Estimates only shut pairs out that are 5 standard deviations below the threshold.
    3. Within a cluster full sets are intersected in blocks, all pairs that could still join two components; the exact links'
       components are the result.

    Null or empty texts and texts without words have no shingles and link with nothing. Rows that share a doc_id count as
    versions of one document: what links with one of them is linked with all. Rows without doc_id get the component of their
    class, or null, and are kept only if null. Other columns are left out; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kinds = "doc_id long, n_shingles long, k1 long, k2 long, sig binary, bands array<long>"
    sketched = staged(texts.mapInArrow(_sketches, kinds), "sketches", batch=STEP)
    same = ["n_shingles", "k1", "k2"]
    classes = (
        sketched.filter("n_shingles > 0")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("id"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"))
    )
    classes = staged(classes, "classes")
    known = classes.filter("id is not null")
    banded = known.select("id", F.explode("bands").alias("key"))
    shared = staged(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").drop("n"), "shared_keys")
    members = staged(banded.join(shared, "key"), "buckets").join(known.select("id", "sig"), "id")
    soft = components(blocks(members, BLOCK).mapInArrow(_alike, _EDGE))
    clusters = staged(soft.select(F.col("id"), F.col("component").alias("key")), "clusters")
    full = (
        clusters.join(texts, clusters.id == texts.doc_id)
        .select("key", "id", "text")
        .mapInArrow(_with_sets, "key long, id long, k1 long, sig binary, shingles array<long>")
        .filter(F.size("shingles") > 0)
        .dropDuplicates(["key", "id", "k1"])
    )
    full = staged(full.drop("k1"), "cluster_sets", batch=STEP)
    heavy = F.lit(1) + F.size("shingles") / F.lit(HEAVY)
    found = components(blocks(full, BLOCK, heavy).mapInArrow(_linked, _EDGE))
    named = classes.select(*same, "id").join(found, "id", "left").select(*same, F.coalesce("component", "id").alias("component"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return (
        sketched.select("doc_id", *same)
        .join(named, same, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
