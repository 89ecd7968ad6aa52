"""Stages of the corpus pipeline: each takes the documents its predecessor kept and lets its operator's decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grouping import first_per_key
from ..sources.session import staged
from .common import read
from .lookup import STEP
from .minhash import near_duplicates
from .packing import packed
from .secrets import redacted
from .toxicity import toxicity


def _without(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` without the doc_ids that were decided on. Merged at every size, as what goes grows with the corpus."""
    gone = decisions.select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5. Every row is decided on by itself, also where a doc_id repeats or is null: scores depend on
    the text alone, so a row is known by its doc_id and the hash of its text."""
    keyed = docs.withColumn("_text", F.xxhash64("text"))
    scored = toxicity(keyed, read(spark, sf_dir, "labels"), row="_text")
    gone = scored.filter("predicted = 1").select(F.col("doc_id").alias("_doc"), F.col("_text").alias("_gone"))
    gone = staged(gone, "toxic_rows", batch=STEP).distinct()
    toxic = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_gone"))
    return keyed.join(gone.hint("merge"), toxic, "left_anti").select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that with the smallest doc_id; of rows that share it the one with the
    smallest text (null last) and then the smallest other columns. Rows without doc_id stay."""
    found = staged(near_duplicates(docs), "components")
    left = _without(docs, found.filter("not kept and doc_id is not null")).filter("doc_id is not null")
    return first_per_key(left, ["doc_id"], [F.col("text").isNull(), F.col("text")]).unionByName(docs.filter("doc_id is null"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars counted anew where there is one."""
    clean = redacted(docs)
    if "n_chars" not in docs.columns:
        return clean
    counted = F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.withColumn("n_chars", counted).select(docs.columns)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packed(docs)


def run(spark: SparkSession, sf_dir: str, stages) -> DataFrame:
    """The stages applied to the table documents, each result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in stages:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
