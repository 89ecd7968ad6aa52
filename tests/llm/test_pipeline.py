"""Stages on dirty rows; the pipeline over the table against its stages' brute-force versions."""

import os

import pytest

import corpus_pipeline
from ledgerlens.llm import stages
from test_pairs import expected_documents
from test_texts import digest, hold_packing

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


@pytest.fixture
def folder(spark, tmp_path):
    labels = [(i, 1, int(i % 4 == 0)) for i in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i, f"row {i} " + " ".join(f"w{i}x{k}" for k in range(20)) + (" nasty vile nasty" if i % 4 == 0 else ""), "en", "s", 5, "k") for i in range(200)]
    rows += [(300, None, None, None, None, "k"), (301, "", "en", "s", 0, "k"), (None, "no id but a text", "en", "s", 3, "k"), (None, None, None, None, None, None)]
    rows += [(302, "password=abcdefgh and more", "en", "s", 1, "k"), (303, rows[1][1], "en", "s", 1, "k"), (1, rows[1][1], "en", "s", 5, "k")]
    rows += [(304, "nasty vile nasty", "en", "s", 16, "k")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_stages_on_dirty_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = stages.without_toxic(spark, docs, folder)
    assert clean.columns == docs.columns
    ids = sorted((repr(r["doc_id"]) for r in clean.collect()))
    assert ids == sorted([repr(i) for i in range(200) if i % 4] + ["300", "301", "302", "303", "1", "None", "None"])
    single = stages.without_near_copies(spark, clean, folder)
    assert single.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in single.collect()) == sorted([repr(i) for i in range(200) if i % 4] + ["300", "301", "302", "None", "None"])
    masked = {r["doc_id"]: r for r in stages.without_secrets(spark, single, folder).collect()}
    assert masked[302]["text"] == "[SECRET] and more" and masked[302]["n_chars"] == 17
    assert masked[300]["text"] is None and masked[300]["n_chars"] is None and masked[301]["n_chars"] == 0


def test_of_rows_that_share_a_doc_id_the_smallest_text_stays(spark, folder):
    rows = [(1, "b text", "x"), (1, "a text", "y"), (1, "a text", "x"), (2, None, "z"), (2, "some", "z")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3)
        got = sorted(tuple(r) for r in stages.without_near_copies(spark, docs, folder).collect())
        assert got == [(1, "a text", "x"), (2, "some", "z")]


def test_toxic_rows_go_each_by_itself(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    more = [(1, "nasty vile nasty", "en", "s", 16, "k"), (4, "row 4 without such words", "en", "s", 24, "k"), (None, "nasty vile nasty", "en", "s", 16, "k")]
    got = stages.without_toxic(spark, docs.union(spark.createDataFrame(more, docs.schema)), folder).collect()
    assert not [r for r in got if "nasty" in (r["text"] or "")]
    assert [r["text"] for r in got if r["doc_id"] == 4] == ["row 4 without such words"]
    assert [r["text"].split()[:2] for r in got if r["doc_id"] == 1] == [["row", "1"]] * 2
    assert sum(r["doc_id"] is None for r in got) == 2


def test_stages_on_nothing(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


@needs_tables
def test_pipeline_over_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r["doc_id"] for r in stages.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["predicted"]}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in toxic]
    kept = {i for i, _, _, keep in expected_documents(rows) if keep}
    masked = {}
    for r in stages.redacted(docs.filter(docs.doc_id.isin(sorted(kept)))).collect():
        masked[r["doc_id"]] = r["text"]
        assert digest(r["text"])[:3] == (0, 0, 0)
    got = corpus_pipeline.run(spark, SF).collect()
    hold_packing(got, sorted(masked.items()), 2048)
