import pytest
from conftest import at, tuples

from ledgerlens.sources import session
from ledgerlens.sources.catalog import CONTRACTS, Catalog, conform


def test_catalog_formats_share_the_contract(spark, table, tmp_path):
    rows = table(CONTRACTS["readings"], ("a", at("2024-01-01 10:00"), 1.5), ("b", at("2024-01-02"), None))
    for fmt in ("parquet", "orc", "json", "csv"):
        rows.write.format(fmt).save(str(tmp_path / fmt))
        catalog = Catalog(spark).file("readings", str(tmp_path / fmt), fmt)
        assert tuples(catalog["readings"], "tag", "ts", "value") == tuples(rows, "tag", "ts", "value")
    rows.createOrReplaceTempView("readings_view")
    assert Catalog(spark).table("readings", "readings_view")["readings"].count() == 2


def test_unknown_name(spark):
    with pytest.raises(KeyError, match="no table registered"):
        Catalog(spark)["nothing"]


def test_conform_trims_trailing_blanks_and_casts(table):
    raw = table("code string, label string", ("1", "oil  "), ("2", " x"))
    out = conform(raw, "id int, name string", {"id": "code", "name": "label"})
    assert out.dtypes == [("id", "int"), ("name", "string")]
    assert tuples(out, "id", "name") == [(1, "oil"), (2, " x")]


def test_staged_result_is_written_once_and_pruned(spark, table):
    df = session.staged(table("a int, b string", (1, "x"), (2, "y")), "test", by=("b",))
    assert tuples(df.filter("b = 'y'"), "a") == [(2,)]
    assert df.inputFiles()[0].replace("file://", "").startswith(session.shared_dir(spark).replace("file://", ""))
