"""Logical table names to DataFrames, whatever the place they live in."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The column contract of every input role.
CONTRACTS = {
    "cases": "case_id int, analysis_id string, start_time timestamp_ntz, end_time timestamp_ntz, prev_case_id int",
    "analyses": "analysis_id string, model_id string, name string",
    "objects": "id int, object_type_id int, sf_id string, sf_name string, name string, is_deleted int",
    "object_types": "id int, name string, code_name string",
    "users": "id int, name string",
    "products": "id int, name string, is_deleted int",
    "shifts": "start_hour int, duration int",
    "transfers": "start_time timestamp_ntz, end_time timestamp_ntz, source_uid string, destination_uid string, "
    "source_node string, dest_node string",
    "readings": "tag string, ts timestamp_ntz, value double",
    "positions": "object_id int, case_id int, product_id int, measured double, mass_without_dr double, "
    "dead_residue_mass double, free_volume double, passport_state string, number_park string, grouping string",
    "ledger": "id int, case_id int, name string, open_mass double, coming_mix double, end_mass double, "
    "measured_day double, measured_accum double",
}


@dataclass
class Catalog:
    """Named DataFrames. Sources: parquet, ORC, CSV, JSON, JDBC, tables or ready DataFrames."""

    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)
    spans: dict[str, Callable[[str, str], DataFrame]] = field(default_factory=dict)

    def add(self, name: str, df: DataFrame) -> "Catalog":
        self.tables[name] = df
        return self

    def timed(self, name: str, of_span: Callable[[str, str], DataFrame]) -> "Catalog":
        """A table whose case ids come from a stored time: ``of_span(start, end)`` reads the rows of a span."""
        self.spans[name] = of_span
        return self

    def within(self, name: str, span: tuple[str, str] | None) -> DataFrame:
        """The rows of a span, cut where they are read if the table is known by time; else the whole table."""
        return self.spans[name](*span) if span and name in self.spans else self[name]

    def parquet(self, name: str, path: str) -> "Catalog":
        return self.add(name, self.spark.read.parquet(path))

    def file(self, name: str, path: str, fmt: str, schema: str | None = None, **options) -> "Catalog":
        reader = self.spark.read.format(fmt).options(**options)
        schema = schema or CONTRACTS.get(name)
        return self.add(name, (reader.schema(schema) if schema and fmt in ("csv", "json") else reader).load(path))

    def table(self, name: str, table: str | None = None) -> "Catalog":
        return self.add(name, self.spark.table(table or name))

    def jdbc(self, name: str, url: str, table: str, **options) -> "Catalog":
        """Remote table; Spark pushes filters and columns. Give partitionColumn/lowerBound/... to read in parallel."""
        reader = self.spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        return self.add(name, reader.load())

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables and name in self.spans:
            return self.spans[name]("0001-01-01", "9999-12-31")
        if name not in self.tables:
            raise KeyError(f"no table registered under {name!r}")
        return self.tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self.tables or name in self.spans


def conform(df: DataFrame, schema: str, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Pick, rename and cast the columns of a contract; trailing blanks of text do not count."""
    rename = rename or {}
    cols = []
    for part in schema.split(","):
        name, dtype = part.strip().split(None, 1)
        col = F.col(rename.get(name, name)).cast(dtype)
        cols.append((F.rtrim(col) if dtype == "string" else col).alias(name))
    return df.select(*cols)
