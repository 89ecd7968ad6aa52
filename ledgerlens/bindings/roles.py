"""Driver tables in the roles the operators expect.

``read`` is the only place that knows the file layout. Every role is derived from whole tables; literal
tables (shifts, analyses, rules) are configuration. ``CTES`` states the same roles in SQL for the oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.rules import rows_table
from ..functions.times import midnight, ntz, shift

ANALYSES = [("DAY", "model-d", "daily"), ("MONTH", "model-m", "cumulative")]
SHIFTS = [(20, 12), (8, 24)]


_SCHEMAS: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; its schema is looked up in the files once, not at every use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def within(df: DataFrame, ts: str, span: tuple[str, str] | None) -> DataFrame:
    """Rows whose stored time lies in the span, ends included: a predicate that reaches the scan."""
    return df if span is None else df.filter((F.col(ts) >= ntz(span[0])) & (F.col(ts) <= ntz(span[1])))


def analyses(spark: SparkSession) -> DataFrame:
    return rows_table(spark, "analysis_id string, model_id string, name string", ANALYSES)


def shifts(spark: SparkSession) -> DataFrame:
    return rows_table(spark, "start_hour int, duration int", SHIFTS)


def day_id(ts: Column) -> Column:
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def month_id(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def calendar_cases(times: DataFrame, ts: str) -> DataFrame:
    """Daily and monthly cases from the first to the last day that occurs, without gaps: a calendar, whose
    length does not grow with the number of rows. The times are read once."""
    span = times.agg(midnight(F.min(ts)).alias("lo"), midnight(F.max(ts)).alias("hi"))
    days = span.select("lo", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))

    def case(case_id: Column, analysis: str, start: Column, unit: str, number) -> Column:
        return F.struct(
            case_id.alias("case_id"),
            F.when(F.year("day") > 0, analysis).alias("analysis_id"),  # a column, not a constant
            start.alias("start_time"),
            shift(start, unit, 1).alias("end_time"),
            number(shift(start, unit, -1)).alias("prev_case_id"),
        )

    day, first = F.col("day"), F.date_trunc("MONTH", "day").cast("timestamp_ntz")
    daily = case(day_id(day), "DAY", day, "DAY", day_id)
    monthly = F.when((F.dayofmonth("day") == 1) | (day == F.col("lo")), case(month_id(day), "MONTH", first, "MONTH", month_id))
    return days.select(F.inline(F.array_compact(F.array(daily, monthly))))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_cases(read(spark, sf_dir, "orders"), "o_orderdate")


def log_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_cases(read(spark, sf_dir, "events"), "ts")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("T"), F.col("user_id")).alias("tag"), "ts", "value"
    )


def order_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf_dir, "orders").select(
        key.alias("transfer_id"),
        F.col("o_orderdate").alias("start_time"),
        F.when(
            F.col("o_orderstatus") != "O", shift(F.col("o_orderdate"), "DAY", (key % 5 + 1).cast("int"))
        ).alias("end_time"),
        F.when(key % 3 == 0, F.concat(F.lit("S"), cust % 89))
        .otherwise(F.concat(F.lit("C"), cust))
        .alias("source_uid"),
        F.concat(F.lit("S"), key % 97).alias("destination_uid"),
        F.concat(F.lit("N"), cust % 29).alias("source_node"),
        F.concat(F.lit("N"), key % 23).alias("dest_node"),
    )


def event_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, user = F.col("event_id"), F.col("user_id")
    start = F.date_trunc("HOUR", "ts").cast("timestamp_ntz")
    return read(spark, sf_dir, "events").select(
        key.alias("transfer_id"),
        start.alias("start_time"),
        F.when(F.col("event_type") != "error", shift(start, "HOUR", (key % 5 + 1).cast("int"))).alias("end_time"),
        F.concat(F.lit("C"), user).alias("source_uid"),
        F.concat(F.lit("S"), key % 97).alias("destination_uid"),
        F.concat(F.lit("N"), user % 29).alias("source_node"),
        F.concat(F.lit("N"), key % 23).alias("dest_node"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    def kind(table: str, key: str, prefix: str, name: str) -> DataFrame:
        return read(spark, sf_dir, table).select(
            F.concat(F.lit(prefix), F.col(key)).alias("uid"), F.lit(name).alias("type")
        )

    return (
        kind("customer", "c_custkey", "C", "Unit")
        .unionByName(kind("supplier", "s_suppkey", "S", "Tank"))
        .unionByName(kind("nation", "n_nationkey", "N", "Node"))
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = read(spark, sf_dir, "nation").select(
        F.concat(F.lit("AN"), F.col("n_nationkey")).alias("alias_id"),
        F.lit("Flow").alias("alias_name"),
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("node_id"),
        F.lit(None).cast("string").alias("module_id"),
    )
    modules = read(spark, sf_dir, "supplier").select(
        F.concat(F.lit("AS"), F.col("s_suppkey")).alias("alias_id"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("MassTotal")).otherwise(F.lit("Level")).alias("alias_name"),
        F.lit(None).cast("string").alias("node_id"),
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("module_id"),
    )
    return nodes.unionByName(modules)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML property documents of the aliases: every tenth lacks the tag, every eleventh has an empty one."""

    def documents(table: str, key: str, prefix: str) -> DataFrame:
        k = F.col(key)
        body = (
            F.when(k % 10 == 7, F.lit("<Properties/>"))
            .when(k % 11 == 5, F.lit('<Properties TagName=""/>'))
            .otherwise(F.concat(F.lit('<Properties Unit="t" TagName="T'), k, F.lit('"/>')))
        )
        return read(spark, sf_dir, table).select(
            F.concat(F.lit(prefix), k).alias("object_id"), body.alias("properties")
        )

    return documents("nation", "n_nationkey", "AN").unionByName(documents("supplier", "s_suppkey", "AS"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML document per event: many repeats, every tenth user without the attribute."""
    k = F.col("user_id")
    body = F.when(k % 10 == 7, F.lit("<Properties/>")).otherwise(
        F.concat(F.lit('<Properties TagName="'), F.when(k % 11 != 5, F.concat(F.lit("T"), k)).otherwise(""), F.lit('"/>'))
    )
    return read(spark, sf_dir, "events").select(k.alias("object_id"), body.alias("properties"))


def tag_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as measuring places; names cover 'T_..', 'M_..', bare 'T' and near misses."""
    k = F.col("c_custkey")
    name = (
        F.when(k % 5 == 0, F.concat(F.lit("T_"), k))
        .when(k % 5 == 1, F.concat(F.lit("M_"), k))
        .when(k % 5 == 2, F.lit("T"))
        .when(k % 5 == 3, F.concat(F.lit("TX"), k))
        .otherwise(F.concat(F.lit("XT_"), k))
    )
    return read(spark, sf_dir, "customer").select(F.concat(F.lit("C"), k).alias("sf_id"), name.alias("sf_name"))


def tag_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer").select(
        F.when(k % 7 == 3, F.lit("  ")).when(k % 7 != 4, (k + 1000).cast("string")).alias("settings"),
        F.concat(F.lit("C"), k).alias("af_element"),
        F.when(k % 3 == 0, F.lit("TagID")).when(k % 3 == 1, F.lit("tagid")).otherwise(F.lit("Unit")).alias("attribute"),
        F.when(k % 13 == 0, F.lit(1)).otherwise(F.lit(0)).alias("is_deleted"),
    )


CTES = {
    "analyses": "analyses(analysis_id, model_id, name) AS (VALUES ('DAY','model-d','daily'),('MONTH','model-m','cumulative'))",
    "cases": """days AS (SELECT CAST(unnest(generate_series(date_trunc('day', min(o_orderdate)), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
cases AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS case_id, 'DAY' AS analysis_id, CAST(d AS TIMESTAMP) AS start_time,
         CAST(d + INTERVAL 1 DAY AS TIMESTAMP) AS end_time, CAST(strftime(d - INTERVAL 1 DAY, '%Y%m%d') AS INT) AS prev_case_id
  FROM days
  UNION ALL
  SELECT DISTINCT CAST(strftime(d, '%Y%m') AS INT), 'MONTH', CAST(date_trunc('month', d) AS TIMESTAMP),
         CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS TIMESTAMP),
         CAST(strftime(date_trunc('month', d) - INTERVAL 1 DAY, '%Y%m') AS INT)
  FROM days)""",
    "readings": "readings AS (SELECT 'T' || user_id AS tag, ts, value FROM events)",
    "order_transfers": """transfers AS (
  SELECT o_orderkey AS transfer_id, o_orderdate AS start_time,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 5 + 1 AS INT)) END AS end_time,
         CASE WHEN o_orderkey % 3 = 0 THEN 'S' || (o_custkey % 89) ELSE 'C' || o_custkey END AS source_uid,
         'S' || (o_orderkey % 97) AS destination_uid, 'N' || (o_custkey % 29) AS source_node, 'N' || (o_orderkey % 23) AS dest_node
  FROM orders)""",
    "event_transfers": """transfers AS (
  SELECT event_id AS transfer_id, date_trunc('hour', ts) AS start_time,
         CASE WHEN event_type <> 'error' THEN date_trunc('hour', ts) + to_hours(CAST(event_id % 5 + 1 AS INT)) END AS end_time,
         'C' || user_id AS source_uid, 'S' || (event_id % 97) AS destination_uid,
         'N' || (user_id % 29) AS source_node, 'N' || (event_id % 23) AS dest_node
  FROM events)""",
    "tagging": """entities AS (
  SELECT 'C' || c_custkey AS uid, 'Unit' AS object_type FROM customer
  UNION ALL SELECT 'S' || s_suppkey, 'Tank' FROM supplier
  UNION ALL SELECT 'N' || n_nationkey, 'Node' FROM nation),
aliases AS (
  SELECT 'AN' || n_nationkey AS alias_id, 'Flow' AS alias_name, 'N' || n_nationkey AS node_id, CAST(NULL AS VARCHAR) AS module_id FROM nation
  UNION ALL SELECT 'AS' || s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'MassTotal' ELSE 'Level' END, CAST(NULL AS VARCHAR), 'S' || s_suppkey FROM supplier),
attributes AS (
  SELECT 'AN' || n_nationkey AS object_id, n_nationkey AS k FROM nation
  UNION ALL SELECT 'AS' || s_suppkey, s_suppkey FROM supplier),
alias_tags AS (SELECT object_id, 'T' || k AS tag FROM attributes WHERE NOT (k % 10 = 7) AND NOT (k % 11 = 5))""",
    "tag_settings": """objects AS (
  SELECT 'C' || c_custkey AS sf_id, CASE c_custkey % 5 WHEN 0 THEN 'T_' || c_custkey WHEN 1 THEN 'M_' || c_custkey
         WHEN 2 THEN 'T' WHEN 3 THEN 'TX' || c_custkey ELSE 'XT_' || c_custkey END AS sf_name FROM customer),
settings AS (
  SELECT CASE c_custkey % 7 WHEN 3 THEN '  ' WHEN 4 THEN NULL ELSE CAST(c_custkey + 1000 AS VARCHAR) END AS settings,
         'C' || c_custkey AS af_element,
         CASE c_custkey % 3 WHEN 0 THEN 'TagID' WHEN 1 THEN 'tagid' ELSE 'Unit' END AS attribute,
         CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END AS is_deleted
  FROM customer)""",
}


def with_ctes(*names: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(CTES[n] for n in names) + "\n"


def more_ctes(*names: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(CTES[n] for n in names) + ",\n"
