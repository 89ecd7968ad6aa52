"""Snapshot tables and quality checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import snapshots as S
from ..operators import timeseries as T
from ..sources import sinks
from ..sources.session import run_dir
from . import roles as R
from .period_queries import DUCK_DAYTIME, stamp
from .roles import day_id, read

RUN = "2024-01-15"


def _weekly(spark, sf):
    readings = R.readings(spark, sf)
    return T.period_accumulation(readings.select("tag").distinct(), readings, RUN, 7)


def full_reload(spark, sf):
    """The first load is replaced by a second one; what is read back is the second."""
    path = run_dir(spark, "full_reload")
    weekly = _weekly(spark, sf)
    sinks.full_reload(weekly.filter(F.col("accumulation").isNull()), path)
    sinks.full_reload(weekly, path)
    return spark.read.parquet(path)


def _backup(spark, sf):
    """Event rows as a backup table; a run starts at 08:00, so rows past midnight belong to the day before."""
    run = F.timestamp_add("HOUR", F.lit(-8), F.col("ts")).cast("date")
    return read(spark, sf, "events").select("event_id", "ts", "value", run.alias("run_date"))


def _rerun(spark, sf):
    again = _backup(spark, sf).filter(F.col("run_date") == F.lit(RUN).cast("date")).drop("run_date")
    return again.withColumn("value", F.col("value") + 1)


def _replaced(df):
    return df.select("event_id", stamp("ts").alias("ts"), "value")


def replace_day(spark, sf):
    return _replaced(S.replace_day(_backup(spark, sf), _rerun(spark, sf), "ts", RUN))


def replace_day_by_date(spark, sf):
    return _replaced(
        S.replace_day(_backup(spark, sf).drop("run_date"), _rerun(spark, sf), "ts", RUN, strict=False)
    )


def replace_day_sink(spark, sf):
    """Stored by run date; the same run is written twice and counts once."""
    path = run_dir(spark, "replace_day")
    _backup(spark, sf).write.partitionBy("run_date").parquet(path)
    sinks.replace_day(_rerun(spark, sf), path, RUN)
    sinks.replace_day(_rerun(spark, sf), path, RUN)
    return _replaced(spark.read.parquet(path))


def restore_range(spark, sf):
    out = S.restore_range(read(spark, sf, "events"), 2024, 1, 15, 4)
    return out.select("event_id", stamp("ts").alias("ts"), "value")


def fill_defaults(spark, sf):
    """Customers with their last event as of a time; those without one get the defaults, the id stays."""
    events = read(spark, sf, "events")
    state = T.snapshot_at(events.select("user_id"), events, "user_id", "2024-01-03 00:00:00")
    wide = read(spark, sf, "customer").select("c_custkey").join(
        state, F.col("c_custkey") == F.col("user_id"), "left"
    ).select("c_custkey", "event_id", "ts", "event_type", "value")
    filled = S.fill_defaults(wide, S.typed_defaults(wide, skip=["event_id"]))
    return filled.select("c_custkey", "event_id", stamp("ts").alias("ts"), "event_type", "value")


def _copies(spark, sf):
    events = read(spark, sf, "events").select("user_id", "event_type", F.floor("value").alias("amount"), "event_id")
    one = events.withColumn("full_name", F.concat(F.lit("b"), F.col("event_id")))
    two = events.withColumn("full_name", F.concat(F.lit("a"), F.col("event_id") % 7))
    return one.unionByName(two).drop("event_id")


def dedupe_exact(spark, sf):
    return S.dedupe_exact(_copies(spark, sf), ["user_id", "event_type", "amount"], ["full_name"])


def _ranked_copies(spark, sf):
    e = read(spark, sf, "events").select("event_id", "event_type", "ts")
    daily = e.select("event_id", day_id(F.col("ts")).alias("case_id"), F.col("event_type").alias("kind"))
    monthly = e.select(
        "event_id",
        R.month_id(F.col("ts")).alias("case_id"),
        F.when(F.col("event_id") % 3 == 0, F.lit("error")).when(F.col("event_id") % 3 == 1, F.col("event_type")).alias("kind"),
    )
    return daily.unionByName(monthly)


def dedupe_ranked(spark, sf):
    order = [
        F.when(F.col("kind") == "error", 1).otherwise(0),
        F.when(F.col("kind").isNull(), 1).otherwise(0),
        -F.col("case_id"),
    ]
    return S.dedupe_ranked(_ranked_copies(spark, sf), "event_id", order)


def require(spark, sf):
    events = read(spark, sf, "events")
    some = S.require(events, "no readings")
    checked = S.require(some, "value must not be negative", F.col("value") >= 0)
    return checked.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,3)")).cast("double").alias("total")
    )


def quarantine(spark, sf):
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    good, bad = S.quarantine(
        orders,
        {"open order": F.col("o_orderstatus") != "O", "price out of range": F.col("o_totalprice").between(1000, 400000)},
    )
    return good.withColumn("error_message", F.lit("")).unionByName(bad).select("o_orderkey", "error_message")


def latest_per_key(spark, sf):
    out = S.latest_per_key(read(spark, sf, "conversations"), "conv_id", "turn")
    return out.select("conv_id", "turn", "role", F.length("text").alias("n_chars"))


QUERIES = {
    f.__name__: f
    for f in (
        full_reload, replace_day, replace_day_by_date, replace_day_sink, restore_range, fill_defaults, dedupe_exact,
        dedupe_ranked, require, quarantine, latest_per_key,
    )
}

_WEEKLY = """SELECT 'T' || user_id AS tag, CAST(sum(CAST(value AS DECIMAL(18,3)))
  FILTER (ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22') AS DOUBLE) AS accumulation FROM events GROUP BY user_id"""
_STRICT = f"""SELECT event_id, strftime(ts, {DUCK_DAYTIME}) AS ts,
  CASE WHEN ts >= TIMESTAMP '2024-01-15 08:00:00' AND ts < TIMESTAMP '2024-01-16 08:00:00' THEN value + 1 ELSE value END AS value
FROM events"""

ORACLE = {
    "full_reload": _WEEKLY,
    "replace_day": _STRICT,
    "replace_day_sink": _STRICT,
    "replace_day_by_date": f"""SELECT event_id, strftime(ts, {DUCK_DAYTIME}) AS ts, value FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-15'
UNION ALL SELECT event_id, strftime(ts, {DUCK_DAYTIME}), value + 1 FROM events
  WHERE ts >= TIMESTAMP '2024-01-15 08:00:00' AND ts < TIMESTAMP '2024-01-16 08:00:00'""",
    "restore_range": f"""SELECT event_id, strftime(ts, {DUCK_DAYTIME}) AS ts, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-18'""",
    "fill_defaults": f"""SELECT c_custkey, e.event_id, strftime(coalesce(e.ts, TIMESTAMP '1900-01-01'), {DUCK_DAYTIME}) AS ts,
  coalesce(e.event_type, '') AS event_type, coalesce(e.value, 0) AS value
FROM customer LEFT JOIN (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-03'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) e ON e.user_id = c_custkey""",
    "dedupe_exact": """WITH u AS (SELECT user_id, event_type, CAST(floor(value) AS BIGINT) AS amount, 'b' || event_id AS full_name FROM events
UNION ALL SELECT user_id, event_type, CAST(floor(value) AS BIGINT), 'a' || (event_id % 7) FROM events)
SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY user_id, event_type, amount ORDER BY full_name) = 1""",
    "dedupe_ranked": """WITH u AS (SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INT) AS case_id, event_type AS kind FROM events
UNION ALL SELECT event_id, CAST(strftime(ts, '%Y%m') AS INT),
  CASE event_id % 3 WHEN 0 THEN 'error' WHEN 1 THEN event_type END FROM events)
SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY event_id
  ORDER BY kind IS NOT DISTINCT FROM 'error', kind IS NULL, case_id DESC) = 1""",
    "require": """SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,3))) AS DOUBLE) AS total FROM events GROUP BY 1""",
    "quarantine": """SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderstatus = 'O' THEN 'open order' END,
  CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 'price out of range' END) AS error_message FROM orders""",
    "latest_per_key": """SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, CAST(arg_max(length(text), turn) AS INT) AS n_chars
FROM conversations GROUP BY conv_id""",
}
