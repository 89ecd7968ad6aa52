"""The scheduled runs on the driver tables: each ends in a sink and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import rows_table
from ..operators.periods import case_kind
from ..plans import runs
from ..sources.session import run_dir
from . import ledger_queries as LQ
from . import period_queries as PQ
from . import roles as R
from .period_queries import DUCK_DAYTIME, stamp
from .roles import day_id, more_ctes, read

AS_OF = "2024-01-16 09:30:00"  # the period closed last is that of PQ.DAY
REMAINS_AT = "2024-01-15 00:00:00"
LOG_CASE = 20240115
CASE = 19970320


def sampling_run(spark, sf):
    """Run twice: the backup holds the day once."""
    folder = run_dir(spark, "sampling_run")
    args = (
        AS_OF, R.shifts(spark), R.event_transfers(spark, sf), R.entities(spark, sf), R.aliases(spark, sf), R.attributes(spark, sf),
        "MassTotal", R.readings(spark, sf), f"{folder}/current", f"{folder}/backup",
    )
    runs.sampling_run(*args)
    runs.sampling_run(*args)
    out = spark.read.parquet(f"{folder}/backup")
    return out.select("tag", "object_type", "alias_id", "value", stamp("ts").alias("ts"), F.col("run_date").cast("string").alias("run_date"))


def _states(spark, sf):
    return read(spark, sf, "events").select(
        (F.col("user_id") + 1000).alias("sampling_point_id"), "ts", F.col("event_type").alias("short_name"),
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("mass"),
    )


def remains_run(spark, sf):
    """Some settings are no numbers: the good points are loaded, the others logged and the error raised."""
    folder = run_dir(spark, "remains_run")
    number = F.col("settings").try_cast("int")
    settings = R.tag_settings(spark, sf).withColumn(
        "settings", F.when(number % 4 == 0, F.concat("settings", F.lit("x"))).otherwise(F.col("settings"))
    )
    try:
        runs.remains_run(settings, R.tag_objects(spark, sf), _states(spark, sf), REMAINS_AT, f"{folder}/remains", f"{folder}/errors")
        raised = 0
    except runs.RunError:
        raised = 1
    good = spark.read.parquet(f"{folder}/remains").select(
        F.col("sampling_point_id").cast("string").alias("item"), stamp("ts").alias("ts"), "short_name", "mass"
    )
    bad = spark.read.parquet(f"{folder}/errors").select(
        F.col("error_message").alias("item"), F.lit(None).cast("string").alias("ts"), F.lit(None).cast("string").alias("short_name"),
        F.lit(None).cast("double").alias("mass"),
    )
    return good.unionByName(bad).withColumn("raised", F.lit(raised))


def accumulation_run(spark, sf):
    readings = read(spark, sf, "events").select((F.col("user_id") + 1000).cast("string").alias("tag_id"), "ts", "value")
    return runs.accumulation_run(
        LOG_CASE, R.log_cases(spark, sf), R.tag_settings(spark, sf), R.tag_objects(spark, sf), readings, run_dir(spark, "accumulation_run")
    )


def restore_run(spark, sf):
    """The current table holds something else before."""
    folder = run_dir(spark, "restore_run")
    events = read(spark, sf, "events").select("event_id", "ts", "value")
    events.withColumn("run_date", F.col("ts").cast("date")).write.partitionBy("run_date").parquet(f"{folder}/backup")
    events.withColumn("value", F.lit(-1.0)).write.parquet(f"{folder}/current")
    runs.restore_run(spark, f"{folder}/backup", f"{folder}/current", 2024, 1, 15, 4)
    return spark.read.parquet(f"{folder}/current").select("event_id", stamp("ts").alias("ts"), "value")


def reassign_run(spark, sf):
    """Customers move the value of their urgent order of a day to that day's order of low priority."""
    orders = read(spark, sf, "orders")
    tx = LQ._transactions(spark, sf).join(
        orders.select(
            F.concat(F.lit("O"), "o_orderkey").alias("id"), (F.col("o_custkey") % 40).alias("target_cust"), F.col("o_orderpriority").alias("target_priority"),
            F.col("o_totalprice").alias("measured"), (F.col("o_totalprice") / 2).alias("reconciled"),
        ),
        "id",
    )
    view = orders.select(
        day_id(F.col("o_orderdate")).alias("case_id"), F.lit("daily").alias("case_type"), (F.col("o_custkey") % 40).alias("cust"),
        "o_orderpriority", "o_totalprice", "o_orderkey",
    )
    tasks = rows_table(
        spark, "task_id bigint, source_cust bigint, source_priority string, target_cust bigint, target_priority string",
        [[i, i, "1-URGENT", (i * 7) % 40, "5-LOW"] for i in range(40)],
    )
    products = read(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") > 45).cast("int").alias("is_deleted"))
    out = runs.reassign_run(
        CASE, "daily", tasks, view, {"source_cust": "cust", "source_priority": "o_orderpriority"}, "o_totalprice", "o_orderkey",
        tx, {"target_cust": "target_cust", "target_priority": "target_priority"}, R.cases(spark, sf), R.analyses(spark),
        LQ._objects(spark, sf), rows_table(spark, "id int, name string, code_name string", LQ.OBJECT_TYPES), products,
        ["Tank", "Node"], run_dir(spark, "reassign_run"),
    )
    return out.select("case_id", "id", "measured", "reconciled")


def incoming_run(spark, sf):
    facts = LQ._facts(spark, sf).join(
        read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), R.month_id(F.col("o_orderdate")).alias("case_id")), "l_orderkey"
    )
    kinds = case_kind(R.cases(spark, sf), "analysis_id", "MONTH")
    out = runs.incoming_run(
        199703, LQ.RULES, facts, LQ.WILD, "is_input", "reconciled", LQ._ledger(spark, sf), kinds, "%red%", run_dir(spark, "incoming_run"), by_case=True
    )
    return out.select("id", "case_id", "open_mass", "coming_mix", "measured_day", "measured_accum", F.round("end_mass", 3).alias("end_mass"))


QUERIES = {f.__name__: f for f in (sampling_run, remains_run, accumulation_run, restore_run, reassign_run, incoming_run)}

_POINTS = f"""points AS (SELECT DISTINCT CASE WHEN CAST(tag_id AS INT) % 4 = 0 THEN tag_id || 'x' ELSE tag_id END AS item,
  CAST(tag_id AS INT) % 4 = 0 AS bad, CAST(tag_id AS INT) - 1000 AS user_id FROM ({PQ._ACTIVE.format(like="T_%")}))"""
_INCOMING_LEDGER = LQ._INCOMING[LQ._INCOMING.index("ledger AS") : LQ._INCOMING.index("incoming AS")].rstrip().rstrip(",")

ORACLE = {
    "sampling_run": PQ.ORACLE["tag_values_at_boundaries"].replace(
        f"SELECT tag, object_type, alias_id, value, strftime(ts, {DUCK_DAYTIME}) AS ts FROM level",
        f"SELECT tag, object_type, alias_id, value, strftime(ts, {DUCK_DAYTIME}) AS ts, '2024-01-15' AS run_date FROM level",
    ).replace(
        f"SELECT tag, object_type, alias_id, value, strftime(ts, {DUCK_DAYTIME}) FROM amount",
        f"SELECT tag, object_type, alias_id, value, strftime(ts, {DUCK_DAYTIME}), '2024-01-15' FROM amount",
    ),
    "remains_run": more_ctes("tag_settings") + f"""{_POINTS},
last AS (SELECT * FROM events WHERE ts <= TIMESTAMP '{REMAINS_AT}' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT item, strftime(ts, {DUCK_DAYTIME}) AS ts, event_type AS short_name, CASE WHEN event_id % 4 <> 0 THEN value ELSE 0 END AS mass, 1 AS raised
FROM points JOIN last USING (user_id) WHERE NOT bad
UNION ALL SELECT 'id of a sampling point is no number: ' || item, NULL, NULL, NULL, 1 FROM points WHERE bad""",
    "accumulation_run": more_ctes("tag_settings") + f"""ids AS (SELECT DISTINCT tag_id FROM ({PQ._ACTIVE.format(like="M_%")}))
SELECT tag_id, CAST(coalesce(sum(CAST(value AS DECIMAL(18,3))), 0) AS DOUBLE) AS accumulation
FROM ids LEFT JOIN events ON CAST(user_id + 1000 AS VARCHAR) = tag_id AND CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY tag_id""",
    "restore_run": f"""SELECT event_id, strftime(ts, {DUCK_DAYTIME}) AS ts, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-18'""",
    "reassign_run": f"""WITH tasks AS (SELECT i AS task_id, i AS source_cust, (i * 7) % 40 AS target_cust FROM range(40) t(i)),
found AS (SELECT o_custkey % 40 AS cust, arg_min(o_totalprice, o_orderkey) AS new_value FROM orders
  WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INT) = {CASE} AND o_orderpriority = '1-URGENT' GROUP BY 1),
alive AS ({LQ.ORACLE["live_transactions"]}),
hit AS (SELECT a.id, f.new_value, min(a.id) OVER (PARTITION BY t.task_id) AS first_id
  FROM alive a JOIN orders o ON a.id = 'O' || o.o_orderkey JOIN tasks t ON t.target_cust = o.o_custkey % 40
  JOIN found f ON f.cust = t.source_cust WHERE a.case_id = {CASE} AND o.o_orderpriority = '5-LOW')
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS case_id, 'O' || o_orderkey AS id,
  CASE WHEN h.id IS NULL THEN o_totalprice WHEN h.id = first_id THEN h.new_value ELSE 0 END AS measured,
  CASE WHEN h.id IS NULL THEN o_totalprice / 2 ELSE 0 END AS reconciled
FROM orders LEFT JOIN hit h ON h.id = 'O' || o_orderkey""",
    "incoming_run": more_ctes("cases") + f"""rules(s, p, n, o, i, target_id) AS (SELECT * FROM (VALUES {LQ._RULE_VALUES})),
facts AS (SELECT l_suppkey, l_partkey, l_linenumber, l_orderkey, CAST(l_returnflag = 'A' AS INT) AS is_input,
  CASE WHEN l_tax > 0 THEN CAST(l_quantity AS DECIMAL(18,3)) END AS reconciled FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE CAST(strftime(o_orderdate, '%Y%m') AS INT) = 199703),
got AS ({LQ._RULE_SUM}),
{_INCOMING_LEDGER},
applied AS (SELECT l.id, l.case_id, l.name, open_mass, measured_day, measured_accum, CASE WHEN l.case_id = 199703 THEN got.sum_value END AS coming_mix,
  CASE WHEN l.case_id = 199703 AND got.sum_value IS NOT NULL THEN open_mass + got.sum_value - coalesce(measured_accum, 0) ELSE 0 END AS end_mass
  FROM ledger l LEFT JOIN got ON got.target_id = l.id)
SELECT id, case_id, CASE WHEN r THEN 0 ELSE open_mass END AS open_mass, coming_mix, CASE WHEN r THEN coming_mix ELSE measured_day END AS measured_day,
  CASE WHEN r THEN coming_mix ELSE measured_accum END AS measured_accum, CASE WHEN r THEN 0 ELSE round(end_mass, 3) END AS end_mass
FROM (SELECT *, case_id = 199703 AND name LIKE '%red%' AS r FROM applied)""",
}
