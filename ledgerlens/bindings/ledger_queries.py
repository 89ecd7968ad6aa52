"""Ledger corrections on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import rows_table
from ..operators import capture as C
from ..operators import ledger as L
from ..operators.periods import case_kind
from ..sources import merge
from ..sources.session import run_dir
from ..streaming import sync
from . import roles as R
from .roles import day_id, more_ctes, read

OBJECT_TYPES = [
    (1, "AUTOMOBILE", "Pipe"),
    (2, "BUILDING", "Port"),
    (3, "FURNITURE", "Pipe"),
    (4, "HOUSEHOLD", "Tank"),
    (5, "MACHINERY", "Node"),
    (6, "SUPPLIER", "Tank"),
]

# A 0 in a key means any value.
RULES = [
    {"l_suppkey": 3, "l_partkey": 0, "l_linenumber": 2, "l_orderkey": 0, "is_input": 1, "target_id": 11},
    {"l_suppkey": 3, "l_partkey": 0, "l_linenumber": 0, "l_orderkey": 0, "is_input": None, "target_id": 12},
    {"l_suppkey": 0, "l_partkey": 17, "l_linenumber": 0, "l_orderkey": 0, "is_input": 1, "target_id": 13},
    {"l_suppkey": 0, "l_partkey": 18, "l_linenumber": 0, "l_orderkey": 0, "is_input": 0, "target_id": 13},
    {"l_suppkey": 5, "l_partkey": 0, "l_linenumber": 0, "l_orderkey": 0, "is_input": 0, "target_id": 14},
    {"l_suppkey": 6, "l_partkey": 999999999, "l_linenumber": 0, "l_orderkey": 0, "is_input": 0, "target_id": 15},
    {"l_suppkey": 0, "l_partkey": 0, "l_linenumber": 0, "l_orderkey": 0, "is_input": 1, "target_id": 16},
]


def _tasks(spark, sf):
    """Every customer is a task: read its urgent orders, write to its low-priority ones."""
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("task_id"),
        F.col("c_custkey").alias("source_cust"),
        F.lit("1-URGENT").alias("source_priority"),
        F.col("c_custkey").alias("target_cust"),
        F.lit("5-LOW").alias("target_priority"),
    )


def _looked_up(spark, sf):
    # orders in work stand under no key
    view = read(spark, sf, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    )
    return L.lookup_measure(
        _tasks(spark, sf),
        view,
        {"source_cust": "o_custkey", "source_priority": "o_orderpriority"},
        "o_totalprice",
        "o_orderkey",
    )


def lookup_measure(spark, sf):
    return _looked_up(spark, sf).select("task_id", "new_value")


def _transactions(spark, sf):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return read(spark, sf, "orders").select(
        F.concat(F.lit("O"), key).alias("id"),
        day_id(F.col("o_orderdate")).alias("case_id"),
        F.when(key % 2 == 0, F.concat(F.lit("S"), cust % 50)).otherwise(F.concat(F.lit("C"), cust)).alias("source_id"),
        F.concat(F.lit("S"), key % 97).alias("dest_id"),
        (key % 500).alias("product_id"),
        (cust % 400).alias("second_product_id"),
    )


def _objects(spark, sf):
    segment = F.col("c_mktsegment")
    type_id = F.lit(None).cast("int")
    for i, name, _ in OBJECT_TYPES:
        type_id = F.when(segment == name, F.lit(i)).otherwise(type_id)
    orders = read(spark, sf, "orders").select(
        F.concat(F.lit("O"), F.col("o_orderkey")).alias("id"),
        F.when(F.col("o_orderstatus") == "", 0).alias("object_type_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_deleted"),
    )
    customers = read(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("id"),
        type_id.alias("object_type_id"),
        (F.col("c_acctbal") < 0).cast("int").alias("is_deleted"),
    )
    suppliers = read(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("id"),
        F.when(F.col("s_name").isNotNull(), 6).alias("object_type_id"),
        (F.col("s_acctbal") < 0).cast("int").alias("is_deleted"),
    )
    return orders.unionByName(customers).unionByName(suppliers)


def live_transactions(spark, sf):
    types = rows_table(spark, "id int, name string, code_name string", OBJECT_TYPES)
    products = read(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") > 45).cast("int").alias("is_deleted")
    )
    return L.live_transactions(
        _transactions(spark, sf),
        R.cases(spark, sf),
        R.analyses(spark),
        _objects(spark, sf),
        types,
        products,
        "daily",
        ["Tank", "Node"],
    ).select("id", "case_id")


def reassign_measure(spark, sf):
    """Three cases; each order number is used in all of them."""
    orders = read(spark, sf, "orders")
    tx = orders.select(
        (F.col("o_orderkey") % 3).cast("int").alias("case_id"),
        F.floor(F.col("o_orderkey") / 3).alias("id"),
        "o_custkey",
        "o_orderpriority",
        F.col("o_totalprice").alias("measured"),
        (F.col("o_totalprice") / 2).alias("reconciled"),
        "o_orderstatus",
    )
    live = tx.filter(F.col("o_orderstatus") != "F")
    out = L.reassign_measure(
        tx, live, _looked_up(spark, sf), {"target_cust": "o_custkey", "target_priority": "o_orderpriority"}
    )
    return out.select("case_id", "id", "measured", "reconciled")


def _facts(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_suppkey",
        "l_partkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_orderkey",
        (F.col("l_returnflag") == "A").cast("int").alias("is_input"),
        F.when(F.col("l_tax") > 0, F.col("l_quantity")).alias("reconciled"),
    )


WILD = ["l_suppkey", "l_partkey", "l_linenumber", "l_orderkey"]


def wildcard_rule_sum(spark, sf):
    return L.wildcard_rule_sum(RULES, _facts(spark, sf), WILD, "is_input", "reconciled")


def wildcard_rule_table(spark, sf):
    """A rule table of unknown length: one rule per supplier and line number, one per part."""
    by_supplier = read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.lit(0).cast("bigint").alias("l_partkey"),
        (F.col("s_suppkey") % 4).alias("l_linenumber"),
        F.lit(0).cast("bigint").alias("l_orderkey"),
        F.lit(None).cast("int").alias("is_input"),
        (F.col("s_suppkey") % 10).alias("target_id"),
    )
    by_part = read(spark, sf, "part").select(
        F.lit(0).cast("bigint").alias("l_suppkey"),
        F.col("p_partkey").alias("l_partkey"),
        F.lit(0).cast("bigint").alias("l_linenumber"),
        F.lit(0).cast("bigint").alias("l_orderkey"),
        F.lit(1).alias("is_input"),
        (F.col("p_partkey") % 10 + 5).alias("target_id"),
    )
    return L.wildcard_rule_sum(by_supplier.unionByName(by_part), _facts(spark, sf), WILD, "is_input", "reconciled")


def _ledger(spark, sf):
    k = F.col("p_partkey")
    return read(spark, sf, "part").select(
        k.alias("id"),
        F.when(k % 2 == 0, F.lit(199703)).otherwise(F.lit(19970320)).alias("case_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("decimal(18,3)").cast("double").alias("open_mass"),
        F.lit(None).cast("double").alias("coming_mix"),
        F.lit(0.0).alias("end_mass"),
        F.when(k % 3 != 0, F.col("p_size").cast("double")).alias("measured_day"),
        F.when(k % 5 != 0, F.col("p_size") * 2.0).alias("measured_accum"),
    )


def _sums(spark, sf):
    """Per part the received quantity, as rule sums would deliver it."""
    return (
        read(spark, sf, "lineitem")
        .withColumn("received", F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("decimal(18,3)")))
        .groupBy(F.col("l_partkey").alias("target_id"))
        .agg(F.sum("received").cast("double").alias("sum_value"))
    )


def _incoming(spark, sf):
    kinds = case_kind(R.cases(spark, sf), "analysis_id", "MONTH")
    return L.apply_incoming(_ledger(spark, sf), _sums(spark, sf), kinds)


def apply_incoming(spark, sf):
    return _incoming(spark, sf).select("id", "coming_mix", F.round("end_mass", 3).alias("end_mass"))


def override_rows(spark, sf):
    out = L.override_rows(
        _incoming(spark, sf),
        F.col("name").like("%red r%"),
        {
            "open_mass": 0,
            "measured_day": F.col("coming_mix"),
            "measured_accum": F.col("coming_mix"),
            "end_mass": 0,
        },
    )
    return out.select("id", "open_mass", "measured_day", "measured_accum", F.round("end_mass", 3).alias("end_mass"))


def upsert_measures(spark, sf):
    money = "decimal(18,3)"
    target = read(spark, sf, "part").select(
        F.col("p_partkey").alias("product"),
        F.lit(0).cast(money).alias("shipped"),
        F.col("p_size").cast(money).alias("measured"),
        F.lit(3).cast(money).alias("measured_old"),
        F.lit(0).cast(money).alias("produced"),
    )
    source = (
        read(spark, sf, "lineitem")
        .groupBy((F.col("l_partkey") + 25).alias("product_id"))
        .agg(F.sum(F.col("l_quantity").cast(money)).alias("reconciled"))
    )
    got = F.coalesce(F.col("reconciled"), F.lit(0))
    out = L.upsert_measures(
        target,
        source,
        ("product", "product_id"),
        {"shipped": got, "produced": F.col("measured") + got - F.col("measured_old")},
        {"shipped": got, "produced": F.col("reconciled")},
        {"measured": 0, "measured_old": 0},
    )
    return out.select("product", *[F.col(c).cast("double").alias(c) for c in out.columns[1:]])


def merge_measures(spark, sf):
    """The ledger of orders, stored by month: what came back lowers the measure, other orders are booked in the month of shipping."""
    money, path = "decimal(18,3)", f"{run_dir(spark, 'merge_measures')}/orders"
    ledger = read(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").cast(money).alias("measured"), F.lit(0).cast(money).alias("returned"),
        R.month_id(F.col("o_orderdate")).alias("month"),
    )
    merge.store(ledger, path, ["month"])
    price = F.sum(F.col("l_extendedprice").cast(money)).cast(money).alias("price")
    back = read(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(price, R.month_id(F.max("l_shipdate")).alias("shipped"))
    update = {"returned": F.col("price"), "measured": F.col("measured") - F.col("price")}
    merge.merge_into(path, back, ("order_id", "l_orderkey"), update, {"month": F.col("shipped"), "returned": F.col("price")}, {"measured": 0}, ["month"])
    return spark.read.schema(ledger.schema).parquet(path).select("order_id", "month", *[F.col(c).cast("double").alias(c) for c in ("measured", "returned")])


MIN_CASE = 20240105


def _members(spark, sf):
    """Meters of one segment are each a group of their own, under numbers below zero."""
    key = F.col("c_custkey")
    group = F.when(F.col("c_mktsegment") != "FURNITURE", F.floor(key / 3)).otherwise(-1 - key)
    return read(spark, sf, "customer").select(key.alias("id"), group.cast("bigint").alias("group_id"))


def _meters(spark, sf):
    return (
        read(spark, sf, "events")
        .groupBy(F.col("user_id").alias("id"), day_id(F.col("ts")).alias("case_id"))
        .agg(F.min(F.when(F.col("event_type") != "error", F.col("value"))).alias("measured"))
    )


def _as_changes(events):
    """Every event is a change; those that are no purchase write to meters that do not exist."""
    bought = F.col("event_type") == "purchase"
    return events.select(
        F.when(bought, F.col("user_id")).otherwise(-1 - F.col("user_id")).alias("id"),
        day_id(F.col("ts")).alias("case_id"),
        F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("measured"),
        F.col("event_id").alias("seq"),
    )


def _changes(spark, sf):
    return _as_changes(read(spark, sf, "events"))


def sync_group(spark, sf):
    return L.sync_group(_meters(spark, sf), _changes(spark, sf), _members(spark, sf), MIN_CASE)


def sync_group_stream(spark, sf):
    folder = run_dir(spark, "sync_group")
    schema = read(spark, sf, "events").schema
    # a glob covers a single file and a folder of files alike
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(f"{sf}/events.parquet*")
    query = sync.sync_group_stream(
        _as_changes(stream), _members(spark, sf), MIN_CASE, f"{folder}/latest", f"{folder}/progress"
    )
    query.awaitTermination()
    return sync.synced_meters(_meters(spark, sf), _members(spark, sf), f"{folder}/latest")


def change_log(spark, sf):
    return L.change_log(_changes(spark, sf), _members(spark, sf), MIN_CASE)


def _earlier(spark, sf):
    """The meters as they were while only purchases and clicks had been booked."""
    return (
        read(spark, sf, "events").filter("event_type in ('purchase', 'click')")
        .groupBy(F.col("user_id").alias("id"), day_id(F.col("ts")).alias("case_id"))
        .agg(F.min("value").alias("measured"))
    )


def captured_changes(spark, sf):
    out = C.captured(_earlier(spark, sf), _meters(spark, sf), ["id", "case_id"])
    text = C.described(out, ["measured"]) != ""
    return out.select("operation", "id", "case_id", F.col("deleted.measured").alias("old"), F.col("inserted.measured").alias("new"), text.alias("measured_changed"))


def sync_group_states(spark, sf):
    """Groups kept in step by what was captured between two states of the meters."""
    meters = _meters(spark, sf)
    changes = C.writes(C.captured(_earlier(spark, sf), meters, ["id", "case_id"]), "measured")
    return L.sync_group(meters, changes, _members(spark, sf), MIN_CASE)


def change_log_states(spark, sf):
    changes = C.writes(C.captured(_earlier(spark, sf), _meters(spark, sf), ["id", "case_id"]), "measured")
    # an id has a change in each of its cases
    seq = F.col("case_id").cast("long") * 1_000_000 + F.col("id")
    return L.change_log(changes.withColumn("seq", seq), _members(spark, sf), MIN_CASE)


QUERIES = {
    f.__name__: f
    for f in (
        lookup_measure, live_transactions, reassign_measure, wildcard_rule_sum, wildcard_rule_table, apply_incoming,
        override_rows, upsert_measures, merge_measures, sync_group, sync_group_stream, change_log,
        captured_changes, sync_group_states, change_log_states,
    )
}

_LOOKUP = """looked AS (SELECT c_custkey AS task_id, v.new_value FROM customer LEFT JOIN
  (SELECT o_custkey, o_totalprice AS new_value FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT'
   QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) v ON v.o_custkey = c_custkey)"""
_RULE_VALUES = ", ".join(
    "(" + ", ".join("NULL" if r[k] is None else str(r[k]) for k in (*WILD, "is_input", "target_id")) + ")" for r in RULES
)
_FACTS = """facts AS (SELECT l_suppkey, l_partkey, l_linenumber, l_orderkey, CAST(l_returnflag = 'A' AS INT) AS is_input,
  CASE WHEN l_tax > 0 THEN CAST(l_quantity AS DECIMAL(18,3)) END AS reconciled FROM lineitem)"""
_RULE_SUM = """SELECT r.target_id, CAST(sum(coalesce(f.reconciled, 0)) AS DOUBLE) AS sum_value
FROM rules r JOIN facts f ON (r.s = f.l_suppkey OR r.s = 0) AND (r.p = f.l_partkey OR r.p = 0)
  AND (r.n = f.l_linenumber OR r.n = 0) AND (r.o = f.l_orderkey OR r.o = 0) AND f.is_input = coalesce(r.i, 0)
GROUP BY r.target_id"""
_INCOMING = """got AS (SELECT l_partkey AS id, CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) AS DOUBLE) AS s FROM lineitem
  WHERE l_returnflag = 'R' GROUP BY 1),
kinds AS (SELECT case_id FROM cases),
ledger AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 199703 ELSE 19970320 END AS case_id, p_name AS name,
  CAST(CAST(p_retailprice AS DECIMAL(18,3)) AS DOUBLE) AS open_mass,
  CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS DOUBLE) END AS measured_day,
  CASE WHEN p_partkey % 5 <> 0 THEN p_size * 2.0 END AS measured_accum FROM part),
incoming AS (SELECT l.*, got.s AS coming_mix, CASE WHEN got.s IS NULL THEN 0 WHEN l.id % 2 = 0
  THEN open_mass + got.s - coalesce(measured_accum, 0) ELSE open_mass + got.s - coalesce(measured_day, 0) END AS end_mass
  FROM ledger l JOIN kinds USING (case_id) LEFT JOIN got ON got.id = l.id
  UNION ALL SELECT l.*, NULL, 0 FROM ledger l WHERE l.case_id NOT IN (SELECT case_id FROM kinds))"""
_SYNC = f"""members AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey // 3 ELSE -1 - c_custkey END AS group_id
  FROM customer),
changes AS (SELECT CASE WHEN event_type = 'purchase' THEN user_id ELSE -1 - user_id END AS id, CAST(strftime(ts, '%Y%m%d') AS INT) AS case_id,
  CASE WHEN event_id % 9 <> 0 THEN value END AS measured, event_id AS seq FROM events),
meters AS (SELECT user_id AS id, CAST(strftime(ts, '%Y%m%d') AS INT) AS case_id, min(value) FILTER (event_type <> 'error') AS measured
  FROM events GROUP BY ALL),
latest AS (SELECT c.case_id, m.group_id, c.measured AS new_value FROM changes c JOIN members m USING (id) WHERE c.case_id >= {MIN_CASE}
  QUALIFY row_number() OVER (PARTITION BY c.case_id, m.group_id ORDER BY c.seq DESC) = 1)"""
_SYNCED = f"""WITH {_SYNC}
SELECT t.id, t.case_id, coalesce(l.new_value, t.measured) AS measured,
  CAST(l.new_value IS NOT NULL AND t.measured IS DISTINCT FROM l.new_value AS INT) AS synced
FROM meters t LEFT JOIN members m USING (id) LEFT JOIN latest l ON l.case_id = t.case_id AND l.group_id = m.group_id"""

_CAPTURED = """earlier AS (SELECT user_id AS id, CAST(strftime(ts, '%Y%m%d') AS INT) AS case_id, min(value) AS measured FROM events
  WHERE event_type IN ('purchase', 'click') GROUP BY ALL),
captured AS (SELECT coalesce(a.id, b.id) AS id, coalesce(a.case_id, b.case_id) AS case_id, b.measured AS old, a.measured AS new,
    CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END AS operation
  FROM meters a FULL JOIN earlier b ON a.id = b.id AND a.case_id = b.case_id
  WHERE a.id IS NULL OR b.id IS NULL OR a.measured IS DISTINCT FROM b.measured),
written AS (SELECT id, case_id, new AS measured FROM captured WHERE operation <> 'delete')"""

ORACLE = {
    "captured_changes": f"WITH {_SYNC}, {_CAPTURED} SELECT operation, id, case_id, old, new, operation = 'update' AS measured_changed FROM captured",
    "sync_group_states": f"""WITH {_SYNC}, {_CAPTURED},
last AS (SELECT w.case_id, m.group_id, w.measured AS new_value FROM written w JOIN members m USING (id) WHERE w.case_id >= {MIN_CASE}
  QUALIFY row_number() OVER (PARTITION BY w.case_id, m.group_id ORDER BY w.id DESC) = 1)
SELECT t.id, t.case_id, coalesce(l.new_value, t.measured) AS measured,
  CAST(l.new_value IS NOT NULL AND t.measured IS DISTINCT FROM l.new_value AS INT) AS synced
FROM meters t LEFT JOIN members m USING (id) LEFT JOIN last l ON l.case_id = t.case_id AND l.group_id = m.group_id""",
    "change_log_states": f"""WITH {_SYNC}, {_CAPTURED},
logged AS (SELECT w.case_id::BIGINT * 1000000 + w.id AS seq, w.case_id, w.measured, m.group_id IS NOT NULL AS member FROM written w LEFT JOIN members m USING (id))
SELECT seq, 0 AS step, 'started' AS info FROM logged
UNION ALL SELECT seq, 1, 'skipped: case ' || case_id || ' < {MIN_CASE}' FROM logged WHERE member AND case_id < {MIN_CASE}
UNION ALL SELECT seq, 2, 'applied: value ' || measured || ', case ' || case_id FROM logged
  WHERE member AND case_id >= {MIN_CASE} AND measured IS NOT NULL
UNION ALL SELECT seq, 3, 'finished' FROM logged WHERE NOT member OR case_id >= {MIN_CASE}""",
    "lookup_measure": f"WITH {_LOOKUP} SELECT * FROM looked",
    "live_transactions": """WITH tx AS (SELECT 'O' || o_orderkey AS id, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS case_id, o_orderstatus,
  CASE WHEN o_orderkey % 2 = 0 THEN 'S' || (o_custkey % 50) ELSE 'C' || o_custkey END AS source_id,
  'S' || (o_orderkey % 97) AS dest_id, o_orderkey % 500 AS p1, o_custkey % 400 AS p2 FROM orders),
src AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')
  UNION ALL SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal >= 0),
goods AS (SELECT p_partkey AS id FROM part WHERE p_size <= 45)
SELECT tx.id, tx.case_id FROM tx JOIN src ON src.id = tx.source_id JOIN goods a ON a.id = tx.p1 JOIN goods b ON b.id = tx.p2
JOIN (SELECT 'S' || s_suppkey AS id FROM supplier WHERE s_acctbal >= 0) d ON d.id = tx.dest_id WHERE tx.o_orderstatus <> 'F'""",
    "reassign_measure": f"""WITH {_LOOKUP},
tx AS (SELECT CAST(o_orderkey % 3 AS INT) AS case_id, o_orderkey // 3 AS id, * FROM orders),
hit AS (SELECT o.case_id, o.id, l.new_value, min(o.id) OVER (PARTITION BY l.task_id, o.case_id) AS first_id
  FROM tx o JOIN looked l ON l.task_id = o.o_custkey
  WHERE o.o_orderpriority = '5-LOW' AND o.o_orderstatus <> 'F' AND l.new_value IS NOT NULL)
SELECT o.case_id, o.id, CASE WHEN h.id IS NULL THEN o.o_totalprice WHEN h.id = h.first_id THEN h.new_value ELSE 0 END AS measured,
  CASE WHEN h.id IS NULL THEN o.o_totalprice / 2 ELSE 0 END AS reconciled
FROM tx o LEFT JOIN hit h ON h.id = o.id AND h.case_id = o.case_id""",
    "wildcard_rule_sum": f"WITH rules(s, p, n, o, i, target_id) AS (SELECT * FROM (VALUES {_RULE_VALUES})), {_FACTS} {_RULE_SUM}",
    "wildcard_rule_table": f"""WITH rules AS (SELECT s_suppkey AS s, 0 AS p, s_suppkey % 4 AS n, 0 AS o, NULL AS i, s_suppkey % 10 AS target_id FROM supplier
  UNION ALL SELECT 0, p_partkey, 0, 0, 1, p_partkey % 10 + 5 FROM part), {_FACTS} {_RULE_SUM}""",
    "apply_incoming": more_ctes("cases") + _INCOMING + " SELECT id, coming_mix, round(end_mass, 3) AS end_mass FROM incoming",
    "override_rows": more_ctes("cases") + _INCOMING + """ SELECT id, CASE WHEN name LIKE '%red r%' THEN 0 ELSE open_mass END AS open_mass,
  CASE WHEN name LIKE '%red r%' THEN coming_mix ELSE measured_day END AS measured_day,
  CASE WHEN name LIKE '%red r%' THEN coming_mix ELSE measured_accum END AS measured_accum,
  CASE WHEN name LIKE '%red r%' THEN 0 ELSE round(end_mass, 3) END AS end_mass FROM incoming""",
    "upsert_measures": """WITH s AS (SELECT l_partkey + 25 AS k, sum(CAST(l_quantity AS DECIMAL(18,3))) AS r FROM lineitem GROUP BY 1)
SELECT coalesce(p_partkey, s.k) AS product, CAST(coalesce(s.r, 0) AS DOUBLE) AS shipped, CAST(coalesce(p_size, 0) AS DOUBLE) AS measured,
  CASE WHEN p_partkey IS NULL THEN 0.0::DOUBLE ELSE 3.0::DOUBLE END AS measured_old,
  CAST(CASE WHEN p_partkey IS NULL THEN s.r WHEN s.k IS NULL THEN 0 ELSE p_size + s.r - 3 END AS DOUBLE) AS produced
FROM part FULL JOIN s ON s.k = p_partkey""",
    "merge_measures": """WITH back AS (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,3))) AS price,
  CAST(strftime(max(l_shipdate), '%Y%m') AS INT) AS shipped FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,3)) AS measured, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS month
  FROM orders WHERE o_orderstatus <> 'P')
SELECT coalesce(o_orderkey, k) AS order_id, CASE WHEN o_orderkey IS NULL THEN shipped ELSE month END AS month,
  CAST(CASE WHEN o_orderkey IS NULL THEN 0 ELSE measured - coalesce(price, 0) END AS DOUBLE) AS measured, CAST(coalesce(price, 0) AS DOUBLE) AS returned
FROM o FULL JOIN back ON k = o_orderkey""",
    "sync_group": _SYNCED,
    "sync_group_stream": _SYNCED,
    "change_log": f"""WITH {_SYNC},
logged AS (SELECT c.*, m.group_id IS NOT NULL AS member FROM changes c LEFT JOIN members m USING (id))
SELECT seq, 0 AS step, 'started' AS info FROM logged
UNION ALL SELECT seq, 1, 'skipped: case ' || case_id || ' < {MIN_CASE}' FROM logged WHERE member AND case_id < {MIN_CASE}
UNION ALL SELECT seq, 2, 'applied: value ' || measured || ', case ' || case_id FROM logged
  WHERE member AND case_id >= {MIN_CASE} AND measured IS NOT NULL
UNION ALL SELECT seq, 3, 'finished' FROM logged WHERE NOT member OR case_id >= {MIN_CASE}""",
}
