"""User-action log on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import rows_table
from ..operators import audit as A
from ..operators.periods import case_kind, select_cases
from ..operators.rule_tables import classify_by_rules
from ..plans import audit_reports as reports
from ..sources.session import staged
from . import roles as R
from .period_queries import DUCK_DAYTIME, stamp
from .roles import day_id, month_id, read

EXCLUDED_TYPE = 1024
OBJECT_TYPES = [(1, "AUTOMOBILE"), (2, "BUILDING"), (1024, "FURNITURE"), (4, "HOUSEHOLD"), (5, "MACHINERY")]
PERIOD = ("2024-01-01", "2024-02-01")
UNIT = "DAY"

LABELS = A.Labels(
    masked_users={"NATION_1": "somebody", "NATION_2": "somebody"},
    type_aliases={"BUILDING": "Stores"},
    name_rules=(
        {"label": "Plant", "any": ("%MACHIN%",)},
        {"label": "Additives", "any": ("%BUILD%", "%4"), "all_but": (("%Dependency%", "%Dependency%000_2%"),)},
        {"label": "System", "any": ("%Dependency%",)},
    ),
)


def _log(spark, sf):
    k = F.col("event_id")
    kind = F.col("event_type")
    return read(spark, sf, "events").select(
        k.alias("log_id"),
        F.explode(F.array(day_id(F.col("ts")), month_id(F.col("ts")))).alias("case_id"),
        F.col("ts").alias("dt"),
        F.col("user_id").alias("object_id"),
        (k % 27).alias("user_id"),
        F.when(kind == "signup", 0).when(kind == "error", 1).when(kind == "click", 2).when(kind == "purchase", 4)
        .otherwise(7).alias("history_type"),
        F.when((kind == "purchase") & (k % 2 == 0), F.lit("Dependency state"))
        .when(k % 5 != 1, F.concat(F.lit("attr"), k % 6)).alias("attribute"),
        F.when(k % 6 == 0, "SourceId").when(k % 6 == 1, "ProductId").when(k % 6 == 2, "DestId").otherwise("Name")
        .alias("attribute_sf"),
        F.when(k % 4 == 0, (k % 150).cast("string")).when(k % 4 == 1, "1.5").when(k % 4 == 3, F.concat(F.lit("text"), k % 9))
        .alias("prev"),
        F.when(k % 3 == 0, (k % 100).cast("string")).when(k % 3 == 1, F.concat(F.lit("v"), k % 10)).alias("new"),
        (k % 17 == 0).cast("int").alias("is_cancel"),
    )


def _lookups(spark, sf):
    """Names of objects and of products by case; what the log refers to comes out of one reading of it."""
    refers = F.array(F.struct(F.lit("object").alias("kind"), F.col("object_id").alias("id")), F.struct(F.lit("product").alias("kind"), (F.col("log_id") % 100).alias("id")))
    pairs = staged(_log(spark, sf).select("case_id", F.explode(refers).alias("r")).select("case_id", "r.kind", "r.id").distinct(), "referred")
    customers, parts = read(spark, sf, "customer"), read(spark, sf, "part")
    name = F.when(
        F.col("c_custkey") % 4 == 0, F.concat(F.lit("Dependency "), F.col("c_name"))
    ).otherwise(F.concat("c_mktsegment", F.lit(" -> "), "c_name", F.lit(" in "), F.col("case_id")))
    names = pairs.filter("kind = 'object'").join(customers, F.col("id") == F.col("c_custkey")).select(
        "case_id", F.col("id").alias("object_id"), F.when(F.col("c_acctbal") > -800, name).alias("name")
    )
    called = F.when(F.col("p_size") < 40, F.concat("p_brand", F.lit("/"), F.col("case_id")))
    products = pairs.filter("kind = 'product'").join(parts, F.col("id") == F.col("p_partkey")).select("case_id", "id", called.alias("name"))
    return names, products


def _cases(spark, sf):
    chosen = select_cases(R.log_cases(spark, sf), R.analyses(spark), *PERIOD)
    return case_kind(chosen, "analysis_id", "MONTH")


def _sources(spark, sf):
    objects = read(spark, sf, "customer")
    names, products = _lookups(spark, sf)
    types = rows_table(spark, "id int, name string", OBJECT_TYPES)
    keyed = objects.join(types, F.col("c_mktsegment") == F.col("name"))
    return reports.AuditSources(
        cases=_cases(spark, sf),
        log=_log(spark, sf),
        users=read(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        objects=keyed.select(
            F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 19 != 3, F.col("id")).alias("object_type_id")
        ),
        object_types=types,
        names=names,
        products=products,
        excluded_type=EXCLUDED_TYPE,
    )


def case_log(spark, sf):
    """The log unioned with itself: exact duplicates go."""
    log = _log(spark, sf)
    out = A.case_log(_cases(spark, sf), log.unionByName(log))
    return out.select("log_id", "case_id", "is_cumulative", stamp("end_time").alias("end_time"), "attribute", "new")


def decode_labels(spark, sf):
    out = A.decode_labels(
        _log(spark, sf),
        {
            "change": ("history_type", A.change_labels(LABELS), None),
            "cancelled": ("is_cancel", {1: "yes"}, F.lit("no")),
            "who": ("user_id", {1: "somebody", 2: "somebody"}, F.concat(F.lit("user "), F.col("user_id"))),
        },
    )
    return out.select("log_id", "case_id", "change", "cancelled", "who")


def resolve_references(spark, sf):
    out = A.resolve_references(_log(spark, sf), *_lookups(spark, sf), LABELS.object_attributes, LABELS.product_attributes)
    return out.select("log_id", "case_id", "object_name", "prev_text", "new_text")


def _formatted(spark, sf):
    """Stored once: the folds read it several times."""
    return staged(reports.formatted_log(_sources(spark, sf), LABELS), "formatted")


def _folded(df):
    return df.select(
        "log_id", "part", "is_cumulative", stamp("dt").alias("dt"), "user_name", "object_type", "object_name", "change",
        "attribute", "prev", "new", "is_cancel",
    )


def fold_creations(spark, sf):
    return _folded(A.fold_creations(_formatted(spark, sf), LABELS, UNIT))


def fold_creations_parts(spark, sf):
    """The same lists in parts of one entry each."""
    return _folded(A.fold_creations(_formatted(spark, sf), LABELS, UNIT, per_part=1))


def fold_dependencies(spark, sf):
    return _folded(A.fold_dependencies(_formatted(spark, sf), LABELS, UNIT))


def plain_changes(spark, sf):
    return _folded(A.plain_changes(_formatted(spark, sf), LABELS))


def classify_by_name(spark, sf):
    named = read(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit(" -> "), "p_brand").alias("name"), "p_type"
    )
    out = A.classify_by_name(
        named,
        "name",
        " -> ",
        (
            {"label": "rings", "any": ("%ring",)},
            {"label": "colours", "any": ("red%", "blue%"), "all_but": (("%gear%", "%old gear%"),)},
            {"label": "rods", "any": ("%rod%",)},
        ),
        F.col("p_type"),
        "class",
    )
    return out.select("p_partkey", "class")


def classify_by_rule_table(spark, sf):
    """Customers by rules that come from the suppliers: the end of a name, barred beginnings, a segment."""
    key, name = F.col("s_suppkey"), F.col("s_name")
    rules = read(spark, sf, "supplier").select(
        (F.col("s_nationkey") * 100_000 + key).alias("rank"),
        F.concat(F.lit("%"), F.right(name, F.lit(3))).alias("pattern"),
        F.concat(F.lit("%00"), F.substring(name, -4, 1), F.lit("%"), F.right(name, F.lit(1))).alias("unless"),
        F.when(key % 3 == 0, F.lit("M%")).alias("segment_like"),
        F.when(key % 4 == 0, F.lit("%L%")).alias("segment_unlike"),
        F.concat(F.lit("as "), name).alias("label"),
    )
    named = read(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    out = classify_by_rules(named, "name", rules, F.col("segment"), "class", also=["segment"], unless="unless")
    return out.select("c_custkey", "class")


def audit_report(spark, sf):
    return reports.audit_report(_sources(spark, sf), LABELS)


def audit_report_folded(spark, sf):
    comments = read(spark, sf, "conversations").select(
        F.col("turn").alias("id"), F.col("conv_id").alias("log_id"), F.concat("role", F.col("turn")).alias("text")
    )
    signs = read(spark, sf, "labels").select(
        F.col("quality").alias("id"), F.col("doc_id").alias("log_id"), F.concat(F.lit("q"), F.col("quality")).alias("text")
    )
    return reports.audit_report_folded(_sources(spark, sf), LABELS, comments, signs, UNIT)


QUERIES = {
    f.__name__: f
    for f in (
        case_log, decode_labels, resolve_references, fold_creations, fold_creations_parts, fold_dependencies, plain_changes, classify_by_name, classify_by_rule_table,
        audit_report, audit_report_folded,
    )
}

_LOG = """log AS (SELECT event_id AS log_id, unnest([CAST(strftime(ts, '%Y%m%d') AS INT), CAST(strftime(ts, '%Y%m') AS INT)]) AS case_id,
  ts AS dt, user_id AS object_id, event_id % 27 AS user_id,
  CASE event_type WHEN 'signup' THEN 0 WHEN 'error' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 4 ELSE 7 END AS history_type,
  CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'Dependency state' WHEN event_id % 5 <> 1 THEN 'attr' || (event_id % 6) END AS attribute,
  CASE event_id % 6 WHEN 0 THEN 'SourceId' WHEN 1 THEN 'ProductId' WHEN 2 THEN 'DestId' ELSE 'Name' END AS attribute_sf,
  CASE event_id % 4 WHEN 0 THEN CAST(event_id % 150 AS VARCHAR) WHEN 1 THEN '1.5' WHEN 3 THEN 'text' || (event_id % 9) END AS prev,
  CASE event_id % 3 WHEN 0 THEN CAST(event_id % 100 AS VARCHAR) WHEN 1 THEN 'v' || (event_id % 10) END AS new,
  CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS is_cancel FROM events)"""
_NAMES = """names AS (SELECT DISTINCT case_id, object_id, CASE WHEN c_custkey % 4 = 0 THEN 'Dependency ' || c_name
  ELSE c_mktsegment || ' -> ' || c_name || ' in ' || case_id END AS name
  FROM log JOIN customer ON c_custkey = object_id WHERE c_acctbal > -800),
products AS (SELECT DISTINCT case_id, log_id % 100 AS id, p_brand || '/' || case_id AS name FROM log JOIN part ON p_partkey = log_id % 100
  WHERE p_size < 40)"""


def _text(column: str) -> str:
    number = f"TRY_CAST(CASE WHEN {column} NOT LIKE '%.%' THEN {column} END AS INT)"
    return f"""CASE WHEN {number} IS NULL THEN {column}
  WHEN attribute_sf IN ('PrototypeId', 'SourceId', 'DestId') THEN (SELECT n.name FROM names n WHERE n.case_id = l.case_id AND n.object_id = {number})
  WHEN attribute_sf IN ('ProductId', 'SecondProductId') THEN (SELECT p.name FROM products p WHERE p.case_id = l.case_id AND p.id = {number})
  ELSE {column} END AS {column}_text"""


_RESOLVED = f"""resolved AS (SELECT l.*, n0.name AS object_name, {_text('prev')}, {_text('new')}
  FROM log l LEFT JOIN names n0 ON n0.case_id = l.case_id AND n0.object_id = l.object_id)"""
_TYPED = """typed AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 19 <> 3 THEN CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1
  WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 1024 WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END END AS type_id,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Stores' ELSE c_mktsegment END AS object_type FROM customer)"""
_PERIODS = """periods AS (SELECT DISTINCT case_id, CASE WHEN case_id > 1000000 THEN 0 ELSE 1 END AS is_cumulative,
  CAST(CASE WHEN case_id > 1000000 THEN date_trunc('day', dt) ELSE date_trunc('month', dt) END AS TIMESTAMP) AS start_time FROM log)"""
_DESCRIBED = """described AS (SELECT r.*, date_trunc('day', r.dt) AS day, p.is_cumulative, p.start_time,
  CASE WHEN p.is_cumulative = 1 THEN p.start_time + INTERVAL 1 MONTH ELSE p.start_time + INTERVAL 1 DAY END AS end_time, t.object_type,
  CASE WHEN n_name IN ('NATION_1', 'NATION_2') THEN 'somebody' ELSE n_name END AS user_name
  FROM {log} r JOIN periods p USING (case_id) JOIN typed t ON t.id = r.object_id AND t.type_id <> 1024
  LEFT JOIN nation ON n_nationkey = r.user_id)"""
_BEST = """best AS (SELECT r.* FROM resolved r LEFT JOIN typed t ON t.id = r.object_id
  QUALIFY row_number() OVER (PARTITION BY r.log_id ORDER BY t.type_id IS NOT DISTINCT FROM 1024, t.type_id IS NULL, r.case_id DESC) = 1)"""
_PRE = f"WITH {_LOG}, {_NAMES}, {_RESOLVED}, {_TYPED}, {_PERIODS}"
_FORMATTED = f"{_PRE}, {_BEST}, {_DESCRIBED.format(log='best')}"
_CREATIONS = """creations AS (SELECT min(log_id) AS log_id, start_time, end_time, is_cumulative, day AS dt, user_name, object_type,
  object_name, 'created' AS change, (SELECT string_agg(t.attribute || '=' || coalesce(t.new_text, 'NULL'), ', ' ORDER BY t.attribute, t.log_id)
    FROM described t WHERE t.history_type = 0 AND t.day = d.day AND t.object_id = d.object_id
    AND t.user_id = d.user_id) AS attribute, CAST(NULL AS VARCHAR) AS prev, CAST(NULL AS VARCHAR) AS new, is_cancel
  FROM described d WHERE history_type = 0
  GROUP BY start_time, end_time, is_cumulative, day, user_name, object_type, object_name, is_cancel, object_id, user_id)"""
_DEPENDENCIES = """dependencies AS (SELECT min(log_id) AS log_id, start_time, end_time, is_cumulative, day AS dt, user_name, object_type,
  'Dependencies: ' || (SELECT string_agg(replace(t.object_name, 'Dependency ', ''), ', ' ORDER BY t.log_id) FROM described t
    WHERE t.history_type = 4 AND t.attribute = 'Dependency state' AND t.day = d.day
    AND t.user_id = d.user_id) AS object_name, 'system' AS change, 'Dependency state' AS attribute, max(prev) AS prev, max(new) AS new, is_cancel
  FROM described d WHERE history_type = 4 AND attribute = 'Dependency state'
  GROUP BY start_time, end_time, is_cumulative, day, user_name, object_type, is_cancel, user_id)"""
_PLAIN = """plain AS (SELECT log_id, start_time, end_time, is_cumulative, dt, user_name, object_type, object_name,
  CASE history_type WHEN 1 THEN 'deleted' WHEN 2 THEN 'edited' ELSE 'info' END AS change, attribute, prev_text AS prev, new_text AS new, is_cancel
  FROM described WHERE history_type <> 0 AND NOT (attribute = 'Dependency state' AND history_type = 4))"""


def _fold_columns(table: str) -> str:
    return f"""SELECT log_id, 0 AS part, is_cumulative, strftime(dt, {DUCK_DAYTIME}) AS dt, user_name, object_type, object_name, change,
  attribute, prev, new, is_cancel FROM {table}"""


_PERIOD_TEXT = """strftime(start_time, '%d.%m.%Y') AS period_start, strftime(end_time, '%d.%m.%Y') AS period_end,
  CASE is_cumulative WHEN 1 THEN 'cumulative' ELSE 'daily' END AS period_kind, strftime(dt, '%d.%m.%Y %H:%M:%S') AS action_time, user_name"""
_CANCELLED = "CASE is_cancel WHEN 1 THEN 'yes' ELSE 'no' END AS cancelled"

ORACLE = {
    "case_log": f"""WITH {_LOG}, {_PERIODS} SELECT log_id, case_id, is_cumulative, strftime(CASE WHEN is_cumulative = 1 THEN start_time + INTERVAL 1 MONTH
  ELSE start_time + INTERVAL 1 DAY END, {DUCK_DAYTIME}) AS end_time, attribute, new FROM log JOIN periods USING (case_id)""",
    "decode_labels": f"""WITH {_LOG} SELECT log_id, case_id, CASE history_type WHEN 0 THEN 'created' WHEN 1 THEN 'deleted' WHEN 2 THEN 'edited'
  WHEN 4 THEN 'system' ELSE CAST(history_type AS VARCHAR) END AS change, {_CANCELLED},
  CASE WHEN user_id IN (1, 2) THEN 'somebody' ELSE 'user ' || user_id END AS who FROM log""",
    "resolve_references": f"WITH {_LOG}, {_NAMES}, {_RESOLVED} SELECT log_id, case_id, object_name, prev_text, new_text FROM resolved",
    "fold_creations": f"{_FORMATTED}, {_CREATIONS} {_fold_columns('creations')}",
    "fold_creations_parts": f"""{_FORMATTED}, entries AS (SELECT day, object_id, user_id, t.attribute || '=' || coalesce(t.new_text, 'NULL') AS entry,
    row_number() OVER (PARTITION BY day, object_id, user_id ORDER BY t.attribute, t.log_id) - 1 AS position
  FROM described t WHERE t.history_type = 0 AND t.attribute IS NOT NULL),
lists AS (SELECT day, object_id, user_id, CAST(position AS INT) AS part, string_agg(entry, ', ' ORDER BY position) AS items
  FROM entries GROUP BY 1, 2, 3, 4),
groups AS (SELECT min(log_id) AS log_id, start_time, end_time, is_cumulative, day, user_name, object_type, object_name, is_cancel, object_id, user_id
  FROM described WHERE history_type = 0
  GROUP BY start_time, end_time, is_cumulative, day, user_name, object_type, object_name, is_cancel, object_id, user_id)
SELECT log_id, coalesce(part, 0) AS part, is_cumulative, strftime(g.day, {DUCK_DAYTIME}) AS dt, user_name, object_type, object_name, 'created' AS change,
  items AS attribute, CAST(NULL AS VARCHAR) AS prev, CAST(NULL AS VARCHAR) AS new, is_cancel
FROM groups g LEFT JOIN lists l ON l.day = g.day AND l.object_id = g.object_id AND l.user_id = g.user_id""",
    "fold_dependencies": f"{_FORMATTED}, {_DEPENDENCIES} {_fold_columns('dependencies')}",
    "plain_changes": f"{_FORMATTED}, {_PLAIN} {_fold_columns('plain')}",
    "classify_by_rule_table": """WITH rules AS (SELECT s_nationkey * 100000 + s_suppkey AS rank, '%' || right(s_name, 3) AS p,
  '%00' || substr(s_name, -4, 1) || '%' || right(s_name, 1) AS u, CASE WHEN s_suppkey % 3 = 0 THEN 'M%' END AS sl,
  CASE WHEN s_suppkey % 4 = 0 THEN '%L%' END AS su, 'as ' || s_name AS label FROM supplier)
SELECT c_custkey, coalesce(arg_min(label, rank), c_mktsegment) AS class FROM customer LEFT JOIN rules
  ON c_name LIKE p AND NOT c_name LIKE u AND (sl IS NULL OR c_mktsegment LIKE sl) AND (su IS NULL OR NOT c_mktsegment LIKE su)
GROUP BY c_custkey, c_mktsegment""",
    "classify_by_name": """SELECT p_partkey, CASE WHEN p_name LIKE '%ring' THEN 'rings'
  WHEN p_name LIKE 'red%' OR p_name LIKE 'blue%' OR (p_name LIKE '%gear%' AND p_name NOT LIKE '%old gear%') THEN 'colours'
  WHEN p_name LIKE '%rod%' THEN 'rods' ELSE p_type END AS class FROM part""",
    "audit_report": f"""{_PRE}, {_DESCRIBED.format(log='resolved')} SELECT log_id, {_PERIOD_TEXT}, object_type, object_name,
  CASE history_type WHEN 0 THEN 'created' WHEN 1 THEN 'deleted' WHEN 2 THEN 'edited' WHEN 4 THEN 'system' ELSE CAST(history_type AS VARCHAR) END AS change,
  attribute, prev_text AS prev, new_text AS new, {_CANCELLED} FROM described""",
    "audit_report_folded": f"""{_FORMATTED}, {_CREATIONS}, {_DEPENDENCIES}, {_PLAIN},
rows_ AS (SELECT * FROM creations UNION ALL SELECT * FROM dependencies UNION ALL SELECT * FROM plain),
placed AS (SELECT *, trim(split_part(object_name, ' -> ', 1)) AS place FROM rows_),
comments AS (SELECT conv_id AS log_id, arg_max(role || turn, turn) AS comment FROM conversations GROUP BY 1),
signs AS (SELECT doc_id AS log_id, arg_max('q' || quality, quality) AS sign FROM labels GROUP BY 1)
SELECT log_id, 0 AS part, {_PERIOD_TEXT}, CASE WHEN place LIKE '%MACHIN%' THEN 'Plant'
  WHEN place LIKE '%BUILD%' OR place LIKE '%4' OR (place LIKE '%Dependency%' AND place NOT LIKE '%Dependency%000_2%') THEN 'Additives'
  WHEN place LIKE '%Dependency%' THEN 'System' ELSE object_type END AS object_type, object_name, change, attribute, prev, new, {_CANCELLED},
  coalesce(comment, '') AS comment, coalesce(sign, '') AS sign
FROM placed LEFT JOIN comments USING (log_id) LEFT JOIN signs USING (log_id)""",
}
