"""Balance report and its operators on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.rules import rows_table
from ..operators import report as Rep
from ..operators import stock as St
from ..operators.blends import blend_balance, ledger_sums
from ..operators.periods import CaseSets, case_kind
from ..plans.tank_report import tank_report as build_report
from ..plans.totals import Totals, month_to_date
from ..sources.session import run_dir, staged
from ..sources.table_functions import table_function
from . import balance_roles as B
from . import roles as R
from .balance_roles import CURRENT, OPENING, PREVIOUS
from .roles import day_id, month_id, read

DIVISIONS = ((None, None, None), ("ASIA", None, None), ("EUROPE", "AMERICA", None))


def plain(df):
    """Decimals as doubles."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def union(parts):
    return reduce(lambda a, b: a.unionByName(b), parts)


def _months(first, last):
    """From the first day of a month to the last moment of another."""
    year, month = divmod(last, 100)
    after = (year + month // 12) * 100 + month % 12 + 1
    return (f"{first // 100}-{first % 100:02}-01", f"{after // 100}-{after % 100:02}-01")


def _described(spark, sf, case=month_id, span=None):
    return St.described_positions(B.positions(spark, sf, case, span), B.tanks(spark, sf), B.products(spark, sf))


def canonical_product(spark, sf):
    out = St.canonical_product(_described(spark, sf), B.NAMES, B.product_names(spark, sf))
    return plain(
        out.groupBy("canonical").agg(F.count("*").alias("n"), F.sum(F.col("measured").cast("decimal(18,3)")).alias("measured"))
    )


SCOPES = {d[0] or "PLANT": d for d in DIVISIONS}


def tank_scope(spark, sf):
    """Plant and two division sets out of one reading of the positions."""
    scoped = St.tank_scopes(_described(spark, sf), B.layers(spark, sf), B.SCOPE, SCOPES)
    measured = F.sum(F.col("measured").cast("decimal(18,3)"))
    return plain(scoped.groupBy("product", "division").agg(F.count("*").alias("n"), measured.alias("measured")))


def _roles(spark, sf, span=None):
    return B.positions(spark, sf, month_id, span), B.tanks(spark, sf), B.products(spark, sf), B.layers(spark, sf)


def _balances(spark, sf, scopes=SCOPES, span=None):
    return St.division_balances(*_roles(spark, sf, span), B.NAMES, B.product_names(spark, sf), B.SCOPE, scopes, by=["case_id"])


def _balance(spark, sf, span=None):
    return _balances(spark, sf, {"PLANT": DIVISIONS[0]}, span).drop("division")


def tank_balance(spark, sf):
    """Balance of every monthly case, plant and two division sets, out of one reading of the positions."""
    return plain(_balances(spark, sf))


def tank_balance_function(spark, sf):
    """The balances as a SQL function: each monthly case asks for its own, in one division set. Both calls read the stored balances."""
    table_function(
        "tank_balance_of", staged(_balances(spark, sf), "balances"),
        {"case_id": ("int", "r.case_id = {}"), "division": ("string", "r.division = {}"), "product": ("string", "r.product LIKE {}")},
        required=("case_id",), defaults={"division": "'PLANT'"},
    )
    R.cases(spark, sf).filter("analysis_id = 'MONTH'").createOrReplaceTempView("tank_months")
    return plain(spark.sql("""
        SELECT m.case_id AS of_case, t.* FROM tank_months m, LATERAL tank_balance_of(m.case_id, division => 'ASIA') t
        UNION ALL SELECT m.case_id, t.* FROM tank_months m, LATERAL tank_balance_of(m.case_id, product => '%r%') t"""))


def warehouse_topup(spark, sf):
    totals = St.warehouse_totals(
        _described(spark, sf), B.layers(spark, sf), B.TOPUP_NAMES, B.product_names(spark, sf), B.SCOPE, by=["case_id"]
    )
    out = St.warehouse_topup(_balances(spark, sf), totals, None, B.SCOPE, by=["case_id"], division="division")
    return plain(out.select("case_id", "product", "measured", "not_issued", "division"))


def topped_up_balances(spark, sf):
    """Balances and warehouse totals out of one reading of the positions."""
    out = St.topped_up_balances(
        *_roles(spark, sf), B.NAMES, B.TOPUP_NAMES, B.product_names(spark, sf), B.SCOPE, SCOPES, by=["case_id"]
    )
    return plain(out.select("case_id", "product", "measured", "not_issued", "division"))


def _of_case(spark, sf, case_id):
    return _balance(spark, sf, _months(case_id, case_id)).filter(F.col("case_id") == case_id).drop("case_id")


def compare_snapshots(spark, sf):
    out = St.compare_snapshots(_of_case(spark, sf, CURRENT), _of_case(spark, sf, PREVIOUS), _of_case(spark, sf, OPENING))
    return plain(out.select("product", "measured", "measured_old", "produced_day", "measured_start", "produced_month"))


def append_missing_opening(spark, sf):
    """All but the red products have a new name since the opening."""
    opening = _of_case(spark, sf, OPENING)
    renamed = F.when(F.col("product").like("%red%"), F.col("product")).otherwise(F.concat(F.lit("new "), "product"))
    now = _of_case(spark, sf, CURRENT).withColumn("product", renamed)
    cur = St.compare_snapshots(now, _of_case(spark, sf, PREVIOUS), opening)
    out = St.append_missing_opening(cur, opening)
    return plain(out.select("product", "measured", "measured_old", "produced_day", "measured_start", "produced_month"))


SPAN = _months(OPENING, CURRENT)
SETS = CaseSets(CURRENT, PREVIOUS, OPENING, (PREVIOUS, CURRENT), False, SPAN)


def snapshots_by_role(spark, sf):
    out = St.snapshots_by_role(_balance(spark, sf, SPAN), SETS, plant=True)
    return plain(out)


def shipment_totals(spark, sf):
    """Every month of the calendar as the case set, plant and one division out of one reading."""
    shipped = B.shipments(spark, sf, month_id)
    scopes = F.array_compact(F.array(F.lit("PLANT"), F.when(F.col("div") == "ASIA", F.col("div"))))
    cases = month_id(F.col("start_time")).alias("case_id")
    months = R.calendar_cases(read(spark, sf, "lineitem"), "l_shipdate").select(cases).distinct()
    return plain(Rep.shipment_totals(shipped.withColumn("division", F.explode(scopes)), months, by=["division"]))


def month_to_date_totals(spark, sf):
    """Shipments of each day and of its month so far, out of stored sums: a first load, later days, and days stated anew."""
    month = F.expr("case_id div 100").cast("int")
    totals = Totals(spark, f"{run_dir(spark, 'month_to_date')}/shipped", ("product", "div"), ("reconciled",), month)
    of = lambda a, b: B.shipments(spark, sf, day_id, (a, b))
    totals.load(of("0001-01-01", "1998-12-31 23:59:59"))
    later, again = of("1999-01-01", "9999-12-31"), of("1997-03-01", "1997-03-10 23:59:59")
    totals.restate(later, later.select("case_id"))
    totals.restate(again, again.select("case_id"))
    cases = case_kind(R.calendar_cases(read(spark, sf, "lineitem"), "l_shipdate"), "analysis_id", "MONTH")
    out = totals.of(month_to_date(cases), ["as_of"])
    return plain(out.groupBy("as_of", "div").agg(F.count("*").alias("products"), F.sum("reconciled").cast("decimal(18,3)").alias("reconciled")))


def _produced(spark, sf):
    rows = Rep.balance_rows(St.snapshots_by_role(_balance(spark, sf, SPAN), SETS, plant=True))
    shipped = B.shipments(spark, sf, month_id, SPAN)
    daily = Rep.shipment_totals(shipped, [SETS.current])
    month = Rep.shipment_totals(shipped, SETS.month)
    return Rep.production_from_balance(rows, daily, month)


PRODUCED = "product shipped_day shipped_month measured measured_old measured_start produced_day produced_month".split()


def production_from_balance(spark, sf):
    return plain(_produced(spark, sf).select(*PRODUCED))


def _stock_rows(spark, sf):
    """Balance rows of the current month as the base for the row-level operators."""
    return Rep.balance_rows(_of_case(spark, sf, CURRENT))


def scalar_override(spark, sf):
    facts = read(spark, sf, "lineitem").withColumn("amount", F.col("l_quantity").cast("decimal(18,3)"))
    day = facts.agg(F.sum(F.when(F.col("l_returnflag") == "A", F.col("amount")))).scalar()
    month = facts.agg(F.sum("amount")).scalar()
    rows = Rep.scalar_override(
        _stock_rows(spark, sf), B.REPORT.supply_product, {"produced_day": day, "produced_month": month}
    )
    out = Rep.literal_row(rows, "processed", {"produced_day": month, "produced_month": day})
    return plain(out.select("product", "measured", "produced_day", "produced_month"))


def append_system_rows(spark, sf):
    systems = (
        R.within(read(spark, sf, "orders"), "o_orderdate", SPAN)
        .groupBy(
            F.concat(F.lit("System "), F.col("o_custkey") % 40).alias("name"), month_id(F.col("o_orderdate")).alias("case_id")
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("reconciled"))
    )
    # one system went by another name in the previous month
    renamed = (F.col("case_id") == PREVIOUS) & (F.col("name") == "System 3")
    systems = systems.withColumn("name", F.when(renamed, F.lit("Old system")).otherwise(F.col("name")))
    at = {c: systems.filter(F.col("case_id") == c) for c in (CURRENT, PREVIOUS, OPENING)}
    out = Rep.append_system_rows(_stock_rows(spark, sf), at[CURRENT], at[PREVIOUS], at[OPENING])
    return plain(out.select("product", "measured", "measured_old", "produced_day", "measured_start", "produced_month"))


def meter_adjustment(spark, sf):
    rules = rows_table(spark, "product string, meter_id int", B.REPORT.meter_rules)
    meters = B.meters(spark, sf, SPAN).withColumn("case_id", F.floor(F.col("case_id") / 100).cast("int"))
    out = Rep.meter_adjustment(_stock_rows(spark, sf), rules, meters, SETS)
    return plain(out.select("product", "shipped_day", "shipped_month", "produced_day", "produced_month"))


def flow_total(spark, sf):
    months = B.flow_values(spark, sf, SPAN).withColumn("case_id", F.floor(F.col("case_id") / 100).cast("int"))
    return plain(
        Rep.flow_total(
            B.flows(spark, sf), months, B.links(spark, sf), B.objects(spark, sf), B.object_types(spark), B.products(spark, sf),
            SETS, "%BUILD%", "%bolt%",
        )
    )


def _blended(spark, sf, daily):
    rows = _produced(spark, sf)
    sums = ledger_sums(B.BLENDS, B.ledger(spark, sf, CURRENT, OPENING), CURRENT, OPENING)
    monthly = B.arrivals(spark, sf, SPAN).withColumn("case_id", F.floor(F.col("case_id") / 100).cast("int"))
    return blend_balance(rows, B.BLENDS, sums, Rep.role_totals(monthly, SETS, "measured", ["product"]), daily)


def blend_balance_daily(spark, sf):
    return plain(_blended(spark, sf, True).select(*PRODUCED))


def blend_balance_cumulative(spark, sf):
    return plain(_blended(spark, sf, False).select(*PRODUCED))


def consolidate(spark, sf):
    rows = _stock_rows(spark, sf).withColumn("group_name", F.lit(""))
    out = Rep.consolidate(rows, B.REPORT.consolidated, "old goods")
    return plain(out.select("product", "group_name", "measured", "passported", "free_volume"))


def _summary(spark, sf):
    rows = _produced(spark, sf)
    return Rep.product_summary(rows.unionByName(rows.filter(F.col("product").like("%r%"))), B.groups(spark, sf), True, ("waste", "cold"))


def product_summary(spark, sf):
    return plain(_summary(spark, sf))


def hide_empty(spark, sf):
    """Parts with few measures set; some rows are all zero in what is tested."""
    k = F.col("p_partkey")
    rows = read(spark, sf, "part").select(
        F.concat("p_name", F.lit(" "), F.when(k % 10 == 0, F.lit("Blend")).otherwise(F.lit("plain"))).alias("product"),
        k.alias("id"),
        *[
            (F.when(k % (len(Rep.SUMMARY) + 3) == i, F.col("p_size")).otherwise(0)).cast("decimal(18,3)").alias(m)
            for i, m in enumerate(Rep.SUMMARY)
        ],
    )
    return plain(Rep.hide_empty(rows, keep="%blend%").select("product", "id", *Rep.SUMMARY))


def group_headers(spark, sf):
    return plain(Rep.group_headers(Rep.hide_empty(_summary(spark, sf), keep="%blend%")))


def _chain(spark, sf):
    """Customers as a list: each after its third, some after nobody that exists, two after each other."""
    k = F.col("c_custkey")
    after = (
        F.when(k == 5, F.lit(17)).when(k % 50 == 49, F.lit(-1)).when(k != 0, F.floor(k / 3)).cast("bigint")
    )
    return read(spark, sf, "customer").select(k.alias("id"), F.col("c_name").alias("name"), after.alias("after_id"))


def chain_order(spark, sf):
    return Rep.chain_order(_chain(spark, sf)).select("id", "sort_order")


def attach_order(spark, sf):
    grouped = Rep.group_headers(Rep.hide_empty(_summary(spark, sf)), measures=["measured"])
    sorting = B.sorting(spark, sf)
    return plain(Rep.attach_order(grouped, sorting, Rep.chain_order(sorting)).orderBy(F.asc_nulls_last("sort_order")))


def _typed_parts(spark, sf):
    """Part names and types as items and groups; the types themselves are the header rows."""
    parts = read(spark, sf, "part").select(
        F.concat("p_name", F.lit(" "), "p_brand").alias("product"), F.col("p_type").alias("group_name"),
        F.col("p_size").cast("decimal(18,3)").alias("produced_day"), (F.col("p_size") * 2).cast("decimal(18,3)").alias("produced_month"),
    )
    return Rep.group_headers(parts, measures=["produced_day", "produced_month"])


def relabel_groups(spark, sf):
    systems = (
        read(spark, sf, "part")
        .select(
            F.when(F.col("p_size") > 25, F.concat("p_name", F.lit(" "), "p_brand")).alias("name"),
            F.lower("p_type").alias("group_name"),
        )
    )
    return plain(Rep.relabel_groups(_typed_parts(spark, sf), systems))


def fold_into_header(spark, sf):
    return plain(Rep.fold_into_header(_typed_parts(spark, sf), "%brand#1%"))


def tank_report(spark, sf):
    return plain(build_report(B.report_catalog(spark, sf), B.REPORT_CASE, B.REPORT))


def tank_report_division(spark, sf):
    return plain(build_report(B.report_catalog(spark, sf), B.REPORT_CASE, B.REPORT, ("ASIA", None, None)))


def tank_report_month(spark, sf):
    return plain(build_report(B.report_catalog(spark, sf), CURRENT, B.REPORT))


QUERIES = {
    f.__name__: f
    for f in (
        month_to_date_totals, canonical_product, tank_scope, tank_balance, tank_balance_function, warehouse_topup, topped_up_balances, compare_snapshots, append_missing_opening,
        snapshots_by_role, shipment_totals, production_from_balance, scalar_override, append_system_rows,
        meter_adjustment, flow_total, blend_balance_daily, blend_balance_cumulative, consolidate, product_summary,
        hide_empty, group_headers, chain_order, attach_order, relabel_groups, fold_into_header,
        tank_report, tank_report_division, tank_report_month,
    )
}

# ---- oracles ---------------------------------------------------------------------------------------

_MONTHLY = B.described_sql(B.MONTH_CASE)
_DOUBLES = "CAST({0} AS DOUBLE) AS {0}"


def _d(*columns: str) -> str:
    return ", ".join(_DOUBLES.format(c) for c in columns)


def _m(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(18,3))"


_SCOPES = " UNION ALL ".join(
    f"""SELECT product, '{d[0] or 'PLANT'}' AS division, count(*) AS n, CAST(sum(CAST(measured AS DECIMAL(18,3))) AS DOUBLE) AS measured
FROM described WHERE {B.scope_sql(*[x for i, x in enumerate(d) if i == 0 or x])} GROUP BY product"""
    for d in DIVISIONS
)
_BALANCES = " UNION ALL ".join(
    f"SELECT *, '{d[0] or 'PLANT'}' AS division FROM ({B.balance_sql(*[x for i, x in enumerate(d) if i == 0 or x])})" for d in DIVISIONS
)
_STOCK = f"WITH RECURSIVE {_MONTHLY}, balance AS ({B.balance_sql(None)})"
_AT = {"cur": CURRENT, "prev": PREVIOUS, "open_": OPENING}
_SNAPSHOTS = ", ".join(
    f"{name} AS (SELECT product, {', '.join(_m(m) + ' AS ' + m for m in St.STOCK_MEASURES)} FROM balance WHERE case_id = {case})"
    for name, case in _AT.items()
)
_COMPARED = "product, " + _d("measured") + """, CAST(coalesce(p.m, 0) AS DOUBLE) AS measured_old,
  CAST(coalesce(measured, 0) - coalesce(p.m, 0) AS DOUBLE) AS produced_day, CAST(coalesce(o.m, 0) AS DOUBLE) AS measured_start,
  CAST(coalesce(measured, 0) - coalesce(o.m, 0) AS DOUBLE) AS produced_month"""
_COMPARE_JOIN = """LEFT JOIN (SELECT product, measured AS m FROM prev) p USING (product)
  LEFT JOIN (SELECT product, measured AS m FROM open_) o USING (product)"""
_SOLD = """sold AS (SELECT p_name AS product, r_name AS div, CASE WHEN l_linenumber <> 6 THEN CAST(l_quantity AS DECIMAL(18,3)) END AS reconciled,
  CASE WHEN l_tax > 0.02 THEN CAST(l_tax * 100 AS DECIMAL(18,3)) END AS arrived, l_shipdate AS sold_at
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""


def _produced_sql(cur: str, prev: str, opening: str, day: str, month: str, div: str | None = None) -> str:
    """Balance rows after the shipments: one full join of all names instead of two merges."""
    sold_in = "" if div is None else f"AND div = '{div}'"
    known = "SELECT product FROM cur UNION SELECT product FROM open_" if div is None else "SELECT product FROM cur"
    return f"""names AS ({known} UNION SELECT product FROM sold WHERE ({day} OR {month}) {sold_in}),
day_sold AS (SELECT product, sum(reconciled) AS r FROM sold WHERE {day} {sold_in} GROUP BY product),
month_sold AS (SELECT product, sum(reconciled) AS r FROM sold WHERE {month} {sold_in} GROUP BY product),
produced AS (SELECT n.product, coalesce(d.r, 0) AS shipped_day, coalesce(s.r, 0) AS shipped_month, coalesce(c.measured, 0) AS measured,
    CASE WHEN c.product IS NULL THEN 0 ELSE coalesce(p.measured, 0) END AS measured_old, coalesce(c.not_issued, 0) AS not_issued,
    CASE WHEN {'TRUE' if div is None else 'c.product IS NOT NULL'} THEN coalesce(o.measured, 0) ELSE 0 END AS measured_start,
    coalesce(c.passported, 0) AS passported, coalesce(c.not_passported, 0) AS not_passported,
    CASE WHEN c.product IS NOT NULL OR o.product IS NOT NULL OR d.product IS NOT NULL THEN
      coalesce(c.measured, 0) + coalesce(s.r, 0) - coalesce(o.measured, 0) ELSE s.r END AS produced_month,
    CASE WHEN c.product IS NOT NULL THEN c.measured + coalesce(d.r, 0) - coalesce(p.measured, 0)
      WHEN o.product IS NOT NULL THEN coalesce(d.r, 0)
      WHEN d.product IS NOT NULL THEN d.r ELSE 0 END AS produced_day,
    coalesce(c.dead_residue, 0) AS dead_residue, coalesce(c.free_volume, 0) AS free_volume
  FROM names n LEFT JOIN cur c USING (product) LEFT JOIN prev p ON p.product = n.product
  LEFT JOIN {'open_' if div is None else '(SELECT open_.* FROM open_ JOIN cur USING (product))'} o ON o.product = n.product
  LEFT JOIN day_sold d ON d.product = n.product LEFT JOIN month_sold s ON s.product = n.product)"""


_DAY_SOLD = f"CAST(strftime(sold_at, '%Y%m') AS INT) = {CURRENT}"
_MONTH_SOLD = f"CAST(strftime(sold_at, '%Y%m') AS INT) IN ({PREVIOUS}, {CURRENT})"
_PRODUCED = f"{_STOCK}, {_SNAPSHOTS}, {_SOLD}, " + _produced_sql("cur", "prev", "open_", _DAY_SOLD, _MONTH_SOLD)
_ROWS = f"{_STOCK}, {_SNAPSHOTS}, stock AS (SELECT product, measured FROM cur)"


def _ledger_sql(current: int, opening: int) -> str:
    return f"""ledger AS (SELECT CASE p_partkey % 3 WHEN 0 THEN {current} WHEN 1 THEN {opening} ELSE 19970101 END AS case_id,
  CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'mix ' || p_name || ' ' || p_brand END AS name, CAST(p_size * 4 AS DECIMAL(18,3)) AS open_mass,
  CAST(p_size AS DECIMAL(18,3)) AS coming_mix, CAST(p_size * 2.5 AS DECIMAL(18,3)) AS end_mass,
  CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size / 2 AS DECIMAL(18,3)) END AS measured_day, CAST(p_size * 3 AS DECIMAL(18,3)) AS measured_accum
  FROM part)"""


def _blend_sql(base: str, current: int, opening: int, day: str, month: str, daily: bool) -> str:
    """Blend rows written out one by one, then the rewritten base rows."""
    parts = []
    for b in B.BLENDS:
        if b.literal:
            parts.append(f"SELECT '{b.name}' AS product, " + ", ".join(f"0 AS {m}" for m in Rep.MEASURES))
            continue
        led = f"FROM ledger WHERE case_id = {current} AND name LIKE '{b.pattern}'"
        opened = f"(SELECT sum(end_mass) FROM ledger WHERE case_id = {opening} AND name LIKE '{b.opening_pattern or b.pattern}')"
        if b.opening == "by_kind" and not daily:
            opened = f"(SELECT sum(open_mass) {led})"
        end = f"(SELECT sum(end_mass) {led})"
        gap = "measured_old + coalesce(d, 0) - measured"
        month_gap = "abs(measured_start + coalesce(m, 0) - measured)"
        day_value = {"abs": f"abs({gap})", "plain": gap, "coming": f"(SELECT sum(coming_mix) {led})"}[b.daily]
        shipped = "measured_accum" if b.shipped_day == "by_kind" and not daily else "measured_day"
        rest = {"rest": f"{opened} + {month_gap} - {end}", "month": month_gap, "none": "0"}[b.shipped_month]
        values = {
            "shipped_day": f"(SELECT sum({shipped}) {led})", "shipped_month": rest, "measured": end,
            "measured_start": opened, "produced_month": month_gap, "produced_day": day_value,
        }
        columns = ", ".join(f"{values.get(m, '0')} AS {m}" for m in Rep.MEASURES)
        parts.append(f"SELECT '{b.name}' AS product, {columns} FROM arrived_rows WHERE product = '{b.product}'")
    rewritten = ", ".join(f"'{b.product}'" for b in B.BLENDS if b.rewrite_base and not b.literal)
    change = {
        "produced_day": "d", "produced_month": "m",
        "shipped_day": "abs(measured_old + coalesce(d, 0) - measured)", "shipped_month": "abs(measured_start + coalesce(m, 0) - measured)",
    }
    columns = ", ".join(
        f"CASE WHEN product IN ({rewritten}) THEN {change[m]} ELSE {m} END AS {m}" if m in change else m for m in Rep.MEASURES
    )
    return f"""{_ledger_sql(current, opening)},
day_arrived AS (SELECT product, sum(arrived) AS d FROM sold WHERE {day} GROUP BY product),
month_arrived AS (SELECT product, sum(arrived) AS m FROM sold WHERE {month} GROUP BY product),
arrived_rows AS (SELECT * FROM {base} LEFT JOIN day_arrived USING (product) LEFT JOIN month_arrived USING (product)),
blended AS (SELECT product, {columns} FROM arrived_rows UNION ALL {' UNION ALL '.join(parts)})"""


_GROUPS = "groups_ AS (SELECT DISTINCT p_name AS product, split_part(p_name, ' ', 1) AS group_name FROM part WHERE p_name NOT LIKE 'new%')"


def _summary_sql(rows: str, plant: bool = True) -> str:
    sums = ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in Rep.SUMMARY if m != "dead_residue")
    group = "CASE WHEN r.product = 'waste' THEN 'cold' ELSE g.group_name END" if plant else "g.group_name"
    return f"""{_GROUPS}, summary AS (SELECT product, group_name, {sums},
  coalesce(sum(measured) - sum(not_issued) - (sum(passported) + sum(not_passported)), 0) AS dead_residue
  FROM (SELECT r.*, {group} AS group_name FROM {rows} r LEFT JOIN groups_ g ON g.product = r.product) GROUP BY product, group_name)"""


_SHOWN = f"""shown AS (SELECT * FROM summary WHERE product LIKE '%blend%' OR {' OR '.join(m + ' <> 0' for m in Rep.VISIBLE)})"""
_HEADERS = f"""grouped AS (SELECT product, group_name, {', '.join(Rep.SUMMARY)} FROM shown WHERE product IS NOT NULL
  UNION ALL SELECT group_name, group_name, {', '.join(f'sum({m})' for m in Rep.SUMMARY)} FROM shown WHERE group_name IS NOT NULL GROUP BY group_name)"""
_TWICE = "twice AS (SELECT * FROM produced UNION ALL SELECT * FROM produced WHERE product LIKE '%r%')"
_SUMMARY = f"{_PRODUCED}, {_TWICE}, {_summary_sql('twice')}"
_SORTING = """sorting AS (SELECT pos AS id, name, CASE WHEN thing = 'anvil' THEN CASE WHEN colour = 'new' THEN 9999 END ELSE pos - 1 END AS after_id
  FROM (SELECT name, split_part(name, ' ', 1) AS colour, split_part(name, ' ', 2) AS thing,
      list_position(['blue', 'cold', 'hot', 'large', 'new', 'old', 'red', 'small'], split_part(name, ' ', 1)) * 8
      + list_position(['anvil', 'bolt', 'gear', 'gizmo', 'plate', 'ring', 'rod', 'widget'], split_part(name, ' ', 2)) AS pos
    FROM (SELECT DISTINCT p_name AS name FROM part))),
chain AS (SELECT id, name, 1 AS sort_order FROM sorting WHERE after_id IS NULL
  UNION ALL SELECT s.id, s.name, c.sort_order + 1 FROM sorting s JOIN chain c ON s.after_id = c.id)"""
_TYPED = """items AS (SELECT p_name || ' ' || p_brand AS product, p_type AS group_name, sum(p_size) AS produced_day, sum(2 * p_size) AS produced_month
  FROM part GROUP BY ALL),
typed AS (SELECT * FROM items UNION ALL SELECT group_name, group_name, sum(produced_day), sum(produced_month) FROM items GROUP BY group_name)"""
_FLOW = """live_objects AS (SELECT s_suppkey AS id, 'SUPPLIER' AS t FROM supplier WHERE s_acctbal >= 0),
flow AS (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS case_id, o_totalprice * k.n AS value
  FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0 AND c_mktsegment = 'BUILDING'
  JOIN live_objects d ON d.id = o_orderkey % 97 JOIN goods a ON a.id = o_orderkey % 180 AND a.product ILIKE '%bolt%'
  JOIN goods b ON b.id = o_custkey % 150
  JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem JOIN live_objects ON id = l_suppkey GROUP BY 1) k ON k.l_orderkey = o_orderkey
  WHERE o_orderstatus <> 'F')"""

ORACLE = {
    "canonical_product": f"""WITH {_MONTHLY} SELECT {B.CANONICAL} AS canonical, count(*) AS n, CAST(sum(CAST(measured AS DECIMAL(18,3))) AS DOUBLE) AS measured
FROM described GROUP BY 1""",
    "tank_scope": f"WITH {_MONTHLY} {_SCOPES}",
    "tank_balance": f"WITH {_MONTHLY}, b AS ({_BALANCES}) SELECT case_id, product, division, {_d(*St.STOCK_MEASURES)} FROM b",
    "tank_balance_function": R.more_ctes("cases") + f"""{_MONTHLY}, b AS ({_BALANCES}), of_month AS (
  SELECT case_id AS of_case, case_id, product, division, {_d(*St.STOCK_MEASURES)} FROM b WHERE case_id IN (SELECT case_id FROM cases WHERE analysis_id = 'MONTH'))
SELECT * FROM of_month WHERE division = 'ASIA' UNION ALL SELECT * FROM of_month WHERE division = 'PLANT' AND product LIKE '%r%'""",
    "warehouse_topup": f"""WITH {_MONTHLY}, b AS ({_BALANCES}), w AS ({B.WAREHOUSE})
SELECT case_id, product, division, CAST(measured + CASE WHEN division = 'ASIA' THEN coalesce(warehouse, 0) ELSE 0 END AS DOUBLE) AS measured,
  CAST(CASE WHEN division = 'ASIA' THEN coalesce(warehouse, not_issued) ELSE not_issued END AS DOUBLE) AS not_issued
FROM b LEFT JOIN w USING (case_id, product)""",
    "topped_up_balances": f"""WITH {_MONTHLY}, b AS ({_BALANCES}), w AS ({B.WAREHOUSE})
SELECT case_id, product, division, CAST(measured + CASE WHEN division = 'ASIA' THEN coalesce(warehouse, 0) ELSE 0 END AS DOUBLE) AS measured,
  CAST(CASE WHEN division = 'ASIA' THEN coalesce(warehouse, not_issued) ELSE not_issued END AS DOUBLE) AS not_issued
FROM b LEFT JOIN w USING (case_id, product)""",
    "compare_snapshots": f"{_STOCK}, {_SNAPSHOTS} SELECT {_COMPARED} FROM cur {_COMPARE_JOIN}",
    "append_missing_opening": f"""{_STOCK}, {_SNAPSHOTS},
now_ AS (SELECT * REPLACE (CASE WHEN product LIKE '%red%' THEN product ELSE 'new ' || product END AS product) FROM cur)
SELECT {_COMPARED} FROM now_ {_COMPARE_JOIN}
UNION ALL SELECT product, 0, 0, 0, CAST(measured AS DOUBLE), CAST(-measured AS DOUBLE) FROM open_
  WHERE product NOT IN (SELECT product FROM now_)""",
    "snapshots_by_role": f"""{_STOCK}, {_SNAPSHOTS} SELECT {_COMPARED}, {_d(*St.STOCK_MEASURES[1:])} FROM cur {_COMPARE_JOIN}
UNION ALL SELECT product, 0, 0, 0, CAST(measured AS DOUBLE), CAST(-measured AS DOUBLE), 0, 0, 0, 0, 0 FROM open_
  WHERE product NOT IN (SELECT product FROM cur)""",
    "month_to_date_totals": f"""WITH {_SOLD},
day AS (SELECT CAST(sold_at AS DATE) AS d, product, div, sum(reconciled) AS s FROM sold GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(date_trunc('day', min(l_shipdate)), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem),
so_far AS (SELECT days.d AS as_of, product, div, sum(s) AS s FROM days JOIN day ON date_trunc('month', day.d) = date_trunc('month', days.d) AND day.d <= days.d
  GROUP BY ALL)
SELECT CAST(strftime(as_of, '%Y%m%d') AS INT) AS as_of, div, count(*) AS products, CAST(sum(s) AS DOUBLE) AS reconciled FROM so_far GROUP BY ALL""",
    "shipment_totals": f"""WITH {_SOLD} SELECT product, CAST(sum(reconciled) AS DOUBLE) AS reconciled, 'PLANT' AS division FROM sold GROUP BY product
UNION ALL SELECT product, CAST(sum(reconciled) AS DOUBLE), 'ASIA' FROM sold WHERE div = 'ASIA' GROUP BY product""",
    "production_from_balance": f"{_PRODUCED} SELECT product, {_d(*PRODUCED[1:])} FROM produced",
    "scalar_override": f"""{_ROWS}, totals AS (SELECT sum(CAST(l_quantity AS DECIMAL(18,3))) FILTER (l_returnflag = 'A') AS d,
  sum(CAST(l_quantity AS DECIMAL(18,3))) AS m FROM lineitem)
SELECT product, {_d('measured')}, CAST(CASE WHEN product = 'blue widget' THEN d ELSE 0 END AS DOUBLE) AS produced_day,
  CAST(CASE WHEN product = 'blue widget' THEN m ELSE 0 END AS DOUBLE) AS produced_month FROM stock, totals
UNION ALL SELECT 'processed', 0, CAST(m AS DOUBLE), CAST(d AS DOUBLE) FROM totals""",
    "append_system_rows": f"""{_ROWS}, systems AS (SELECT 'System ' || (o_custkey % 40) AS name, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS case_id,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS r FROM orders GROUP BY ALL),
known AS (SELECT * FROM systems WHERE case_id <> {PREVIOUS} OR name <> 'System 3')
SELECT product, {_d('measured')}, 0.0 AS measured_old, 0.0 AS produced_day, 0.0 AS measured_start, 0.0 AS produced_month FROM stock
UNION ALL SELECT c.name, CAST(c.r AS DOUBLE), CAST(coalesce(p.r, 0) AS DOUBLE), CAST(coalesce(c.r - p.r, 0) AS DOUBLE),
  CAST(coalesce(o.r, 0) AS DOUBLE), CAST(coalesce(c.r - o.r, 0) AS DOUBLE)
FROM known c LEFT JOIN known p ON p.name = c.name AND p.case_id = {PREVIOUS} LEFT JOIN known o ON o.name = c.name AND o.case_id = {OPENING}
WHERE c.case_id = {CURRENT}""",
    "meter_adjustment": f"""{_ROWS}, meter AS (SELECT o_custkey % 50 AS id, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS case_id,
  CAST(o_totalprice AS DECIMAL(18,3)) AS v FROM orders),
adds AS (SELECT r.product, sum(v) FILTER (case_id = {CURRENT}) AS d, sum(v) FILTER (case_id IN ({CURRENT}, {PREVIOUS})) AS m
  FROM (VALUES ('cold rod', 7), ('cold gear', 8), ('cold gear', 9)) r(product, id) JOIN meter USING (id) GROUP BY r.product)
SELECT product, CAST(coalesce(d, 0) AS DOUBLE) AS shipped_day, CAST(coalesce(m, 0) AS DOUBLE) AS shipped_month,
  CAST(coalesce(d, 0) AS DOUBLE) AS produced_day, CAST(coalesce(m, 0) AS DOUBLE) AS produced_month FROM stock LEFT JOIN adds USING (product)""",
    "flow_total": f"""WITH {B.GOODS}, {_FLOW} SELECT CAST(sum(CAST(value AS DECIMAL(18,3))) FILTER (case_id // 100 = {CURRENT}) AS DOUBLE) AS day_total,
  CAST(sum(CAST(value AS DECIMAL(18,3))) FILTER (case_id // 100 IN ({CURRENT}, {PREVIOUS})) AS DOUBLE) AS month_total FROM flow""",
    **{
        f"blend_balance_{kind}": f"{_PRODUCED}, " + _blend_sql("produced", CURRENT, OPENING, _DAY_SOLD, _MONTH_SOLD, kind == "daily")
        + f" SELECT product, {_d(*PRODUCED[1:])} FROM blended"
        for kind in ("daily", "cumulative")
    },
    "consolidate": f"""{_STOCK}, {_SNAPSHOTS}, listed AS (SELECT product IN ('old gear', 'old ring', 'old widget', 'Shop 8') AS inside, * FROM cur)
SELECT product, '' AS group_name, {_d('measured', 'passported', 'free_volume')} FROM listed WHERE NOT inside
UNION ALL SELECT 'old goods', 'old goods', CAST(sum(measured) AS DOUBLE), CAST(sum(passported) AS DOUBLE), CAST(sum(free_volume) AS DOUBLE)
  FROM listed WHERE inside""",
    "product_summary": f"{_SUMMARY} SELECT product, group_name, {_d(*Rep.SUMMARY)} FROM summary",
    "hide_empty": f"""SELECT * FROM (SELECT p_name || ' ' || CASE WHEN p_partkey % 10 = 0 THEN 'Blend' ELSE 'plain' END AS product, p_partkey AS id,
  {', '.join(f"CAST(CASE WHEN p_partkey % 14 = {i} THEN p_size ELSE 0 END AS DOUBLE) AS {m}" for i, m in enumerate(Rep.SUMMARY))} FROM part)
WHERE product LIKE '%Blend' OR id % 14 IN ({', '.join(str(Rep.SUMMARY.index(m)) for m in Rep.VISIBLE)})""",
    "group_headers": f"{_SUMMARY}, {_SHOWN}, {_HEADERS} SELECT product, group_name, {_d(*Rep.SUMMARY)} FROM grouped",
    "chain_order": """WITH RECURSIVE s AS (SELECT c_custkey AS id, CASE WHEN c_custkey = 5 THEN 17 WHEN c_custkey % 50 = 49 THEN -1
  WHEN c_custkey <> 0 THEN c_custkey // 3 END AS after_id FROM customer),
chain AS (SELECT id, 1 AS sort_order FROM s WHERE after_id IS NULL UNION ALL SELECT s.id, c.sort_order + 1 FROM s JOIN chain c ON s.after_id = c.id)
SELECT * FROM chain""",
    "attach_order": f"""{_SUMMARY}, {_SHOWN.replace("product LIKE '%blend%' OR ", '')}, {_HEADERS}, {_SORTING}
SELECT product, group_name, {_d('measured')}, s.id AS sort_id, c.sort_order FROM grouped LEFT JOIN sorting s ON s.name = product LEFT JOIN chain c ON c.id = s.id""",
    "relabel_groups": f"""WITH {_TYPED} SELECT product, CASE WHEN product IN (SELECT p_name || ' ' || p_brand FROM part WHERE p_size > 25)
  THEN (SELECT min(lower(p_type)) FROM part WHERE p_size > 25 AND p_name || ' ' || p_brand = product) ELSE group_name END AS group_name,
  {_d('produced_day', 'produced_month')} FROM typed""",
    "fold_into_header": f"""WITH {_TYPED}, extra AS (SELECT group_name AS g, sum(produced_day) AS x FROM typed WHERE product LIKE '%Brand#1%' GROUP BY 1)
SELECT product, group_name, CAST(produced_day + CASE WHEN product = group_name THEN coalesce(x, 0) ELSE 0 END AS DOUBLE) AS produced_day,
  CAST(produced_month + CASE WHEN product = group_name THEN coalesce(x, 0) ELSE 0 END AS DOUBLE) AS produced_month
FROM typed LEFT JOIN extra ON g = product""",
}


def _report_sql(current: int, previous: int, opening: int, month: str, monthly: bool, div: str | None) -> str:
    """The whole report as one chain of CTEs; ``month`` is the SQL list of the month set."""
    sets = f"CAST(strftime({{0}}, '%Y%m%d') AS INT)"
    day_of, in_month = f"{sets.format('sold_at')} = {current}", f"{sets.format('sold_at')} IN ({month})"
    o_day, o_month = f"{sets.format('o_orderdate')} = {current}", f"{sets.format('o_orderdate')} IN ({month})"
    measures = ", ".join(Rep.MEASURES)
    balance = B.balance_sql(div)
    if div is not None:
        extra = {"measured": "measured + coalesce(warehouse, 0)", "not_issued": "coalesce(warehouse, not_issued)"}
        columns = ", ".join(f"{extra.get(m, m)} AS {m}" for m in St.STOCK_MEASURES)
        balance = f"SELECT case_id, product, {columns} FROM ({balance}) LEFT JOIN ({B.WAREHOUSE}) USING (case_id, product)"
    at = {"cur": current, "prev": previous, "open_": opening}
    snapshots = ", ".join(
        f"{name} AS (SELECT product, {', '.join(_m(m) + ' AS ' + m for m in St.STOCK_MEASURES)} FROM balance WHERE case_id = {case})"
        for name, case in at.items()
    )

    def order_total(where: str, over: str, divisor: int) -> str:
        return f"(SELECT sum(CAST(o_totalprice / {divisor} AS DECIMAL(18,2))) FROM orders WHERE {where} AND {over})"

    supplied = ", ".join(
        f"CASE WHEN product = 'blue widget' THEN {order_total(chr(39).join(['o_orderpriority = ', '1-URGENT', '']), over, 1000)} ELSE {m} END AS {m}"
        if over else m
        for m, over in ((m, {"produced_day": o_day, "produced_month": o_month}.get(m)) for m in Rep.MEASURES)
    )
    sql = f"""WITH RECURSIVE {B.described_sql(B.DAY_CASE)}, balance AS ({balance}), {snapshots}, {_SOLD},
{_produced_sql('cur', 'prev', 'open_', day_of, in_month, div)},
supplied AS (SELECT product, {supplied} FROM produced),
systems AS (SELECT 'System ' || (o_custkey % 25) AS name, ['blue', 'cold', 'hot', 'large', 'new'][1 + o_custkey % 5] AS group_name,
  {sets.format('o_orderdate')} AS case_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS r FROM orders GROUP BY ALL)"""
    rows = "supplied"
    if div is None:
        status = "P" if monthly else "F"
        values = {
            "measured": "c.r", "measured_old": "coalesce(p.r, 0)", "produced_day": "coalesce(c.r - p.r, 0)",
            "measured_start": "coalesce(o.r, 0)", "produced_month": "coalesce(c.r - o.r, 0)",
        }
        processed = {f"produced_{k}": order_total(f"o_orderstatus = '{status}'", w, 100) for k, w in (("day", o_day), ("month", o_month))}
        flow = {f"produced_{k}": f"(SELECT sum(CAST(value AS DECIMAL(18,3))) FROM flow WHERE case_id {w})"
                for k, w in (("day", f"= {current}"), ("month", f"IN ({month})"))}

        def one(values: dict) -> str:
            return ", ".join(f"{values.get(m, '0')} AS {m}" for m in Rep.MEASURES)

        add = {m: "d" if m.endswith("day") else "m" for m in ("shipped_day", "shipped_month", "produced_day", "produced_month")}
        metered = ", ".join(f"{m} + coalesce({add[m]}, 0) AS {m}" if m in add else m for m in Rep.MEASURES)
        sql += f""", {_FLOW},
with_systems AS (SELECT product, {measures} FROM supplied UNION ALL SELECT c.name, {one(values)} FROM systems c
  LEFT JOIN systems p ON p.name = c.name AND p.case_id = {previous} LEFT JOIN systems o ON o.name = c.name AND o.case_id = {opening}
  WHERE c.case_id = {current} UNION ALL SELECT 'processed', {one(processed)}),
adds AS (SELECT r.product AS product, sum(v) FILTER ({o_day}) AS d, sum(v) FILTER ({o_month}) AS m
  FROM (VALUES ('cold rod', 7), ('cold gear', 8), ('cold gear', 9)) r(product, id)
  JOIN (SELECT o_custkey % 50 AS id, o_orderdate, CAST(o_totalprice AS DECIMAL(18,3)) AS v FROM orders) USING (id) GROUP BY 1),
metered AS (SELECT product, {metered} FROM with_systems LEFT JOIN adds USING (product) UNION ALL SELECT 'flow (blend)', {one(flow)}),
{_blend_sql('metered', current, 19970228, day_of, in_month, not monthly)}"""
        rows = "blended"
    members = "product IN ('old gear', 'old ring', 'old widget', 'Shop 8')"
    sums = ", ".join(f"sum({m})" for m in Rep.MEASURES)
    out = {
        "dead_residue": "CASE WHEN product IN ('blue bolt (blend)', 'hot rod (blend)') THEN 0 ELSE dead_residue END",
        "not_issued": "CASE WHEN product IN ('blue bolt (blend)', 'hot rod (blend)') THEN 0 ELSE not_issued END",
        "produced_day": "produced_day + CASE WHEN product = new_group THEN coalesce(x, 0) ELSE 0 END",
        "produced_month": "produced_month + CASE WHEN product = new_group THEN coalesce(x, 0) ELSE 0 END",
    }
    final = ", ".join(f"CAST({out.get(m, m)} AS DOUBLE) AS {m}" for m in Rep.SUMMARY)
    return f"""{sql}, consolidated AS (SELECT product, {measures} FROM {rows} WHERE NOT ({members})
  UNION ALL SELECT 'old goods', {sums} FROM {rows} WHERE {members}),
{_summary_sql('consolidated', div is None)}, {_SHOWN}, {_HEADERS}, {_SORTING},
labelled AS (SELECT g.*, coalesce(y.group_name, g.group_name) AS new_group FROM grouped g
  LEFT JOIN (SELECT DISTINCT name, group_name FROM systems WHERE case_id IN ({month})) y ON y.name = g.product),
extra AS (SELECT new_group AS eg, sum(produced_day) AS x FROM labelled WHERE product ILIKE '%system%' GROUP BY 1)
SELECT product, new_group AS group_name, {final}, s.id AS sort_id, c.sort_order
FROM labelled LEFT JOIN extra ON eg = product LEFT JOIN sorting s ON s.name = product LEFT JOIN chain c ON c.id = s.id"""


_MARCH = ", ".join(str(d) for d in range(19970301, B.REPORT_CASE + 1))
ORACLE["tank_report"] = _report_sql(B.REPORT_CASE, 19970319, 19970228, _MARCH, False, None)
ORACLE["tank_report_division"] = _report_sql(B.REPORT_CASE, 19970319, 19970228, _MARCH, False, "ASIA")
ORACLE["tank_report_month"] = _report_sql(CURRENT, 19970228, 19970228, str(CURRENT), True, None)
