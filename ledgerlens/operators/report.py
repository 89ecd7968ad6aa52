"""Balance report: shipments, production, overrides, groups, order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import exact, money, or_zero, total, zero
from ..functions.grouping import first_per_key
from ..functions.text import like_any
from ..sources.session import staged
from .ledger import override_rows, upsert_measures
from .periods import CaseSets

# The measures of a balance row, all DECIMAL(18,3), default 0.
MEASURES = (
    "shipped_day shipped_month measured measured_old not_issued measured_start passported not_passported "
    "produced_month produced_day dead_residue free_volume"
).split()
# the summary and the report leave out the previous snapshot's value
SUMMARY = [m for m in MEASURES if m != "measured_old"]
VISIBLE = [m for m in SUMMARY if m not in ("measured_start", "not_issued")]


def balance_rows(df: DataFrame) -> DataFrame:
    """``product`` and the twelve measures; a measure the input lacks is 0."""
    have = set(df.columns)
    return df.select(
        "product", *[(money(F.col(m)) if m in have else zero()).alias(m) for m in MEASURES]
    )


def literal_row(df: DataFrame, product: str, values: Mapping[str, Column]) -> DataFrame:
    """``df`` plus one row with the given measures, the others 0."""
    row = df.sparkSession.range(0, 1, 1, 1).select(
        *[
            F.lit(product).alias(c) if c == "product" else (money(values[c]) if c in values else zero()).alias(c)
            for c in df.columns
        ]
    )
    return df.unionByName(row)


def shipment_totals(
    shipments: DataFrame, cases: DataFrame | Sequence[int], div: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(by, product, reconciled) over a set of cases: known ids (cut at the scan) or a table of them.

    ``shipments``: product, div, reconciled, case_id."""
    used = shipments if div is None else shipments.filter(F.col("div") == div)
    if isinstance(cases, DataFrame):
        used = used.join(cases.select("case_id"), "case_id", "left_semi")
    else:
        used = used.filter(F.col("case_id").isin(list(cases)))
    return used.groupBy(*by, "product").agg(total("reconciled").alias("reconciled"))


def production_from_balance(balance: DataFrame, daily: DataFrame, month: DataFrame) -> DataFrame:
    """Production = stock + shipped - earlier stock, per day and per month; a product only shipped becomes
    a row with production = shipped (left null when the shipment is null)."""
    got = or_zero("reconciled")

    def merge(target: DataFrame, source: DataFrame, shipped: str, produced: str, earlier: str) -> DataFrame:
        return upsert_measures(
            target,
            source,
            ("product", "product"),
            {shipped: got, produced: F.col("measured") + got - F.col(earlier)},
            {shipped: got, produced: F.col("reconciled")},
            {m: 0 for m in MEASURES},
        )

    by_day = merge(balance, daily, "shipped_day", "produced_day", "measured_old")
    return merge(by_day, month, "shipped_month", "produced_month", "measured_start")


def scalar_override(df: DataFrame, product: str, totals: Mapping[str, Column]) -> DataFrame:
    """Rows of one product get measures from scalar totals (scalar subqueries: no join)."""
    return override_rows(df, F.col("product") == product, totals)


def append_system_rows(
    df: DataFrame, now: DataFrame, previous: DataFrame, opening: DataFrame
) -> DataFrame:
    """System stock (name, reconciled) as further rows; rows the earlier sets know are compared with them,
    the others keep what they have."""
    fresh = balance_rows(now.select(F.col("name").alias("product"), F.col("reconciled").alias("measured")))
    rows = df.unionByName(fresh)

    def compared(rows: DataFrame, side: DataFrame, earlier: str, produced: str) -> DataFrame:
        known = (
            side.groupBy(F.col("name").alias("product"))
            .agg(F.min("reconciled").alias("_value"))
            .withColumn("_known", F.lit(1))
        )
        hit, value = F.col("_known").isNotNull(), or_zero(money(F.col("_value")))
        new = {earlier: value, produced: money(or_zero("measured") - value)}
        return rows.join(known, "product", "left").select(
            *[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rows.columns]
        )

    return compared(
        compared(rows, previous, "measured_old", "produced_day"), opening, "measured_start", "produced_month"
    )


def role_totals(facts: DataFrame, sets: CaseSets, value: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, day_total, month_total): sums over the current case and over the month set in one pass."""
    used = facts.join(sets.flagged(facts.sparkSession), "case_id")
    return used.groupBy(*by).agg(
        total(F.when(F.col("of_day") == 1, F.col(value))).alias("day_total"),
        total(F.when(F.col("of_month") == 1, F.col(value))).alias("month_total"),
    )


def meter_adjustment(df: DataFrame, rules: DataFrame, meters: DataFrame, sets: CaseSets) -> DataFrame:
    """Adds a meter's totals to shipped and produced (day, month) of one product.

    ``rules``: product, meter_id; ``meters``: meter_id, case_id, value. A meter without values adds nothing.
    """
    per_product = (
        rules.join(role_totals(meters, sets, "value", ["meter_id"]), "meter_id")
        .groupBy("product")
        .agg(F.sum("day_total").alias("_day"), F.sum("month_total").alias("_month"))
    )
    day, month = or_zero(money(F.col("_day"))), or_zero(money(F.col("_month")))
    add = {"shipped_day": day, "produced_day": day, "shipped_month": month, "produced_month": month}
    return df.join(per_product, "product", "left").select(
        *[money(F.col(c) + add[c]).alias(c) if c in add else F.col(c) for c in df.columns]
    )


def flow_total(
    flows: DataFrame,
    values: DataFrame,
    links: DataFrame,
    objects: DataFrame,
    object_types: DataFrame,
    products: DataFrame,
    sets: CaseSets,
    source_like: str,
    product_like: str,
    ci: bool = True,
) -> DataFrame:
    """One row (day_total, month_total): reconciled flows by source-name and product-name pattern, over
    live flows, places and products; a flow counts once per live link.

    Links are reduced to a count per flow, so they multiply the value instead of the rows; everything else
    is an existence test.
    """
    alive = objects.filter(F.col("is_deleted") == 0)
    placed = alive.join(object_types.select(F.col("id").alias("object_type_id")), "object_type_id", "left_semi")
    goods = products.filter(F.col("is_deleted") == 0)
    sources = placed.filter(like_any(F.col("sf_name"), [source_like], ci))
    wanted = goods.filter(like_any(F.col("name"), [product_like], ci))

    def exists(df: DataFrame, column: str, side: DataFrame) -> DataFrame:
        return df.join(side.select(F.col("id").alias("_id")), F.col(column) == F.col("_id"), "left_semi")

    kept = exists(flows, "product_id", wanted)
    kept = exists(kept, "source_id", sources)
    kept = exists(kept, "second_product_id", goods)
    kept = exists(kept, "dest_id", placed)
    kept = exists(kept, "id", alive)
    linked = exists(links, "id", alive).groupBy("flow_id").agg(F.count(F.lit(1)).alias("_links"))
    facts = (
        values.join(sets.flagged(values.sparkSession).select("case_id"), "case_id", "left_semi")
        .join(kept.select(F.col("id").alias("_flow")), F.col("id") == F.col("_flow"))
        .join(linked, F.col("_flow") == F.col("flow_id"))
        .select("case_id", (exact("reconciled") * F.col("_links")).alias("value"))
    )
    return role_totals(facts, sets, "value")


def consolidate(df: DataFrame, members: Sequence[str], into: str, group: str | None = None) -> DataFrame:
    """Listed products are summed into one row and removed; the row is there even without members."""
    member = F.coalesce(F.col("product").isin(list(members)), F.lit(False))
    texts = {"product": F.lit(into), "group_name": F.lit(into if group is None else group)}
    merged = df.filter(member).agg(*[F.sum(c).alias(c) for c in df.columns if c not in texts])
    types = dict(df.dtypes)
    row = merged.select(*[(texts[c] if c in texts else F.col(c)).cast(types[c]).alias(c) for c in df.columns])
    return df.filter(~member).unionByName(row)


def product_summary(
    df: DataFrame, groups: DataFrame, plant: bool = False, moved: tuple[str, str] | None = None
) -> DataFrame:
    """Sums per product and group. ``groups``: product, group_name. For the whole plant one product
    (LIKE) is moved to another group. Dead residue is recomputed: measured - not issued - (passported +
    not passported), 0 when a part is null."""
    group = F.col("_group")
    if plant and moved:
        group = F.when(F.col("product").like(moved[0]), F.lit(moved[1])).otherwise(group)
    side = groups.select("product", F.col("group_name").alias("_group"))
    joined = df.drop("group_name").join(side, "product", "left").withColumn("group_name", group)
    sums = [or_zero(F.sum(m)).alias(m) for m in SUMMARY if m != "dead_residue"]
    residue = F.sum("measured") - F.sum("not_issued") - (F.sum("passported") + F.sum("not_passported"))
    return joined.groupBy("product", "group_name").agg(*sums, F.coalesce(residue, F.lit(0)).alias("dead_residue"))


def hide_empty(df: DataFrame, measures: Sequence[str] = VISIBLE, keep: str | None = None, ci: bool = True) -> DataFrame:
    """Rows with a measure other than 0, and rows whose product matches ``keep`` (LIKE)."""
    shown = F.lit(False) if keep is None else like_any(F.col("product"), [keep], ci)
    for m in measures:
        shown = shown | (F.col(m) != 0)
    return df.filter(shown)


def group_headers(
    df: DataFrame, item: str = "product", group: str = "group_name", measures: Sequence[str] = SUMMARY
) -> DataFrame:
    """Detail rows and one header row per group, named like the group; rows without a name vanish."""
    cols = [F.col(item), F.col(group)]
    rolled = df.groupingSets([cols, [cols[1]]], *cols).agg(
        F.grouping(item).alias("_header"), *[or_zero(F.sum(m)).alias(m) for m in measures]
    )
    named = rolled.withColumn(item, F.when(F.col("_header") == 1, F.col(group)).otherwise(F.col(item)))
    return named.filter(F.col(item).isNotNull()).select(item, group, *measures)


def chain_order(sorting: DataFrame, id: str = "id", after: str = "after_id") -> DataFrame:
    """Adds ``sort_order``: depth in the "comes after" list, roots 1; rows not reachable from a root absent.

    Pointer doubling: every round each row jumps to its predecessor's predecessor, so a list of any depth
    takes log2(depth) equi-joins. The state of a round is stored in the shared folder, which cuts the
    lineage. A row whose predecessor does not exist is dropped with all that follow it. As long as a list
    is being followed every round resolves a row; when one resolves none, only cycles are left.
    """
    start = sorting.select(
        F.col(id).alias("_id"),
        F.col(after).alias("_to"),
        F.lit(1).cast("bigint").alias("_depth"),
    )
    state, waiting = start, None
    while True:
        jump = state.select(F.col("_id").alias("_p"), F.col("_to").alias("_next"), F.col("_depth").alias("_more"))
        ahead = state.join(jump, F.col("_to") == F.col("_p"), "left")
        # _depth null: leads nowhere
        reached = F.when(F.col("_to").isNull(), F.col("_depth")).otherwise(F.col("_depth") + F.col("_more"))
        state = staged(ahead.select("_id", F.col("_next").alias("_to"), reached.alias("_depth")), "chain")
        before, waiting = waiting, state.filter(F.col("_to").isNotNull()).count()
        if waiting in (0, before):
            break
    order = state.filter(F.col("_to").isNull() & F.col("_depth").isNotNull()).select(F.col("_id").alias(id), F.col("_depth").alias("sort_order"))
    return sorting.join(order, id)


def attach_order(df: DataFrame, sorting: DataFrame, chain: DataFrame) -> DataFrame:
    """Adds sort_id and sort_order by product name; names without a place in the order get null."""
    ids = sorting.select(F.col("name").alias("product"), F.col("id").alias("sort_id"))
    order = chain.select(F.col("id").alias("sort_id"), "sort_order")
    return (
        df.filter(F.col("product").isNotNull())
        .join(ids, "product", "left")
        .join(order, "sort_id", "left")
        .select(*df.columns, "sort_id", "sort_order")
        .distinct()
    )


def relabel_groups(df: DataFrame, systems: DataFrame) -> DataFrame:
    """Rows the system table names take its group. ``systems``: name, group_name."""
    known = first_per_key(systems.select("name", "group_name"), ["name"], [F.col("group_name")]).select(
        F.col("name").alias("product"), F.col("group_name").alias("_group"), F.lit(1).alias("_known")
    )
    taken = F.when(F.col("_known").isNotNull(), F.col("_group")).otherwise(F.col("group_name"))
    return df.join(known, "product", "left").select(
        *[taken.alias(c) if c == "group_name" else F.col(c) for c in df.columns]
    )


def fold_into_header(
    df: DataFrame,
    pattern: str,
    measures: Mapping[str, str] | None = None,
    ci: bool = True,
) -> DataFrame:
    """Header rows (product = group) gain their group's total over rows matching ``pattern``.

    ``measures``: measure -> measure whose total is added. By default the daily total goes to both the
    daily and the month production.
    """
    measures = measures or {"produced_day": "produced_day", "produced_month": "produced_day"}
    sources = sorted(set(measures.values()))
    totals = (
        df.filter(like_any(F.col("product"), [pattern], ci))
        .groupBy(F.col("group_name").alias("_group"))
        .agg(*[F.sum(m).alias(f"_{m}") for m in sources])
    )
    header = F.col("product") == F.col("group_name")
    types = dict(df.dtypes)
    joined = df.join(totals, header & (F.col("product") == F.col("_group")), "left")

    def new(c: str) -> Column:
        raised = F.col(c) + F.coalesce(F.col(f"_{measures[c]}"), F.lit(0))
        return F.when(header, raised).otherwise(F.col(c)).cast(types[c]).alias(c)

    return joined.select(*[new(c) if c in measures else F.col(c) for c in df.columns])
