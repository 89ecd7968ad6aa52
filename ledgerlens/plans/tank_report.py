"""The tank balance report: stock, production and shipment per product, with groups and order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import rows_table
from ..operators import report as Rep
from ..operators import stock as St
from ..operators.blends import Blend, blend_balance, ledger_sums
from ..operators.ledger import override_rows
from ..operators.periods import CaseSets, resolve_case_sets
from ..sources.catalog import Catalog
from ..sources.session import staged


@dataclass(frozen=True)
class ReportRules:
    """Configuration of the report. Names, patterns and ids are data."""

    scope: St.ScopeRules
    names: St.NameRules
    topup_names: St.NameRules
    supply_product: str  # production of this product is the scalar supply
    processed_name: str  # row for the processed quantity
    flow_name: str  # row for the flow total
    flow_source: str  # LIKE on the source place
    flow_product: str  # LIKE on the product
    full_division: str | None = None  # the division that sees the plant-wide blocks too
    blends: Sequence[Blend] = ()
    meter_rules: Sequence[tuple[str, int]] = ()
    consolidated: Sequence[str] = ()
    consolidated_into: str | None = None
    moved: tuple[str, str] | None = None
    blend_mark: str = "%blend%"
    system_mark: str = "%system%"
    corrected: Sequence[str] = field(default_factory=tuple)  # blend rows without dead residue and not issued


def stock_by_case(catalog: Catalog, sets: CaseSets, rules: ReportRules, divs: Sequence[str | None]) -> DataFrame:
    """Tank balance of the compared cases in one pass, topped up for a division."""
    div = divs[0] if divs else None
    positions = catalog.within("positions", sets.span).filter(F.col("case_id").isin(sets.snapshots))
    described = St.described_positions(positions, catalog["objects"], catalog["products"])
    scoped = St.tank_scope(described, catalog["layers"], rules.scope, *divs)
    balance = St.tank_balance(scoped, rules.names, catalog["product_names"], rules.scope, by=["case_id"])
    if div is None:
        return balance
    totals = St.warehouse_totals(
        described, catalog["layers"], rules.topup_names, catalog["product_names"], rules.scope, by=["case_id"]
    )
    return St.warehouse_topup(balance, totals, div, rules.scope, by=["case_id"])


def _totals(both: DataFrame) -> dict:
    """Day and month production out of a one-row total, as scalar subqueries."""
    return {
        "produced_day": both.select("day_total").scalar(),
        "produced_month": both.select("month_total").scalar(),
    }


def _of_case(df: DataFrame, case_id: int | None) -> DataFrame:
    return df.filter(F.col("case_id") == F.lit(case_id).cast("int"))


def tank_report(
    catalog: Catalog,
    case_id: int,
    rules: ReportRules,
    divs: Sequence[str | None] = (None, None, None),
) -> DataFrame:
    """Catalog roles: cases (with is_cumulative), positions, objects, object_types, products, layers,
    product_names, shipments(product, div, reconciled, case_id), supply / processed /
    processed_month (case_id, value), systems(name, group_name, reconciled, case_id), meters, flows,
    flow_values, links, ledger, arrivals(product, measured, case_id), groups, sorting.
    """
    div = divs[0] if divs else None
    plant = div is None
    sets = resolve_case_sets(catalog["cases"], case_id)

    # stock of the three cases in one pass, then what was shipped
    balances = stock_by_case(catalog, sets, rules, divs)
    rows = Rep.balance_rows(St.snapshots_by_role(balances, sets, plant))
    shipped = catalog.within("shipments", sets.span)
    daily = Rep.shipment_totals(shipped, [sets.current], div)
    month = Rep.shipment_totals(shipped, sets.months(catalog.spark), div)
    rows = Rep.production_from_balance(rows, daily, month)
    rows = Rep.scalar_override(rows, rules.supply_product, _totals(Rep.role_totals(catalog.within("supply", sets.span), sets, "value")))
    if plant or div == rules.full_division:
        rows = _plant_blocks(catalog, rows, sets, rules)
    # one row per product from here on: the scans above are done once, whatever follows
    rows = staged(rows, "balance")

    if rules.consolidated_into is not None:
        rows = Rep.consolidate(rows, rules.consolidated, rules.consolidated_into)
    summary = Rep.product_summary(rows, catalog["groups"], plant, rules.moved)
    grouped = Rep.group_headers(Rep.hide_empty(summary, keep=rules.blend_mark))
    ordered = Rep.attach_order(grouped, catalog["sorting"], Rep.chain_order(catalog["sorting"]))
    systems = catalog.within("systems", sets.span).join(sets.months(catalog.spark), "case_id", "left_semi")
    labelled = Rep.relabel_groups(ordered, systems)
    folded = Rep.fold_into_header(labelled, rules.system_mark)
    corrected = override_rows(
        folded, F.col("product").isin(list(rules.corrected)), {"dead_residue": 0, "not_issued": 0}
    )
    return corrected.orderBy(F.asc_nulls_last("sort_order"))


def _plant_blocks(catalog: Catalog, rows: DataFrame, sets: CaseSets, rules: ReportRules) -> DataFrame:
    systems = catalog.within("systems", sets.span)
    rows = Rep.append_system_rows(
        rows, *[_of_case(systems, c) for c in (sets.current, sets.previous, sets.opening)]
    )
    processed = catalog.within("processed_month" if sets.is_cumulative else "processed", sets.span)
    rows = Rep.literal_row(rows, rules.processed_name, _totals(Rep.role_totals(processed, sets, "value")))
    if rules.meter_rules:
        meter_rules = rows_table(catalog.spark, "product string, meter_id int", rules.meter_rules)
        rows = Rep.meter_adjustment(rows, meter_rules, catalog.within("meters", sets.span), sets)
    flows = Rep.flow_total(
        catalog["flows"], catalog.within("flow_values", sets.span), catalog["links"], catalog["objects"], catalog["object_types"],
        catalog["products"], sets, rules.flow_source, rules.flow_product,
    )
    rows = Rep.literal_row(rows, rules.flow_name, _totals(flows))
    if rules.blends:
        sums = ledger_sums(rules.blends, catalog["ledger"], sets.current, sets.opening)
        arrived = Rep.role_totals(catalog.within("arrivals", sets.span), sets, "measured", ["product"])
        rows = blend_balance(rows, rules.blends, sums, arrived, not sets.is_cumulative)
    return rows
