"""Tank stock per product: naming, scope, balance, warehouse top-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import all_whole, exact, exact_sum, money, nearest, or_zero, total
from ..functions.rules import first_match
from ..functions.text import folded, like_any, one_of
from .periods import CaseSets

STOCK_MEASURES = "measured passported not_passported not_issued dead_residue free_volume".split()
AMOUNTS = "measured mass_without_dr dead_residue_mass free_volume".split()  # of a position


@dataclass(frozen=True)
class NameRules:
    """Ordered naming rules: places and exact names first, then the marker, then the mapping table.

    ``ordered``: dicts with any of place (LIKE), not_place (LIKE), product (exact) and the label.
    """

    ordered: Sequence[Mapping[str, str]] = ()
    obsolete_marker: str | None = None
    ci: bool = True


@dataclass(frozen=True)
class ScopeRules:
    """Which positions count. All names and patterns are the caller's."""

    plant_layer: str
    warehouse: str  # LIKE pattern of warehouse places
    system_name: str  # LIKE pattern of object names left out
    empty_product: str
    excluded_products: Sequence[str] = ()  # LIKE, always out
    lifted_products: Sequence[str] = ()  # LIKE, out unless at a lifted place of the special division
    lifted_places: Sequence[str] = ()
    special_division: str | None = None
    special_places: Sequence[str] = ()  # count for the special division whatever their layer
    special_barred: Sequence[str] = ()  # exact products barred for the special division
    first_group: Sequence[str] = ()  # products counted under grouping codes 1..., all others under 2...
    bulk_products: Sequence[str] = ()  # never passported, always "not passported"
    issued_products: Sequence[str] = ()  # never "not issued"
    passported_state: str = "p"
    topup_excluded: Sequence[str] = ()  # LIKE, further products left out of the top-up
    topup_excluded_places: Sequence[str] = ()
    topup_barred_division: str | None = None
    ci: bool = True


class _Here:
    """Conditions on the names of a position, judged row by row."""

    def like(self, col: str, patterns: Sequence[str], ci: bool) -> Column:
        return self.kept(col, ("like", tuple(patterns), ci), like_any(F.col(col), patterns, ci))

    def among(self, col: str, values: Sequence[str], ci: bool) -> Column:
        return self.kept(col, ("among", tuple(values), ci), one_of(F.col(col), values, ci))

    def kept(self, col: str, key: tuple, value: Column) -> Column:
        return value


class _Ahead(_Here):
    """The same conditions, gathered by the column they are about: every tank and every product is judged once, before
    the positions are joined to them, however many positions there are."""

    def __init__(self) -> None:
        self.found: dict[tuple, tuple[str, Column]] = {}

    def kept(self, col: str, key: tuple, value: Column) -> Column:
        return F.col(self.found.setdefault((col, key), (f"_{col}_{len(self.found)}", value))[0])

    def on(self, df: DataFrame) -> DataFrame:
        """``df`` with what was gathered about its columns."""
        return df.select("*", *[v.alias(n) for (c, _), (n, v) in self.found.items() if c in df.columns])


_HERE = _Here()


def _mapped(df: DataFrame, mapping: DataFrame, product: str, ci: bool, out: str) -> DataFrame:
    """``df`` with the name the mapping gives, null where it has none."""
    side = (
        mapping.select(folded(F.col("source_name"), ci).alias("_source"), F.col("canonical_name").alias(out))
        .groupBy("_source")
        .agg(F.min(out).alias(out))
    )
    return df.join(side, folded(F.col(product), ci) == F.col("_source"), "left").drop("_source")


def _canonical(rules: NameRules, product: str, place: str | None, mapped: str, at: _Here = _HERE) -> Column:
    """The canonical name of a position whose product the mapping has named ``mapped``."""
    name, branches, rest = F.col(product), [], []
    for rule in rules.ordered:
        cond = F.lit(True)
        if "place" in rule:
            cond = cond & at.like(place, [rule["place"]], rules.ci)
        if "not_place" in rule:
            cond = cond & ~at.like(place, [rule["not_place"]], rules.ci)
        if "product" in rule:
            cond = cond & at.among(product, [rule["product"]], rules.ci)
        branches.append((cond, F.lit(rule["label"])))
    if rules.obsolete_marker:
        marker = F.lit(rules.obsolete_marker)
        rest.append((F.locate(rules.obsolete_marker, name) > 0, F.trim(F.replace(name, marker, F.lit("")))))
    rest.append((F.col(mapped).isNotNull(), F.col(mapped)))
    return first_match(branches, at.kept(product, ("name", rules.obsolete_marker, mapped), first_match(rest, name)))


def canonical_product(
    df: DataFrame,
    rules: NameRules,
    mapping: DataFrame,
    product: str = "product",
    place: str | None = "place",
    out: str = "canonical",
) -> DataFrame:
    """Adds the canonical product name. ``mapping``: source_name, canonical_name."""
    joined = _mapped(df, mapping, product, rules.ci, "_mapped")
    return joined.withColumn(out, _canonical(rules, product, place, "_mapped")).drop("_mapped")


def _live(objects: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Live tanks (object_id, place, object_name) and live products (product_id, product)."""
    tanks = objects.filter(F.col("is_deleted") == 0).select(
        F.col("id").alias("object_id"), F.col("sf_name").alias("place"), F.col("name").alias("object_name")
    )
    goods = products.filter(F.col("is_deleted") == 0).select(
        F.col("id").alias("product_id"), F.col("name").alias("product")
    )
    return tanks, goods


def described_positions(positions: DataFrame, objects: DataFrame, products: DataFrame) -> DataFrame:
    """Positions of live tanks and live products with place, object_name and product."""
    tanks, goods = _live(objects, products)
    return positions.join(tanks, "object_id").join(goods, "product_id")


def _grouping_ok(rules: ScopeRules, at: _Here = _HERE) -> Column:
    first = at.among("product", rules.first_group, rules.ci)
    code = F.col("grouping")
    return (
        (first & code.like("1%")) | (~first & code.like("2%")) | code.isNull() | (code == "")
    )


def _in_store(rules: ScopeRules, at: _Here = _HERE) -> Column:
    return F.col("number_park").isNotNull() | at.like("place", [rules.warehouse], rules.ci)


def _real(rules: ScopeRules, at: _Here = _HERE) -> Column:
    return ~at.like("object_name", [rules.system_name], rules.ci) & ~at.like("product", [rules.empty_product], rules.ci)


def _common(rules: ScopeRules, at: _Here = _HERE) -> Column:
    """What holds for the positions of every set."""
    return ~at.like("product", rules.excluded_products, rules.ci) & _in_store(rules, at) & _real(rules, at)


def _counts(rules: ScopeRules, in_layer: Column, div: str | None, at: _Here = _HERE) -> Column:
    """Whether a described position counts for a division; the parameters are known, so there are no null tests."""
    special = div is not None and div == rules.special_division
    lifted = ~at.like("product", rules.lifted_products, rules.ci)
    counted = in_layer & _grouping_ok(rules, at)
    if special:
        lifted = lifted | at.like("place", rules.lifted_places, rules.ci)
        counted = counted | at.like("place", rules.special_places, rules.ci)
    keep = lifted & counted
    return keep & ~at.among("product", rules.special_barred, rules.ci) if special and rules.special_barred else keep


def _members(layers: DataFrame, rules: ScopeRules, divisions: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """object_id and ``_in0``, ``_in1``, ...: whether a tank is in one of the layers of each set of divisions."""
    wanted = [
        [rules.plant_layer if (divs[0] if divs else None) is None else divs[0], *[d for d in divs[1:] if d is not None]]
        for divs in divisions.values()
    ]
    return layers.groupBy("object_id").agg(
        *[F.max(one_of(F.col("layer"), layer, rules.ci)).alias(f"_in{i}") for i, layer in enumerate(wanted)]
    )


def tank_scopes(
    described: DataFrame,
    layers: DataFrame,
    rules: ScopeRules,
    divisions: Mapping[str, Sequence[str | None]],
    name: str = "division",
) -> DataFrame:
    """Positions that count for each of several sets of up to three divisions, under the set's ``name``; a
    position that counts for several sets stands under each.

    ``layers``: object_id, layer. They are reduced to one row per tank (in one of a set's layers or not), so
    a tank in several layers never fans out, and the positions are read once for all sets.
    """
    member = _members(layers, rules, divisions)
    named = [
        F.when(_counts(rules, F.col(f"_in{i}"), divs[0] if divs else None), F.lit(n))
        for i, (n, divs) in enumerate(divisions.items())
    ]
    return (
        described.filter(_common(rules))
        .join(member, "object_id")
        .withColumn(name, F.explode(F.array_compact(F.array(*named))))
        .drop(*[f"_in{i}" for i in range(len(divisions))])
    )


def tank_scope(
    described: DataFrame,
    layers: DataFrame,
    rules: ScopeRules,
    div: str | None = None,
    second: str | None = None,
    third: str | None = None,
) -> DataFrame:
    """Positions that count for up to three divisions, or for the whole plant when none is given."""
    return tank_scopes(described, layers, rules, {"": (div, second, third)}, "_set").drop("_set")


def tank_balance(
    scoped: DataFrame, names: NameRules, mapping: DataFrame, rules: ScopeRules, by: Sequence[str] = ()
) -> DataFrame:
    """Per canonical product (and ``by``, for several cases in one pass): stock, passported, not passported,
    not issued, dead residue, free volume. Equal tank rows count once."""
    named = canonical_product(scoped, names, mapping)
    measures = [m.alias(c) for c, m in _measures(rules, _amount(named)).items()]
    rows = named.select(*by, "place", F.col("canonical").alias("product"), *measures).distinct()
    return rows.groupBy(*by, "product").agg(*[total(m).alias(m) for m in STOCK_MEASURES])


def _amount(df: DataFrame):
    """How amounts are told apart: as exact decimals or, where all are doubles, as the doubles nearest to these.

    Equal decimals have one nearest double, and different decimals that come from doubles have different ones: where doubles are denser
    than 12 places, decimals are further apart than doubles, elsewhere the double itself comes back. Rows with doubles are grouped at a
    small part of the cost of rows with long decimals; what is summed are the decimals.
    """
    types = dict(df.dtypes)
    return nearest if all(types[c] == "double" for c in AMOUNTS) else exact


def _measures(rules: ScopeRules, amount, at: _Here = _HERE) -> dict[str, Column]:
    """The amounts of one position, by ``STOCK_MEASURES``."""
    bulk = at.among("product", rules.bulk_products, rules.ci)
    stock, lean, nothing = amount("measured"), amount("mass_without_dr"), amount(F.lit(0.0))
    passed = F.col("passport_state") == rules.passported_state
    open_state = (F.col("passport_state") != rules.passported_state) | F.col("passport_state").isNull()
    waiting = at.like("place", [rules.warehouse], rules.ci) & ~at.among("product", rules.issued_products, rules.ci)
    return {
        "measured": stock,
        "passported": F.when(bulk, nothing).when(passed, lean).otherwise(nothing),
        "not_passported": F.when(bulk, stock).when(open_state, lean).otherwise(nothing),
        "not_issued": F.when(waiting, stock).otherwise(nothing),
        "dead_residue": amount("dead_residue_mass"),
        "free_volume": amount("free_volume"),
    }


def _in_warehouse(rules: ScopeRules, at: _Here = _HERE) -> Column:
    """Positions of the top-up: warehouse places that hold something of a product that counts."""
    return (
        ~at.like("product", [*rules.excluded_products, *rules.lifted_products, *rules.topup_excluded], rules.ci)
        & at.like("place", [rules.warehouse], rules.ci)
        & ~at.like("place", rules.topup_excluded_places, rules.ci)
        & _real(rules, at)
        & (F.col("measured") > 0)
        & _grouping_ok(rules, at)
    )


def _set_sums(
    positions: DataFrame,
    objects: DataFrame,
    products: DataFrame,
    layers: DataFrame,
    names: NameRules,
    mapping: DataFrame,
    rules: ScopeRules,
    divisions: Mapping[str, Sequence[str | None]],
    by: Sequence[str],
    division: str,
    short: NameRules | None = None,
) -> DataFrame:
    """The sums of ``tank_balance`` for several sets of divisions and, where ``short`` names its products, for the warehouse as one more
    (``_held``, without a division).

    Tanks and products are judged and named before the positions are joined to them, so a position costs two joins and no pattern.
    A position goes on as one row with a flag for each set it counts for (and another one for the warehouse): equal rows become one
    whose flags are those of any, and sums by the flags are dealt to the sets.
    """
    at, no = _Ahead(), F.lit(False)
    inside = {f"_set{i}": F.coalesce(_common(rules, at) & _counts(rules, F.col(f"_in{i}"), d[0] if d else None, at), no) for i, d in enumerate(divisions.values())}
    flags = [*inside]
    held = F.coalesce(_in_warehouse(rules, at), no) if short else no
    titles = {n: _canonical(r, "product", "place", f"_mapped_{r.ci}", at) for n, r in (("_name", names), ("_short", short or names))}
    amount = _amount(positions)
    measures = _measures(rules, lambda c: F.col(c) if isinstance(c, str) else amount(c), at)
    if amount is nearest:  # told before the joins: their step stays small enough to be compiled
        positions = positions.withColumn("_whole", all_whole(AMOUNTS))
    tanks, goods = _live(objects, products)
    for ci in {names.ci, (short or names).ci}:
        goods = _mapped(goods, mapping, "product", ci, f"_mapped_{ci}")
    tanks = tanks.join(_members(layers, rules, divisions), "object_id")
    used = positions.join(at.on(tanks), "object_id").join(at.on(goods), "product_id").withColumns({**inside, "_kept": held, **titles})
    anywhere = reduce(or_, [F.col(f) for f in flags], no)
    used = used.filter(_common(rules, at)).filter(anywhere | F.col("_kept"))  # the first holds in the warehouse too, and reaches both sides
    used = used.withColumns({c: nearest(c, F.col("_whole")) if amount is nearest else amount(c) for c in AMOUNTS})  # read by the measures, once a row
    laid = used.select(*by, "place", "_name", "_short", *flags, "_kept", *[m.alias(c) for c, m in measures.items()])
    laid = laid.withColumn("_held", F.explode(F.array_compact(F.array(F.when(anywhere, no), F.when(F.col("_kept"), F.lit(True)))))) if short else laid.withColumn("_held", no)
    stored = F.col("_held")
    # in the warehouse equal amounts of a product count once, whatever the tank: there the amount is all that tells rows apart
    rows = laid.select(
        *by, "_held",
        F.when(~stored, F.col("place")).alias("place"),
        F.when(stored, F.col("_short")).otherwise(F.col("_name")).alias("product"),
        *[F.col(c) if c == "measured" else F.when(~stored, F.col(c)).alias(c) for c in STOCK_MEASURES],
        *[(~stored & F.col(f)).alias(f) for f in flags],
    )
    once = rows.groupBy(*by, "_held", "place", "product", *STOCK_MEASURES).agg(*[F.max(f).alias(f) for f in flags])
    types = dict(once.dtypes)
    added = {m: exact_sum(m) if types[m] == "double" else F.sum(exact(m)) for m in STOCK_MEASURES}
    sums = once.groupBy(*by, "product", "_held", *flags).agg(*[v.alias(m) for m, v in added.items()])
    sets = [F.when(F.col(f), F.struct(F.lit(n).alias("set"))) for f, n in zip(flags, divisions)]
    sets.append(F.when(stored, F.struct(F.lit(None).cast("string").alias("set"))))
    dealt = sums.withColumn("_s", F.explode(F.array_compact(F.array(*sets)))).withColumn(division, F.col("_s.set"))
    return dealt.groupBy(*by, "product", division, "_held").agg(*[total(m).alias(m) for m in STOCK_MEASURES])


def division_balances(
    positions: DataFrame,
    objects: DataFrame,
    products: DataFrame,
    layers: DataFrame,
    names: NameRules,
    mapping: DataFrame,
    rules: ScopeRules,
    divisions: Mapping[str, Sequence[str | None]],
    by: Sequence[str] = (),
    division: str = "division",
) -> DataFrame:
    """What ``described_positions``, ``tank_scopes`` and ``tank_balance`` (by the set's name too) give one after the other, in one pass."""
    return _set_sums(positions, objects, products, layers, names, mapping, rules, divisions, by, division).drop("_held")


def warehouse_totals(
    described: DataFrame,
    layers: DataFrame,
    names: NameRules,
    mapping: DataFrame,
    rules: ScopeRules,
    by: Sequence[str] = (),
    distinct: bool = True,
) -> DataFrame:
    """Per product (short naming rules) the stock of warehouse tanks that hold something.

    Equal amounts of one product count once (``distinct``); turn it off to count every tank.
    """
    held = described.filter(_in_warehouse(rules)).join(layers.select("object_id").distinct(), "object_id", "left_semi")
    named = canonical_product(held, names, mapping).withColumn("_stock", exact("measured"))
    amount = F.sum_distinct("_stock") if distinct else F.sum("_stock")
    return named.groupBy(*by, F.col("canonical").alias("product")).agg(money(amount).alias("warehouse"))


def warehouse_topup(
    balance: DataFrame,
    totals: DataFrame | None,
    div: str | None,
    rules: ScopeRules,
    by: Sequence[str] = (),
    division: str | None = None,
    plant: str = "PLANT",
) -> DataFrame:
    """Matched products: not issued = warehouse stock, measured grows by it. Nothing without a division.

    With ``division``, a column that names the set each row belongs to (``plant``: no division), balances of
    several sets are topped up at once.
    """
    if totals is None or division is None and (div is None or div == rules.topup_barred_division):
        return balance
    joined = balance.join(totals, [*by, "product"], "left")
    hit = F.col("warehouse").isNotNull()
    if division is not None:
        hit = hit & ~F.col(division).isin([d for d in (plant, rules.topup_barred_division) if d is not None])
    return joined.select(*[_raised(hit).get(c, F.col(c)).alias(c) for c in balance.columns])


def _raised(hit: Column) -> dict[str, Column]:
    return {
        "not_issued": F.when(hit, F.col("warehouse")).otherwise(F.col("not_issued")),
        "measured": F.when(hit, money(F.col("measured") + F.col("warehouse"))).otherwise(F.col("measured")),
    }


def topped_up_balances(
    positions: DataFrame,
    objects: DataFrame,
    products: DataFrame,
    layers: DataFrame,
    names: NameRules,
    short: NameRules,
    mapping: DataFrame,
    rules: ScopeRules,
    divisions: Mapping[str, Sequence[str | None]],
    by: Sequence[str],
    division: str = "division",
    plant: str = "PLANT",
) -> DataFrame:
    """The balances of several sets of divisions, topped up from the warehouse, out of one reading of the positions.

    What ``division_balances``, ``warehouse_totals`` (by the naming rules ``short``) and ``warehouse_topup`` give one after
    the other: the warehouse is one more set of the same aggregation, whose sums reach the others by product.
    """
    sums = _set_sums(positions, objects, products, layers, names, mapping, rules, divisions, by, division, short)
    held = F.col("_held")
    stored = F.max(F.when(held, F.col("measured"))).over(Window.partitionBy(*by, "product"))
    joined = sums.withColumn("warehouse", stored).filter(~held)
    hit = F.col("warehouse").isNotNull() & ~F.col(division).isin([d for d in (plant, rules.topup_barred_division) if d is not None])
    return joined.select(*by, "product", *[_raised(hit).get(c, F.col(c)).alias(c) for c in STOCK_MEASURES], division)


def compare_snapshots(cur: DataFrame, prev: DataFrame, opening: DataFrame) -> DataFrame:
    """Adds measured_old / produced_day against the previous case and measured_start / produced_month
    against the month opening; a product absent there counts as 0."""
    old = prev.select("product", F.col("measured").alias("_old"))
    start = opening.select("product", F.col("measured").alias("_start"))
    joined = cur.join(old, "product", "left").join(start, "product", "left")
    return joined.withColumns(_differences("measured")).drop("_old", "_start")


def _differences(current: str) -> dict[str, Column]:
    old, start = or_zero("_old"), or_zero("_start")
    return {
        "measured_old": old,
        "produced_day": money(or_zero(current) - old),
        "measured_start": start,
        "produced_month": money(or_zero(current) - start),
    }


def append_missing_opening(cur: DataFrame, opening: DataFrame) -> DataFrame:
    """Rows for products only present at month opening: the opening value and its negative as produced."""
    gone = opening.join(cur.select("product"), "product", "left_anti")
    types = dict(cur.dtypes)
    start = or_zero("measured")
    values = {"product": F.col("product"), "measured_start": start, "produced_month": money(-start)}
    fresh = gone.select(
        *[
            values.get(c, F.lit(None if types[c] == "string" else 0)).cast(types[c]).alias(c)
            for c in cur.columns
        ]
    )
    return cur.unionByName(fresh)


def snapshots_by_role(balances: DataFrame, sets: CaseSets, plant: bool) -> DataFrame:
    """The comparison of all three snapshots in one pass over the balances of their cases.

    ``balances``: case_id, product, measures of the cases in ``sets``. Conditional aggregates pivot the roles, instead of three balances joined to each other. Products
    without a current row appear only for the whole plant and only if the opening knows them.
    """

    def of(case_id: int | None, value: Column) -> Column:
        return F.max(F.when(F.col("case_id") == F.lit(case_id).cast("int"), value))

    wide = (
        balances.filter(F.col("case_id").isin(sets.snapshots))
        .groupBy("product")
        .agg(
            of(sets.current, F.lit(1)).alias("_now"),
            of(sets.opening, F.lit(1)).alias("_opened"),
            *[of(sets.current, F.col(m)).alias(m) for m in STOCK_MEASURES],
            of(sets.previous, F.col("measured")).alias("_old"),
            of(sets.opening, F.col("measured")).alias("_start"),
        )
    )
    now = F.col("_now").isNotNull()
    kept = wide.filter(now | F.col("_opened").isNotNull()) if plant else wide.filter(now)
    compared = kept.withColumns(_differences("measured"))
    return compared.select(
        "product",
        *[F.when(now, F.col(m)).otherwise(or_zero(m)).alias(m) for m in STOCK_MEASURES],
        *[
            F.when(now, F.col(c)).otherwise(or_zero(F.lit(None))).alias(c)
            for c in ("measured_old", "produced_day")
        ],
        "measured_start",
        "produced_month",
    )
