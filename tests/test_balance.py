import random
import re
from decimal import Decimal

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.functions import amounts
from ledgerlens.operators import report as Rep
from ledgerlens.operators import stock as St
from ledgerlens.operators.blends import blend_balance, ledger_sums
from ledgerlens.operators.periods import CaseSets
from ledgerlens.plans import presets

SETS = CaseSets(3, 2, 1, (2, 3), False)
SCOPE = St.ScopeRules(
    plant_layer="Plant",
    warehouse="%WH%",
    system_name="%system%",
    empty_product="Empty",
    excluded_products=("%recycled%",),
    lifted_products=("%water%",),
    lifted_places=("%WH_Additive%",),
    special_division="North",
    special_places=("%WH_Additive%",),
    special_barred=("fraction",),
    first_group=("sulphur",),
    bulk_products=("Sulphur", "COKE"),
    issued_products=("dye",),
    topup_barred_division="South",
)
NAMES = St.NameRules(
    ordered=(
        {"place": "%Shop 8%", "label": "Shop 8"},
        {"not_place": "%Shop 8%", "product": "slops", "label": "caught"},
        {"product": "DIESEL mid", "label": "diesel part"},
    ),
    obsolete_marker="(OLD)",
)
POSITION = (
    "object_id int, case_id int, product string, place string, object_name string, measured double, mass_without_dr double, "
    "dead_residue_mass double, free_volume double, passport_state string, number_park string, grouping string"
)


def position(id, product, measured=10.0, lean=8.0, place="T_1", name="tank", state="p", park="1", grouping=None, case=3):
    return (id, case, product, place, name, measured, lean, 2.0, 5.0, state, park, grouping)


def mapping(table):
    return table("source_name string, canonical_name string", ("Mapped", "canon"), ("old thing (OLD)", "never"))


def test_canonical_product_order(table):
    rows = table(
        "n int, product string, place string",
        (1, "slops", "x Shop 8 y"), (2, "slops", "T_1"), (3, "Diesel MID", "T_1"), (4, " old thing (OLD)", "T_1"),
        (5, "mapped", "T_1"), (6, "own", "T_1"), (7, "slops", None),
    )
    out = St.canonical_product(rows, NAMES, mapping(table))
    assert tuples(out, "n", "canonical") == [
        (1, "Shop 8"), (2, "caught"), (3, "diesel part"), (4, "old thing"), (5, "canon"), (6, "own"), (7, "slops"),
    ]


def test_tank_scope(table):
    layers = table("object_id int, layer string", *[(i, "Plant") for i in range(1, 30)], (1, "North"), (2, "South"), (1, "South"))
    rows = table(
        POSITION,
        position(1, "oil"), position(2, "recycled oil"), position(3, "water"), position(4, "oil", park=None),
        position(5, "oil", park=None, place="WH 1"), position(6, "oil", name="System tank"), position(7, "EMPTY"),
        position(8, "Sulphur", grouping="10"), position(9, "sulphur", grouping="20"), position(10, "oil", grouping="10"),
        position(11, "oil", grouping="20"), position(12, "oil", grouping=""), position(99, "oil"),
    )

    def kept(*divs):
        return [r[0] for r in sorted(tuples(St.tank_scope(rows, layers, SCOPE, *divs), "object_id"))]

    assert kept() == [1, 5, 8, 11, 12]  # once each, however many layers
    assert kept("South") == [1]
    assert kept("East", None, "North") == [1]
    special = table(
        POSITION,
        position(3, "water", place="WH_Additive 1"), position(4, "fraction", place="WH_Additive 2"),
        position(5, "dye", place="WH_Additive 3", grouping="77"), position(1, "oil"),
    )
    north = St.tank_scope(special, layers, SCOPE, "North")
    assert tuples(north, "object_id") == [(1,), (3,), (5,)]  # additive places whatever their layer; barred product out


def test_tank_balance_measures_and_distinct(table):
    rows = table(
        POSITION,
        position(1, "oil"), position(2, "oil", state="x"), position(3, "oil", state=None, place="T_2"),
        position(3, "oil", state=None, place="T_2"),  # the same tank row twice
        position(4, "Coke", state="p"), position(5, "oil", place="WH 1"), position(6, "dye", place="WH 1"),
    )
    out = St.tank_balance(rows, NAMES, mapping(table), SCOPE)
    got = {r[0]: tuple(float(x) for x in r[1:]) for r in tuples(out, "product", *St.STOCK_MEASURES)}
    assert got == {
        "oil": (40.0, 16.0, 16.0, 10.0, 8.0, 20.0),
        "Coke": (10.0, 0.0, 10.0, 0.0, 2.0, 5.0),
        "dye": (10.0, 8.0, 0.0, 0.0, 2.0, 5.0),
    }


def test_warehouse_topup_counts_equal_amounts_once(table):
    layers = table("object_id int, layer string", (1, "Plant"), (2, "Plant"), (3, "Plant"), (4, "Plant"))
    held = table(
        POSITION, position(1, "oil", place="WH 1"), position(2, "oil", place="WH 2"), position(3, "oil", 4.0, place="WH 3"),
        position(4, "gas", 0.0, place="WH 3"), position(9, "oil", 100.0, place="WH 9"),
    )
    balance = table("product string, measured decimal(18,3), not_issued decimal(18,3)", ("oil", Decimal(50), Decimal(1)), ("gas", Decimal(1), Decimal(1)))
    totals = St.warehouse_totals(held, layers, NAMES, mapping(table), SCOPE)
    every = St.warehouse_totals(held, layers, NAMES, mapping(table), SCOPE, distinct=False)
    assert tuples(totals, "warehouse") == [(Decimal("14.000"),)] and tuples(every, "warehouse") == [(Decimal("24.000"),)]
    out = St.warehouse_topup(balance, totals, "North", SCOPE)
    assert tuples(out, "product", "measured", "not_issued") == [
        ("gas", Decimal("1.000"), Decimal("1.000")), ("oil", Decimal("64.000"), Decimal("14.000")),
    ]
    for untouched in (None, "South"):
        assert St.warehouse_topup(balance, totals, untouched, SCOPE) is balance


SIDES = ("id int, sf_name string, name string, is_deleted int", "id int, name string, is_deleted int")
SETS_OF = {"PLANT": (None, None, None), "North": ("North", None, None), "South": ("South", "North", None)}


@pytest.fixture
def tanks(spark, table):
    """Positions, tanks, products and layers out of all sorts of names, with nulls, repeated rows and shared places."""
    rng = random.Random(3)
    places = ["WH 1", "WH_Additive 2", "x Shop 8", "T_1", "T_2", None]
    goods = ["oil", "recycled oil", "water", "Sulphur", "coke", "dye", "slops", "fraction", "diesel mid", "mapped", "old thing (OLD)", "EMPTY", None]
    objects = table(SIDES[0], *[(i, rng.choice(places), rng.choice(["tank", "tank", "System x", None]), int(i % 9 == 8)) for i in range(40)])
    products = table(SIDES[1], *[(i, goods[i % len(goods)], int(i % 11 == 10)) for i in range(60)])
    layers = table("object_id int, layer string", *[(i, n) for i in range(36) for n in ("Plant", "North", "South") if rng.random() < 0.6])
    amounts = [0.0, -0.0, 4.0, 0.1 + 0.2, 0.3, 1e-13, 10.0, 12345.678, None]
    any_of = lambda *values: rng.choice(values)
    rows = [
        (rng.randrange(40), rng.randrange(60), any_of(1, 2), *[rng.choice(amounts) for _ in range(4)], any_of("p", "x", None), any_of("1", None), any_of("10", "20", "", None, "7"))
        for _ in range(3_000)
    ]
    kind = "object_id int, product_id int, case_id int, measured double, mass_without_dr double, dead_residue_mass double, free_volume double, passport_state string, number_park string, grouping string"
    return table(kind, *rows, *rows[:300]), objects, products, layers


@pytest.mark.parametrize("kind", ["double", "decimal(38,14)"])
def test_balances_of_sets_in_one_pass_equal_the_single_operators(table, tanks, kind):
    positions, objects, products, layers = tanks
    positions = positions.withColumns({c: F.col(c).cast(kind) for c in St.AMOUNTS})
    described = St.described_positions(positions, objects, products)
    scoped = St.tank_scopes(described, layers, SCOPE, SETS_OF)
    single = St.tank_balance(scoped, NAMES, mapping(table), SCOPE, by=["case_id", "division"])
    shown = ["case_id", "division", "product", *St.STOCK_MEASURES]
    out = St.division_balances(positions, objects, products, layers, NAMES, mapping(table), SCOPE, SETS_OF, by=["case_id"])
    assert tuples(out, *shown) == tuples(single, *shown) and out.count() > 30
    short = St.NameRules(ordered=(), obsolete_marker="(OLD)", ci=False)
    totals = St.warehouse_totals(described, layers, short, mapping(table), SCOPE, by=["case_id"])
    want = St.warehouse_topup(single, totals.filter("product is not null"), None, SCOPE, by=["case_id"], division="division")
    topped = St.topped_up_balances(positions, objects, products, layers, NAMES, short, mapping(table), SCOPE, SETS_OF, by=["case_id"])
    assert tuples(topped.filter("product is not null"), *shown) == tuples(want.filter("product is not null"), *shown)


def test_names_are_judged_before_positions_are_joined(table, tanks):
    """No pattern stands over a join with positions: tanks and products have them, however many positions there are."""
    positions, objects, products, layers = tanks
    out = St.topped_up_balances(positions, objects, products, layers, NAMES, NAMES, mapping(table), SCOPE, SETS_OF, by=["case_id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "number_park" in line or "passport_state" in line]
    assert lines and not any(word in line for line in lines for word in ("lower(", "LIKE", "Contains("))


BALANCE = "product string, " + ", ".join(f"{m} decimal(18,3)" for m in St.STOCK_MEASURES)


def stock(product, measured):
    return (product, Decimal(measured), *[Decimal(0)] * 5)


def test_snapshots_joined_and_in_one_pass_agree(table):
    cur = [stock("a", 10), stock("b", 5)]
    prev = [stock("a", 4), stock("c", 9)]
    opening = [stock("b", 1), stock("d", 7)]
    joined = St.append_missing_opening(
        St.compare_snapshots(table(BALANCE, *cur), table(BALANCE, *prev), table(BALANCE, *opening)), table(BALANCE, *opening)
    )
    by_case = table("case_id int, " + BALANCE, *[(3, *r) for r in cur], *[(2, *r) for r in prev], *[(1, *r) for r in opening])
    pivot = St.snapshots_by_role(by_case, SETS, plant=True)
    columns = ("product", "measured", "measured_old", "produced_day", "measured_start", "produced_month")
    want = [("a", 10, 4, 6, 0, 10), ("b", 5, 0, 5, 1, 4), ("d", 0, 0, 0, 7, -7)]
    assert tuples(joined, *columns) == tuples(pivot, *columns) == [(p, *map(Decimal, v)) for p, *v in want]
    division = St.snapshots_by_role(by_case, SETS, plant=False)
    assert tuples(division, "product") == [("a",), ("b",)]
    first = St.snapshots_by_role(by_case, CaseSets(3, None, None, (3,), False), plant=True)
    assert tuples(first, "product", "produced_day") == [("a", Decimal(10)), ("b", Decimal(5))]


ROWS = "product string, " + ", ".join(f"{m} decimal(18,3)" for m in Rep.MEASURES)


def base(product, **values):
    return (product, *[Decimal(str(values.get(m, 0))) for m in Rep.MEASURES])


def numbers(df, *columns):
    return {r[0]: tuple(None if x is None else float(x) for x in r[1:]) for r in tuples(df, "product", *columns)}


def test_production_identity_and_null_shipment(table):
    rows = table(ROWS, base("a", measured=10, measured_old=4, measured_start=1))
    daily = table("product string, reconciled decimal(18,3)", ("a", Decimal(3)), ("n", None))
    month = table("product string, reconciled decimal(18,3)", ("a", Decimal(5)), ("m", Decimal(2)), ("n", None))
    out = Rep.production_from_balance(rows, daily, month)
    assert numbers(out, "shipped_day", "produced_day", "shipped_month", "produced_month") == {
        "a": (3.0, 9.0, 5.0, 14.0),  # stock + shipped - earlier stock
        "m": (0.0, 0.0, 2.0, 2.0),
        "n": (0.0, None, 0.0, 0.0),
    }


def test_system_rows_matched_only(table):
    rows = table(ROWS, base("a", measured=1, produced_day=99), base("S1", measured=3, produced_day=77))
    system = "name string, reconciled double"
    out = Rep.append_system_rows(
        rows, table(system, ("S1", 10.0), ("S2", 20.0)), table(system, ("S1", 4.0)), table(system, ("S2", None))
    )
    got = tuples(out.select("product", *[F.col(c).cast("double") for c in ("measured", "measured_old", "produced_day", "measured_start", "produced_month")]), "*")
    assert got == [
        ("S1", 10.0, 4.0, 6.0, 0.0, 0.0), ("S1", 3.0, 4.0, -1.0, 0.0, 0.0),
        ("S2", 20.0, 0.0, 0.0, 0.0, 20.0), ("a", 1.0, 0.0, 99.0, 0.0, 0.0),
    ]


def test_meter_adjustment(table):
    rows = table(ROWS, base("a", shipped_day=1, produced_day=2, shipped_month=3, produced_month=4), base("b", shipped_day=1))
    meters = table("meter_id int, case_id int, value double", (7, 3, 10.0), (7, 2, 5.0), (7, 1, 99.0), (8, 3, 1.0), (9, 3, 50.0))
    rules = table("product string, meter_id int", ("a", 7), ("a", 8), ("b", 6))
    out = Rep.meter_adjustment(rows, rules, meters, SETS)
    assert numbers(out, "shipped_day", "produced_day", "shipped_month", "produced_month") == {
        "a": (12.0, 13.0, 19.0, 20.0), "b": (1.0, 0.0, 0.0, 0.0),
    }


def test_flow_counts_once_per_live_link(table):
    objects = table(
        "id int, object_type_id int, sf_name string, is_deleted int",
        (1, None, None, 0), (2, None, None, 0), (3, None, None, 1), (10, 5, "x site y", 0), (11, 9, "x site y", 0),
        (20, 5, "tank", 0), (30, None, None, 0), (31, None, None, 0), (32, None, None, 1),
    )
    types = table("id int, name string", (5, "t"))
    products = table("id int, name string, is_deleted int", (1, "butane part", 0), (2, "oil", 0), (3, "butane", 1))
    flows = table(
        "id int, product_id int, second_product_id int, source_id int, dest_id int",
        (1, 1, 2, 10, 20), (2, 1, 2, 11, 20), (3, 1, 2, 10, 20),
    )
    values = table("id int, case_id int, reconciled double", (1, 3, 2.0), (1, 2, 1.0), (1, 1, 100.0), (2, 3, 50.0), (3, 3, 50.0))
    links = table("id int, flow_id int", (30, 1), (31, 1), (32, 1), (30, 2), (30, 3))
    out = Rep.flow_total(flows, values, links, objects, types, products, SETS, "%SITE%", "%Butane%")
    assert [tuple(map(float, r)) for r in out.collect()] == [(4.0, 6.0)]


def test_consolidate_keeps_totals_and_exists_without_members(table):
    rows = table(ROWS, base("a", measured=1), base("b", measured=2), base("c", measured=4))
    out = Rep.consolidate(rows, ["a", "b"], "ab")
    assert numbers(out, "measured") == {"ab": (3.0,), "c": (4.0,)}
    assert numbers(Rep.consolidate(rows, ["z"], "zz"), "measured")["zz"] == (None,)


def test_summary_headers_and_hidden_rows(table):
    rows = table(
        ROWS, base("a", measured=10, not_issued=1, passported=2, not_passported=3, dead_residue=99), base("a", measured=1),
        base("b", measured_start=5), base("c (blend)"), base("d", measured=7), base("n", measured=2),
    )
    groups = table("product string, group_name string", ("a", "G"), ("b", "G"), ("c (blend)", "H"), ("d", "D"))
    summary = Rep.product_summary(rows, groups, plant=True, moved=("d", "G"))
    assert numbers(summary, "measured", "dead_residue")["a"] == (11.0, 5.0)
    shown = Rep.hide_empty(summary, keep="%(BLEND)%")
    assert [p for p, in tuples(shown, "product")] == ["a", "c (blend)", "d", "n"]  # opening alone does not show b
    headed = Rep.group_headers(shown)
    assert tuples(headed.select("product", "group_name", F.col("measured").cast("double")), "*") == [
        ("G", "G", 18.0), ("H", "H", 0.0), ("a", "G", 11.0), ("c (blend)", "H", 0.0), ("d", "G", 7.0), ("n", None, 2.0),
    ]  # the header of the group "none" vanishes
    plain = Rep.product_summary(rows, groups, plant=False, moved=("d", "G"))
    assert tuples(plain.filter("product = 'd'"), "group_name") == [("D",)]


def test_chain_order_depth_dangling_and_cycle(spark):
    edges = [(i, i - 1 if i else None) for i in range(300)]  # one list, deeper than any recursion limit of 100
    edges += [(1000, 9999), (1001, 1000)]  # leads nowhere
    edges += [(2000, 2001), (2001, 2000), (2002, 2000)]  # a cycle and what hangs on it
    edges += [(3000, None), (3001, 3000), (3002, 3000)]  # second root, two after the same
    sorting = spark.createDataFrame(edges, "id int, after_id int")
    got = {r.id: r.sort_order for r in Rep.chain_order(sorting).collect()}
    assert got == {**{i: i + 1 for i in range(300)}, 3000: 1, 3001: 2, 3002: 2}


def test_order_labels_and_header_totals(table):
    rows = table("product string, group_name string, produced_day decimal(18,3), produced_month decimal(18,3)",
                 ("G", "G", Decimal(10), Decimal(100)), ("S system 1", "G", Decimal(3), Decimal(50)), ("x", None, Decimal(1), Decimal(1)))
    sorting = table("id int, name string, after_id int", (1, "x", None), (2, "G", 1), (3, "gone", 77))
    ordered = Rep.attach_order(rows, sorting, Rep.chain_order(sorting))
    assert tuples(ordered, "product", "sort_id", "sort_order") == [("G", 2, 2), ("S system 1", None, None), ("x", 1, 1)]
    relabelled = Rep.relabel_groups(rows, table("name string, group_name string", ("x", "X"), ("absent", "Y")))
    assert tuples(relabelled, "product", "group_name") == [("G", "G"), ("S system 1", "G"), ("x", "X")]
    folded = Rep.fold_into_header(rows, "%SYSTEM%")
    assert numbers(folded, "produced_day", "produced_month")["G"] == (13.0, 103.0)  # the daily total goes to both
    own = Rep.fold_into_header(rows, "%system%", {"produced_day": "produced_day", "produced_month": "produced_month"})
    assert numbers(own, "produced_day", "produced_month")["G"] == (13.0, 150.0)


LEDGER = "id int, case_id int, name string, open_mass double, coming_mix double, end_mass double, measured_day double, measured_accum double"


@pytest.mark.parametrize("daily", [True, False])
def test_blend_variants_of_the_preset(table, daily):
    n = "Продукт №{}".format
    rows = table(ROWS, *[base(n(i), measured=10, measured_old=3, measured_start=4) for i in (1, 2, 4, 6, 8, 11, 12)])
    ledger = table(
        LEDGER,
        *[(i, 3, f"mix {n(i)} x", 1.0, 2.0, 5.0, 6.0, 60.0) for i in (1, 2, 4, 6, 8)],
        *[(i + 20, 1, f"mix {n(i)} x", 0.0, 0.0, 7.0, 0.0, 0.0) for i in (1, 2, 4, 6, 8)],
        (11, 3, f"mix {n(11)}", 1.0, 2.0, 5.0, 6.0, 60.0), (12, 3, f"mix {n(11)} x", 100.0, 100.0, 100.0, 100.0, 100.0),
    )
    arrivals = table("product string, day_total double, month_total double", *[(n(i), 2.0, 20.0) for i in (1, 2, 4, 6, 11)])
    sums = ledger_sums(presets.BLENDS, ledger, 3, 1)
    out = blend_balance(rows, presets.BLENDS, sums, arrivals, daily)
    got = numbers(out, "produced_day", "produced_month", "shipped_day", "shipped_month", "measured", "measured_start")
    blend = {i: got[n(i) + presets.BLEND_SUFFIX] for i in (1, 2, 3, 4, 6, 8, 11)}
    # day gap 3 + 2 - 10 = -5, month gap 4 + 20 - 10 = 14; rest = opening + month - stock
    assert blend[2] == (5.0, 14.0, 6.0, 7.0 + 14 - 5, 5.0, 7.0)
    assert blend[4] == (-5.0, 14.0, 6.0, 16.0, 5.0, 7.0)
    assert blend[6] == (5.0, 14.0, 6.0, 14.0, 5.0, 7.0 if daily else 1.0)
    # no arrivals: 3 - 10 and |4 - 10|
    assert blend[8] == (-7.0, 6.0, 6.0 if daily else 60.0, 0.0, 5.0, 7.0)
    assert blend[3] == (0.0,) * 6
    # the pattern of the first also catches 11; the one of 11 lacks its last wildcard and has no opening
    assert blend[1] == (5.0, 14.0, 6.0 + 6 + 100, 0.0, 5.0 + 5 + 100, 7.0)
    assert blend[11] == (2.0, 14.0, 6.0, None, 5.0, None)
    assert got[n(2)] == (2.0, 20.0, 5.0, 14.0, 10.0, 4.0)  # rewritten base row
    assert got[n(8)] == got[n(12)] == (0.0, 0.0, 0.0, 0.0, 10.0, 4.0)  # left alone
    assert out.count() == 7 + 7


def test_presets_name_the_rows_they_are_for(table):
    from ledgerlens.operators import audit as A
    from ledgerlens.operators.ledger import override_rows

    schema = "product string, group_name string, " + ", ".join(f"{m} decimal(18,3)" for m in Rep.SUMMARY)
    zero, one = [Decimal(0)] * len(Rep.SUMMARY), [Decimal(1)] * len(Rep.SUMMARY)
    rows = table(
        schema, ("Продукт №17", "g", *one), ("Продукт №14", "g", *one), ("Продукт №1 (смешение)", "g", *one), ("Продукт №3 (смешение)", "g", *zero),
        ("Система 5", "s", *one), ("s", "s", *one), ("Продукт №12", "g", *zero),
    )
    merged = Rep.consolidate(rows, presets.CONSOLIDATED, presets.CONSOLIDATED_INTO)
    assert tuples(merged.filter("product = 'Продукт №13'"), "measured") == [(Decimal("2.000"),)]
    shown = Rep.hide_empty(merged, keep=presets.BLEND_MARK)
    assert [p for (p,) in tuples(shown, "product")] == ["s", "Продукт №1 (смешение)", "Продукт №13", "Продукт №3 (смешение)", "Система 5"]
    header = Rep.fold_into_header(shown, presets.SYSTEM_MARK).filter("product = 's'")
    assert tuples(header, "produced_day") == [(Decimal("2.000"),)]
    fixed = override_rows(shown, F.col("product").isin(list(presets.CORRECTED)), {"dead_residue": 0})
    assert tuples(fixed.filter("dead_residue = 0"), "product") == [("Продукт №1 (смешение)",), ("Продукт №3 (смешение)",)]
    assert A.change_labels(presets.AUDIT_LABELS)[A.EDITED] == "Редактирование" and presets.MOVED == ("Продукт №19", "Продукт №18")


AMOUNTS = [
    None, 0.0, -0.0, 1.0, 17.0, 0.1 + 0.2, 17 * (1 - 0.07), 0.07 * 10, -50 * (1 - 0.09), 901.05, 1023.9999, 1024.00005, 8191.1234, 8192.12345678901, 104_949.5,
    1 / 3, 2 / 3 * 1e3, 5e-5, 1e-12, 4.9e-13, 5e-13, 1.00000000000015, 858_993.4592, 858_994.0001, 123_456_789_012.34, 1e20, 0.00004999999999999, 99.99995000000001,
]


def test_nearest_doubles_and_exact_sums_are_those_of_the_decimals(spark):
    """Also where a double is off its ten-thousandths by its last digits, or is none of them."""
    rng = random.Random(3)
    near = [round(rng.uniform(-2000, 2000), 4) + rng.choice([-3, -2, -1, 0, 1, 2, 3]) * 5e-14 for _ in range(3000)]
    prices = [rng.randrange(1, 51) * (1 - rng.randrange(11) / 100) for _ in range(2000)] + [rng.uniform(-1e5, 1e5) for _ in range(1000)]
    df = spark.createDataFrame([(i % 7, x) for i, x in enumerate(AMOUNTS + near + prices)], "g int, x double")
    got = df.select("x", amounts.nearest("x", amounts.all_whole(["x"])).alias("a"), amounts.exact("x").cast("double").alias("b")).collect()
    assert [r for r in got if r["a"] != r["b"]] == []
    for rows in (df, df.filter("x = 17"), df.filter("x is null"), df.filter("abs(x) < 1e-4")):
        sums = rows.groupBy("g").agg(amounts.exact_sum("x").alias("a"), F.sum(amounts.exact("x")).alias("b"), F.sum("x").alias("x"))
        assert [r for r in sums.collect() if r["a"] != r["b"]] == [] and dict(sums.dtypes)["a"] == amounts.EXACT


def test_balances_add_whole_numbers(spark):
    """Doubles of ten-thousandths go into the sums as longs: no decimal is made of each of them."""
    positions = spark.createDataFrame([(1, 1, 1, 17 * (1 - 0.07), 2.0, 0.07 * 10, 3.25, "p", "park", "")], "object_id int, product_id int, case_id int, measured double, mass_without_dr double, dead_residue_mass double, free_volume double, passport_state string, number_park string, grouping string")
    objects = spark.createDataFrame([(1, "T_1", "Tank 1", 0)], "id int, sf_name string, name string, is_deleted int")
    products = spark.createDataFrame([(1, "Diesel", 0)], "id int, name string, is_deleted int")
    layers = spark.createDataFrame([(1, "Plant")], "object_id int, layer string")
    mapping = spark.createDataFrame([], "source_name string, canonical_name string")
    out = St.division_balances(positions, objects, products, layers, NAMES, mapping, SCOPE, {"PLANT": (None, None, None)}, by=["case_id"])
    (row,) = out.collect()
    assert (row["measured"], row["passported"], row["dead_residue"], row["free_volume"]) == (Decimal("15.810"), Decimal("2.000"), Decimal("0.700"), Decimal("3.250"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"as bigint\)", plan)) >= len(St.STOCK_MEASURES)
