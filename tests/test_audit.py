import random

from conftest import at, tuples
from pyspark.sql import functions as F

from ledgerlens.functions import grouping, rules, text
from ledgerlens.functions.grouping import listed_text
from ledgerlens.operators import audit as A
from ledgerlens.plans import audit_reports as reports

LABELS = A.Labels(
    masked_users={"root": "somebody"},
    type_aliases={"Stores": "Additives"},
    dependency_attribute="dep",
    dependency_prefix="Loss ",
    dependency_title="Losses: ",
    name_rules=({"label": "Plant", "any": ("%Plant %",)}, {"label": "Additives", "all_but": (("%Store%", "%Store of sulphur%"),)}),
)
LOG = (
    "log_id int, case_id int, dt timestamp_ntz, object_id int, user_id int, history_type int, attribute string, "
    "attribute_sf string, prev string, new string, is_cancel int"
)


def sources(table, *log):
    return reports.AuditSources(
        cases=table(
            "case_id int, start_time timestamp_ntz, end_time timestamp_ntz, is_cumulative int",
            (1, at("2024-01-01"), at("2024-01-02"), 0), (2, at("2024-01-01"), at("2024-02-01"), 1),
        ),
        log=table(LOG, *log),
        users=table("id int, name string", (1, "root"), (2, "ann")),
        objects=table("id int, object_type_id int", (10, 5), (11, 1024), (12, None), (13, 6)),
        object_types=table("id int, name string", (5, "Tank"), (1024, "Hidden"), (6, "Stores")),
        names=table(
            "case_id int, object_id int, name string",
            (1, 10, "Plant 7 -> T1"), (2, 10, "Plant 7 -> T1 (month)"), (1, 13, "Loss A"), (2, 13, "Loss A"),
        ),
        products=table("case_id int, id int, name string", (1, 77, "oil"), (2, 77, "oil")),
        excluded_type=1024,
    )


def row(id, case=1, dt="2024-01-01 10:00:00.400", obj=10, user=2, kind=2, attr="Level", sf="Level", prev=None, new=None, cancel=0):
    return (id, case, at(dt), obj, user, kind, attr, sf, prev, new, cancel)


def test_references_text_numbers_and_unknown_ids(table):
    src = sources(
        table,
        row(1, sf="SourceId", prev="10", new="99"),  # known, unknown id
        row(2, sf="ProductId", prev="77", new="1.5"),  # a number that is no id stays as text
        row(3, sf="Level", prev="10", new=None),
        row(4, sf="DestId", prev="none", new=" 13"),
    )
    out = A.resolve_references(src.log, src.names, src.products, LABELS.object_attributes, LABELS.product_attributes)
    assert tuples(out, "log_id", "object_name", "prev_text", "new_text") == [
        (1, "Plant 7 -> T1", "Plant 7 -> T1", None), (2, "Plant 7 -> T1", "oil", "1.5"),
        (3, "Plant 7 -> T1", "10", None), (4, "Plant 7 -> T1", "none", "Loss A"),
    ]


def test_report_v1_inner_on_type_left_on_user_and_distinct(table):
    src = sources(
        table, row(1), row(1), row(2, obj=11), row(3, obj=12), row(4, user=1, kind=4, cancel=1), row(5, user=9, kind=7, obj=13)
    )
    out = reports.audit_report(src, LABELS)
    assert tuples(out, "log_id", "user_name", "object_type", "change", "cancelled", "period_kind", "action_time") == [
        (1, "ann", "Tank", "edited", "no", "daily", "01.01.2024 10:00:00"),
        (4, "somebody", "Tank", "system", "yes", "daily", "01.01.2024 10:00:00"),
        (5, None, "Additives", "7", "no", "daily", "01.01.2024 10:00:00"),
    ]


def test_best_copy_prefers_the_highest_case(table):
    out = reports.best_copies(sources(table, row(1, case=1), row(1, case=2), row(2, case=1)))
    assert tuples(out, "log_id", "case_id") == [(1, 2), (2, 1)]


def test_folded_report(table):
    src = sources(
        table,
        row(1, kind=0, attr="b", new="2", dt="2024-01-01 10:00:00.100"),
        row(2, kind=0, attr="a", new=None, dt="2024-01-01 10:00:00.900"),
        row(3, kind=0, attr=None, new="9", dt="2024-01-01 10:00:00.500"),  # null attribute leaves the list
        row(4, kind=0, attr="c", new="3", dt="2024-01-01 10:00:01.000"),  # next second
        row(5, kind=4, attr="dep", obj=13, prev="0", new="1", dt="2024-01-01 11:00:00.100"),
        row(6, kind=4, attr="dep", obj=10, prev="2", new="0", dt="2024-01-01 11:00:00.200"),
        row(7, kind=4, attr="other"),
        row(8, kind=4, attr=None),  # unknown: drops out
        row(9, kind=1, attr=None),
    )
    comments = table("id int, log_id int, text string", (1, 9, "old"), (2, 9, "new"))
    signs = table("id int, log_id int, text string", (1, 1, "!"))
    out = reports.audit_report_folded(src, LABELS, comments, signs)
    got = tuples(out, "log_id", "part", "change", "object_type", "object_name", "attribute", "prev", "new", "comment", "sign")
    both = "Losses: A, Plant 7 -> T1"  # groups by object type, but each lists every object of that second
    assert got == [
        (1, 0, "created", "Plant", "Plant 7 -> T1", "a=NULL, b=2", None, None, "", "!"),
        (4, 0, "created", "Plant", "Plant 7 -> T1", "c=3", None, None, "", ""),
        (5, 0, "system", "Plant", both, "dep", "0", "1", "", ""),
        (6, 0, "system", "Plant", both, "dep", "2", "0", "", ""),
        (7, 0, "info", "Plant", "Plant 7 -> T1", "other", None, None, "", ""),
        (9, 0, "deleted", "Plant", "Plant 7 -> T1", None, None, None, "new", ""),
    ]


def test_lists_of_a_hot_group_are_whole_and_in_order(spark):
    rng = random.Random(5)
    rows = [("hot" if i % 3 == 0 else f"k{i % 50}", i, f"v{rng.randrange(100)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, id int, v string")
    want = {}
    for k, i, v in sorted(rows, key=lambda r: (r[2], r[1])):
        want.setdefault(k, []).append(v)
    for per_part in (60, 7, 10_000):
        parts = sorted(listed_text(df, ["k"], F.col("v"), [F.col("v")], F.col("id"), per_part=per_part).collect(), key=lambda p: p.part)
        whole, sizes = {}, {}
        for p in parts:
            whole.setdefault(p.k, []).extend(p["items"].split(", "))
            sizes.setdefault(p.k, []).append(p["items"].count(",") + 1)
        assert whole == want
        assert all(n == per_part for s in sizes.values() for n in s[:-1]) and max(map(max, sizes.values())) <= per_part


def test_positions_over_many_ranges(spark):
    rows = [(i % 2, i // 9, i) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, c int, id int")
    got = {(r.k, r.id): r.position for r in grouping.numbered(df, ["k"], [F.col("c")], F.col("id"), span=4).collect()}
    assert got == {(k, i): n for k in (0, 1) for n, i in enumerate(sorted(i for g, _, i in rows if g == k))}


def test_ids_beyond_32_bits_are_looked_up(table):
    log = table("log_id int, case_id int, object_id long, attribute_sf string, prev string, new string", (1, 1, 3_000_000_000, "SourceId", "3000000000", "text"))
    names = table("case_id int, object_id long, name string", (1, 3_000_000_000, "far"))
    products = table("case_id int, id int, name string", (1, 5, "p"))
    out = A.resolve_references(log, names, products, ["SourceId"], ["ProductId"])
    assert tuples(out, "object_name", "prev_text", "new_text") == [("far", "far", "text")]


def test_null_keys_have_no_list(table):
    df = table("k int, v string, id int", (1, "a", 1), (None, "b", 2))
    assert tuples(listed_text(df, ["k"], F.col("v"), [F.col("v")], F.col("id")), "k", "items") == [(1, "a")]


def test_classify_by_name(table):
    names = table("name string, own string", ("Store 1 -> x", "t"), ("Store of sulphur -> x", "t"), ("Plant 3", "t"), ("x -> Plant 3", "t"), (None, "t"))
    out = A.classify_by_name(names, "name", " -> ", LABELS.name_rules, F.col("own"), "class")
    assert tuples(out, "name", "class") == [
        ("Plant 3", "Plant"), ("Store 1 -> x", "Additives"), ("Store of sulphur -> x", "t"), ("x -> Plant 3", "t"), (None, "t"),
    ]


def test_labels_and_text_helpers(table):
    df = table("a int, t string", (0, " x "), (9, "   "), (None, None))
    assert tuples(df.select(rules.labels(F.col("a"), {0: "zero"}).alias("l")), "l") == [("9",), ("zero",), (None,)]
    assert tuples(df.select(text.blank_to_null(F.col("t")).alias("t")), "t") == [("x",), (None,), (None,)]


def test_references_move_the_log_once(spark, table):
    """One join finds all names; the texts of the log are shuffled once, by row number."""
    log = table(
        "log_id int, case_id int, object_id int, attribute_sf string, prev string, new string",
        (1, 1, 7, "SourceId", "7", "8"), (1, 1, 7, "SourceId", "7", "8"), (2, 1, None, "ProductId", "7", "x"), (3, 2, 7, "Name", "7", None), (4, None, 7, "DestId", "8", "9"),
    )
    names = table("case_id int, object_id int, name string", (1, 7, "tank"), (1, 8, None), (2, 7, "vat"))
    products = table("case_id int, id int, name string", (1, 7, "oil"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = A.resolve_references(log, names, products, ["SourceId", "DestId"], ["ProductId"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert tuples(out, "log_id", "case_id", "object_name", "prev_text", "new_text") == [
            (1, 1, "tank", "tank", None), (1, 1, "tank", "tank", None), (2, 1, None, "oil", "x"), (3, 2, "vat", "7", None), (4, None, None, None, None),
        ]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(case_id") == 2 and plan.count("Exchange hashpartitioning(_row") == 2
    assert plan.count("SortMergeJoin") == 2 and out.columns == [*log.columns, "object_name", "prev_text", "new_text"]
