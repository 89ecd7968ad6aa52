"""LIKE rules as a table against every rule on every row, and against the ladder."""

import random
import re

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from ledgerlens.functions.rules import ladder
from ledgerlens.operators import rule_tables as R

RULES = "rank int, pattern string, unless string, place_like string, place_unlike string, label string"


def like(text, pattern):
    out, i = "", 0
    while i < len(pattern):
        if pattern[i] == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(pattern[i], re.escape(pattern[i]))
        i += 1
    return re.fullmatch(out, text, re.S) is not None


def plain(rows, rules, ci=False):
    low = (lambda t: t and t.lower()) if ci else (lambda t: t)
    out = []
    for i, name, place in rows:
        name, place = low(name), low(place)
        fits = [
            (rank, p, label) for rank, p, unless, pl, pu, label in rules
            if rank is not None and p is not None and name is not None and like(name, low(p)) and not (unless is not None and like(name, low(unless)))
            and (pl is None or (place is not None and like(place, low(pl)))) and (pu is None or (place is not None and not like(place, low(pu))))
        ]
        out.append((i, min(fits, default=(None, None, None))[2]))
    return sorted(out, key=repr)


def found(spark, rows, rules, **how):
    df, table = spark.createDataFrame(rows, "id int, name string, place string"), spark.createDataFrame(rules, RULES)
    return R.first_rules(df, "name", table, ["label"], also=["place"], unless="unless", **how)


def some(seed, rules, rows):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcABé%_\\ ") for _ in range(rng.randrange(0, 7)))

    def pattern():
        parts = [rng.choice(["%", "_", "\\%", "\\_", "\\\\", "ab", "abc", "cab", "a", "é"]) for _ in range(rng.randrange(0, 5))]
        return "".join(parts)

    maybe = lambda f: rng.choice([None, f()])
    table = [(rng.choice([None, *range(9)]), maybe(pattern) or pattern(), maybe(pattern), maybe(pattern), maybe(pattern), f"L{i}") for i in range(rules)]
    return [(i, maybe(word) or word(), maybe(word)) for i in range(rows)] + [(-1, None, "a")], [*table, (1, None, None, None, None, "never")]


@pytest.mark.parametrize("ci, gram", [(False, 3), (True, 3), (False, 1), (True, 5)])
def test_against_every_rule_on_every_row(spark, ci, gram):
    rows, rules = some(gram, 80, 150)
    got = found(spark, rows, rules, ci=ci, gram=gram)
    assert tuples(got, "id", "label") == plain(rows, rules, ci)


def test_fragments(spark):
    patterns = ["%ab%c_", "", "%", "a\\%b%\\_\\\\", "plain", "_é_"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)], "i int, p string").select("i", R.fragments(F.col("p")).alias("f"))
    assert [r.f for r in df.orderBy("i").collect()] == [["ab", "c"], [], [], ["a%b", "_\\"], ["plain"], ["é"]]


def test_equals_the_ladder(spark):
    rules = ({"label": "rings", "any": ("%ring",)}, {"label": "colours", "any": ("red%", "blue%"), "all_but": (("%gear%", "%old gear%"),)}, {"label": "rods", "any": ("%rod%",)})
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["red ring", "blue rod", "old gear", "hot gear", "rod", "", None])], "id int, name string")
    table = spark.createDataFrame([(0, "%ring", None, "rings"), (1, "red%", None, "colours"), (1, "blue%", None, "colours"), (1, "%gear%", "%old gear%", "colours"), (2, "%rod%", None, "rods")], "rank int, pattern string, unless string, label string")
    want = rows.withColumn("c", ladder(F.col("name"), rules, F.lit("other")))
    assert tuples(R.classify_by_rules(rows, "name", table, F.lit("other"), "c", unless="unless"), "id", "c") == tuples(want, "id", "c")


def test_many_rules_and_no_nested_loop(spark):
    """10,000 rules on 20,000 rows, of which one name has a third."""
    words = ["".join(random.Random(i).choices("abcdefghij", k=6)) for i in range(3000)]
    rows = spark.range(20_000).select(F.col("id").cast("int"), F.when(F.col("id") % 3 == 0, F.lit("hot gear")).otherwise(F.element_at(F.array(*map(F.lit, words[:500])), (F.col("id") % 500 + 1).cast("int"))).alias("name"))
    table = spark.createDataFrame([(i, f"%{words[i % 3000][i % 3 : i % 3 + 4]}%", f"L{i}") for i in range(9_999)] + [(99_999, "hot%", "hot")], "rank int, pattern string, label string")
    out = R.first_rules(rows, "name", table, ["label"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    got = {r.name: (r.label, r.n) for r in out.groupBy("name", "label").agg(F.count("*").alias("n")).collect()}
    pieces = [(i, words[i % 3000][i % 3 : i % 3 + 4]) for i in range(9_999)]
    for name in [*words[:500:50], "hot gear"]:
        want = next((f"L{i}" for i, p in pieces if p in name), "hot" if name.startswith("hot") else None)
        assert got[name][0] == want
    assert sum(n for _, n in got.values()) == 20_000


def test_empty_sides(spark):
    rows, rules = some(1, 5, 5)
    assert found(spark, [], rules).count() == 0
    assert {r.label for r in found(spark, rows, []).collect()} == {None}


def test_rules_filed_by_beginnings_ends_and_what_they_ask(spark):
    """Marked keys: escapes and wildcards at the edges, texts shorter than a key, whole texts."""
    patterns = ["abc", "\\%a", "a\\%", "a\\\\%", "%\\\\", "_a", "a_", "%a\\_", "\\\\%", "ab%ba", "é%", "%é", "a", "%", ""]
    words = ["abc", "xabc", "%a", "a%", "a\\", "a\\b", "\\", "\\a", "ba", "ab", "a_", "xa_", "abba", "aba", "éa", "aé", "a", "", "é"]
    rows = [(i, w, "p") for i, w in enumerate(words)]
    for rank in (1, -1):
        rules = [(rank * i, p, None, None, None, f"L{i}") for i, p in enumerate(patterns)]
        assert tuples(found(spark, rows, rules), "id", "label") == plain(rows, rules)


def test_a_hot_key_is_dealt_into_parts_and_equal_rules_are_tried_once(spark, monkeypatch):
    """All texts hold '000'; 3,000 rules ask for 501 different things."""
    monkeypatch.setattr(R, "SHARE", 100, raising=False)
    stored, real = {}, R.staged
    monkeypatch.setattr(R, "staged", lambda df, purpose, *how: stored.setdefault(purpose, real(df, purpose, *how)))
    n = F.col("id")
    rows = spark.range(2_000).select(n.cast("int"), F.format_string("c000%04d", n).alias("name"))
    pattern = F.when(n % 2 == 0, F.lit("%000%")).otherwise(F.format_string("%%%03d", n % 1000))
    rules = spark.range(3_000).select(F.when(n % 2 == 0, n + 9_999).otherwise(n).alias("rank"), pattern.alias("pattern"), F.concat(F.lit("L"), "id").alias("label"))
    got = {r.id: r.label for r in R.first_rules(rows, "name", rules, ["label"]).collect()}
    assert got == {i: f"L{i % 1000}" if i % 2 else "L0" for i in range(2_000)}
    assert stored["rules"].count() == 501
