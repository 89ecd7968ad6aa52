"""Hard negatives: packed products and the whole query against brute force, with dirty rows and components of any size."""

import math
import os
from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import negatives
from ledgerlens.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")
VECTORS = "vec_id long, embedding array<double>, label int, rank string"


def plain(rows, every, k=5, m=5, low=80, high=100):
    """The result row by row, in Python's whole numbers."""
    usable = [(i, tuple(v), l) for i, v, l in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    one = {}
    for i, v, l in sorted(usable, key=lambda r: (r[2], r[1])):
        one.setdefault(i, (l, [math.floor(Fraction(x) * 256) for x in v]))
    out = []
    for a, (label, v) in one.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), i, l) for i, (l, w) in one.items() if i != a and len(w) == len(v)]
        for ps, p, _ in sorted(s for s in scores if s[2] == label)[:k]:
            fits = sorted(s for s in scores if s[2] != label and low * -ps <= 100 * -s[0] <= high * -ps)[:m]
            out += [(a, p, n + 1, i, -ps, -s) for n, (s, i, _) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, every, **kw):
    table = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    return sorted(tuple(r) for r in negatives.hard_negatives(table, lambda i: i % every == 0, **kw).collect())


def some(seed, n, dim=8, labels=3):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dim) + 0.6], int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("size", [1, 2**12, 2**40, 2**200])
def test_packed_products_are_exact_at_every_width(size):
    rng = np.random.default_rng(1)
    rows, anchors = (np.array([[int(x) * size // 7 for x in r] for r in rng.integers(-900, 900, (n, 5))], object) for n in (1500, 4))
    if size < 2**30:
        rows, anchors = rows.astype(np.int64), anchors.astype(np.int64)
    want = [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]
    most = 10**38 - 1
    assert [list(map(int, s)) for s in negatives.products(anchors, rows)] == [[max(-most, min(most, x)) for x in w] for w in want]


def test_components_that_are_all_negative_or_zero():
    rows = np.full((3, 4), -(2**30), np.int64)
    assert [s.tolist() for s in negatives.products(rows[:1], rows)] == [[4 * 2**60] * 3]
    assert [s.tolist() for s in negatives.products(rows[:1], np.zeros((2, 4), np.int64))] == [[0, 0]]


def test_blocks_ties_and_a_hot_label(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "ROWS", 20)
    rows = [(i, v, 0 if i % 3 else l) for i, v, l in some(2, 150)]
    rows += [(200 + i, rows[10][1], i % 2) for i in range(60)]  # one vector many times: ties
    got = mined(spark, rows, 10)
    assert got == plain(rows, 10) and len(got) > 50


def test_dirty_rows(spark):
    nan, inf = math.nan, math.inf
    rows = some(3, 60) + [
        (70, None, 1), (80, [1.0] * 8, None), (90, [nan] * 8, 0), (100, [inf, *[1.0] * 7], 0), (110, [None, *[1.0] * 7], 0), (None, [1.0] * 8, 0),
        (120, [], 0), (121, [], 0), (122, [], 1), (130, [1.0, 2.0], 0), (131, [1.0, 2.0], 0), (132, [0.9, 2.0], 1), (0, [2.0] * 8, 1), (0, [2.0] * 8, 1), (140, [0.0] * 8, 2),
    ]
    got = mined(spark, rows, 10)
    assert got == plain(rows, 10)
    assert {(130, 131, 1, 132)} <= {r[:4] for r in got} and (120, 121, 1, 122, 0, 0) in got
    assert mined(spark, [], 10) == [] == mined(spark, [(1, [1.0], 1)], 10)


def test_huge_components(spark):
    rows = [(i, [x * 2.0**30 for x in v], l) for i, v, l in some(4, 50)]  # sums beyond a field of 55 bits
    want = plain(rows, 10)
    top = 2**63 - 1
    assert mined(spark, rows, 10) == sorted((*r[:4], min(r[4], top), min(r[5], top)) for r in want) and any(r[4] > top for r in want)
    assert mined(spark, [(0, [1e300, 1.0], 0), (1, [1e300, 2.0], 0), (2, [1e300, 0.0], 1)], 10)  # beyond 38 digits, still a defined result


def test_label_is_changed_before_anything_else(spark):
    from pyspark.sql import functions as F

    rows = some(5, 90)
    relabel = lambda i, l: F.when(i % 7 == 0, (l + 1) % 3).otherwise(l)
    moved = [(i, v, (l + 1) % 3 if i % 7 == 0 else l) for i, v, l in rows]
    assert mined(spark, rows, 10, relabel=relabel, positives=3, negatives=2, low=50) == plain(moved, 10, 3, 2, 50)


@needs_tables
def test_query_against_its_sql(spark):
    from check import oracle_connection, rows_of

    got = QUERIES["op13_kronecker_negatives"](spark, SF)
    want = oracle_connection(SF).sql(ORACLE["op13_kronecker_negatives"])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())
