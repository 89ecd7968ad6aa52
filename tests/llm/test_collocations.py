"""Phrases against brute force: samples that fail, full filters, dirty rows, texts cut in parts."""

import os
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import collocations as C
from ledgerlens.llm.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")
DOCS = "doc_id long, text string, lang string, phrase string, n long"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(rows, longest=5):
    """(lang, phrase as words) -> occurrences, and lang -> words."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        for words in pieces(text):
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    return f, n


def plain(rows, least, first=2000, longest=5):
    f, n = counted(rows, longest)
    held = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, p[i : i + m]) for (lang, p), a in held.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * a >= 100 * held[(lang, p[i : i + m])]}
    found = []
    for (lang, p), a in held.items():
        if (lang, p) in gone:
            continue
        cuts = [((1000 * a * n[lang]) // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, rank = [], Counter()
    for lang, score, a, p, l, r in sorted(found):
        rank[lang] += 1
        if rank[lang] <= first:
            out.append((lang, rank[lang], p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def mined(spark, rows, **kw):
    table = spark.createDataFrame([(i, t, l, "p", 1) for i, (t, l) in enumerate(rows)], DOCS).repartition(3)
    return sorted(tuple(r) for r in C.collocations(table, **kw).collect())


def some(seed, docs=60, words=12, size=60):
    rng = np.random.default_rng(seed)
    names = [f"W{i}" if i % 4 else f"é{i}" for i in range(words)]
    out = []
    for i in range(docs):
        text = "".join(names[w] + rng.choice([" ", "  ", "\t", ". ", "\n", " the "]) for w in rng.integers(0, words, size) % rng.integers(1, words + 1))
        out.append((text, ["en", "de", None][i % 3]))
    return out + [("of the big house " * 30, "en")] * 3


@pytest.mark.parametrize("least,sample,slack", [(10, 0.3, 0.4), (4, 0.05, 1.0), (25, 1.0, 1.0), (10, 0.0, 0.4)])
def test_exact_whatever_the_sample(spark, least, sample, slack):
    rows = some(1)
    got = mined(spark, rows, least=least, sample=sample, slack=slack)
    assert got == plain(rows, least) and len(got) > 20


def test_a_failing_sample_is_followed_by_one_more_pass(spark, monkeypatch):
    passes = []
    real = C._counts
    monkeypatch.setattr(C, "_counts", lambda docs, of, *a, **kw: passes.append(of.__name__) or real(docs, of, *a, **kw))
    rows = some(2)
    assert mined(spark, rows, least=8, sample=0.0) == plain(rows, 8)  # nothing is proposed: all is beyond the border
    assert passes == ["_of_length"] * 4 + ["_with_border", "_beyond"]
    passes.clear()
    short = [(" ".join(t.split()[:8]) + ".", l) for t, l in rows[:-3]]  # no phrase of 5 words is frequent, so the border is clean
    assert mined(spark, short, least=8, sample=1.0, slack=1.0) == plain(short, 8)
    assert passes == ["_of_length"] * 4 + ["_with_border"]


def test_phrases_of_a_slice_with_and_without_filters():
    rows = some(3, 20)
    words = C.Words([l or "und" for _, l in rows], [t.encode() for t, _ in rows])
    f, _ = counted(rows)
    every = np.full(C.BITS // 8, 255, np.uint8)

    def held(which, *filters):
        out = Counter()
        for p in words.phrases(5, *filters):
            chosen = which(p)
            spelt = words.spelt(p.first[chosen], p.length).to_pylist()
            for text, l, x in zip(spelt, words.lang[words.word[p.first[chosen]]], p.n[chosen]):
                out[words.langs[l], tuple(text.split(" "))] += int(x)
        return out

    everything = lambda p: np.ones(len(p.n), bool)
    only_words = {k: n for k, n in f.items() if len(k[1]) == 1}
    assert held(everything, every) == f
    assert held(everything, None) == held(everything, np.zeros(C.BITS // 8, np.uint8)) == only_words
    half = np.random.default_rng(0).integers(0, 256, C.BITS // 8).astype(np.uint8)  # lets a quarter through
    first = held(everything, half)
    later = held(lambda p: ~p.known, half, every, 20)
    assert not first.keys() & later.keys() and first + later == f
    assert len(only_words) < len(first) < len(f)


@pytest.mark.parametrize("width", [1, 4, 48])
def test_buckets_may_hold_many_phrases(spark, monkeypatch, width):
    monkeypatch.setattr(C, "_with_border", lambda shared, longest, _, of=C._with_border: of(shared, longest, width))
    monkeypatch.setattr(C, "_beyond", lambda shared, longest, _, of=C._beyond: of(shared, longest, width))
    rows = some(6, 40)
    assert mined(spark, rows, least=6, sample=0.2) == plain(rows, 6)


def test_texts_are_cut_where_pieces_end(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "STEP", 100)
    texts = [some(4, 1)[0][0] * 3, "x" * 500, None, "", "a b " * 90 + ". c d", "é" * 99 + ".é f"]
    got = list(C._stretches(pa.array(texts)))
    for row, text in enumerate(texts):
        want = [p for p in pieces(text) if p]
        assert [p for r, part in got if r == row for p in pieces(part.decode()) if p] == want
    assert max(len(part) for row, part in got if row == 0) <= 100


def test_dirty_rows_and_numbers_beyond_64_bits(spark):
    rows = [(None, "en"), ("", None), (" \t\n", "en"), ("a  B.b a", "en"), ("a b " * 40, "und"), ("A\tB " * 40, None), ("x" * 5000 + " y", "en"), ("x\x00   z " * 9, "en")]
    assert mined(spark, rows, least=5) == plain(rows, 5)
    assert mined(spark, [], least=5) == [] == mined(spark, [(None, None)], least=1)
    assert mined(spark, some(5), least=6, first=7) == plain(some(5), 6, first=7)
    big = 10**15
    wide = "cast({} as decimal(17,0))".format
    expr = f"(cast(1000 as decimal(4,0)) * {wide(big - 1)} * {wide(big * 9 + 7)}) div ({wide(big - 1)} * {wide(big * 3)})"
    assert spark.sql(f"select {expr}").first()[0] == 1000 * (big - 1) * (big * 9 + 7) // ((big - 1) * big * 3)


@needs_tables
def test_query_against_its_sql(spark):
    from check import oracle_connection, rows_of

    got = QUERIES["op12_toivonen"](spark, SF)
    want = oracle_connection(SF).sql(ORACLE["op12_toivonen"])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())
