"""Near duplicates and nearest neighbours against brute force, with dirty rows."""

import os
import re
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import common, forest, minhash, rabitq, shingles
from ledgerlens.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def reach(ids, links):
    """Smallest id reachable of every id."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for i in sorted(set(ids)):
        if i in out:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += near[x]
    return out


def expected_documents(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    links = [(a, b) for a, s in sets for b, t in sets if a < b and s and t and 100 * len(s & t) >= 75 * len(s | t)]
    root = reach([i for i, _ in sets], links)
    return sorted((i, len(s), root[i], root[i] == i) for i, s in sets)


def words(seed, n):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


def near_copies():
    """A chain of near copies, short texts, empty ones, and white space of other kinds."""
    base = words(1, 200)
    rows = [(10, " ".join(base)), (11, "  ".join(base).upper()), (12, "\n".join(base[:190]))]
    for k in range(6):  # each like the one before, the ends unlike one another
        base = base[12:] + words(50 + k, 12)
        rows.append((20 + k, " ".join(base)))
    rows += [(30, None), (31, ""), (32, " \t\n"), (33, "one two"), (34, "One TWO"), (35, "one two three"), (36, "one two")]
    return rows + [(40, " ".join(words(9, 30_000))), (41, " ".join(words(9, 30_000)[:-3000]))]


def test_near_duplicates_of_dirty_rows(spark):
    rows = near_copies()
    df = spark.createDataFrame([(i, t, "x", "key") for i, t in rows], "doc_id long, text string, sig string, key string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(df).collect())
    assert got == expected_documents(rows)


def test_rows_that_repeat_or_have_no_id(spark):
    text = " ".join(words(3, 40))
    rows = [(5, text), (5, text), (None, text), (None, "alone but five words long"), (7, None), (7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(5, 36, 5, True), (5, 36, 5, True), (None, 36, 5, False), (None, 1, None, True), (7, 0, 7, True), (7, 1, 7, True)], key=repr)


def test_no_documents(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_large_group_goes_over_blocks(spark, monkeypatch):
    base = words(4, 120)
    rows = []
    for i in range(60):  # every copy differs in one word; twenty copies are too far away from the rest
        w = list(base)
        w[2 * i] = f"own{i}"
        if i >= 40:
            w = w[:60] + words(100 + i, 60)
        rows.append((i, " ".join(w)))
    cut = spark.createDataFrame(rows, "doc_id long, text string")
    banded = cut.selectExpr("1L AS key", "doc_id AS id")
    dealt = common.blocks(banded, 7).collect()
    met = defaultdict(set)
    for r in dealt:
        met[(r["bi"], r["bj"])].add(r["id"])
    assert all(any({a, b} <= g for g in met.values()) for a in range(60) for b in range(a))
    got = sorted(tuple(r) for r in minhash.near_duplicates(cut).collect())
    assert got == expected_documents(rows)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for share in (0.5, 0.75, 0.9):
        n = int(3000 * share)
        a, b = both[:n], both[:n]
        a = np.concatenate([a, rng.integers(0, 2**63, (3000 - n) // 2, dtype=np.uint64)])
        b = np.concatenate([b, rng.integers(0, 2**63, (3000 - n) // 2, dtype=np.uint64)])
        true = n / (len(a) + len(b) - n)
        guess = (shingles.signature(np.sort(a), 1024) == shingles.signature(np.sort(b), 1024)).mean()
        assert abs(guess - true) < 0.06


def test_shingle_sets_over_slices_and_chunks(monkeypatch):
    monkeypatch.setattr(shingles, "CHUNK", 50)
    texts = [None, "", "a b c d e f", " x", "a b c d e f" * 20, "é É z z z z z z z", "q", " ".join(f"w{i}" for i in range(400)), "x" * 300 + " y z " + "v" * 120 + " u t", " " * 130]
    whole = pa.array(["skipped", *texts])
    got = [len(s) for s in shingles.shingle_sets(whole.slice(1))]
    assert got == [len(shingle_set(t)) for t in texts]
    short = [s.tolist() for s in shingles.shingle_sets(whole.slice(1))]
    monkeypatch.setattr(shingles, "CHUNK", 1 << 20)
    assert short == [s.tolist() for s in shingles.shingle_sets(whole.slice(1))]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7), (90, 100)], "a long, b long")
    got = dict(tuple(r) for r in common.components(edges).collect())
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


@needs_tables
def test_documents_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op7_minhash"](spark, SF).collect()) == expected_documents(rows)


def expected_vectors(rows):
    fine = [(i, np.array(v, float) / np.linalg.norm(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a, b) for a, u in fine for b, v in fine if a < b and len(u) == len(v) and u @ v >= 0.9]
    root = reach([i for i, _ in rows], links)
    many = defaultdict(int)
    for a, b in links:
        many[a] += 1
        many[b] += 1
    return sorted((i, many[i], root[i], root[i] == i) for i, _ in rows)


def vectors(n=300, dim=24):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, dim))
    rows = [(i, [float(x) for x in (centres[i % 20] + rng.standard_normal(dim) * rng.choice([0.05, 0.2, 1])).astype(np.float32)]) for i in range(n)]
    rows += [(500 + i, rows[3][1]) for i in range(40)]  # copies
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] * dim, [None] * dim, [1.0, 2.0], [2.0, 4.0]]
    return rows + [(900 + i, v) for i, v in enumerate(odd)]


def test_near_vectors_of_dirty_rows(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, key string, n int")
    rows = [(i, v) for i, v in rows]
    got = sorted(tuple(r) for r in rabitq.near_vectors(df).collect())
    assert got == expected_vectors([(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert rabitq.near_vectors(df.limit(0)).collect() == []


def test_bounds_hold_and_shut_out_most():
    rng = np.random.default_rng(3)
    units = rabitq.unit(rng.standard_normal((400, 64)))
    units[200:] = rabitq.unit(units[:200] + 0.3 * rng.standard_normal((200, 64)) / 8)
    may = rabitq.Codes.of(units).possible(slice(None), slice(None))
    close = units @ units.T >= rabitq.LEAST
    assert not (close & ~may).any() and may.mean() < 0.05


def test_unlike_vectors_leave_no_edges(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = np.repeat(rng.standard_normal((3, 64)), 400, axis=0)  # cosines of about 0.6 within one of three
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(centres + 0.8 * rng.standard_normal((1200, 64)))]
    rows += [(2000 + i, [x * 1.5 + 0.01 for x in v]) for i, v in rows[:5]]
    edges, components = [], rabitq.components
    monkeypatch.setattr(rabitq, "components", lambda found: (edges.append(sorted({(min(r), max(r)) for r in found.collect()})), components(found))[1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in rabitq.near_vectors(df).collect())
    assert got == expected_vectors(rows)
    assert edges == [[(i, 2000 + i) for i in range(5)]] * 2  # else all vectors of a large table are one cluster


def shuffled_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()))


def test_what_is_shuffled_and_stored_between_is_dropped(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "CELL", 64)
    monkeypatch.setattr(rabitq, "BLOCK", 100)
    df = spark.createDataFrame(vectors(1500)[:1500], "vec_id long, embedding array<float>")
    bits, count = rabitq.tables(1500)
    assert bits == 5 and count > rabitq.ROUND
    before = shuffled_bytes(spark)
    result = rabitq.near_vectors(df)
    deadline = time.time() + 30
    while time.time() < deadline and shuffled_bytes(spark) > before + 100_000:
        time.sleep(0.2)  # files go in the background
    assert shuffled_bytes(spark) <= before + 100_000  # counts of a row a task may stay
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    left = {re.sub("-[0-9a-f]{32}$", "", x) for x in os.listdir(folder)}
    assert not left & {"alike", "stars"}
    assert sorted(tuple(r) for r in result.collect()) == expected_vectors([(r["vec_id"], r["embedding"]) for r in df.collect()])


def test_few_tables_and_pairs_at_the_threshold_share_one():
    assert rabitq.tables(15_000_000)[1] <= 30 and rabitq.tables(500) == (0, 1)
    rng = np.random.default_rng(6)
    for dim in (5, 64):
        a = rabitq.unit(rng.standard_normal((8000, dim)))
        side = rng.standard_normal((8000, dim))
        b = 0.9 * a + np.sqrt(1 - 0.81) * rabitq.unit(side - a * (a * side).sum(axis=1, keepdims=True))
        for rows in (50_000, 15_000_000):
            bits, count = rabitq.tables(rows)
            met = [rabitq.keys(a.astype(np.float32), bits, t) == rabitq.keys(b.astype(np.float32), bits, t) for t in range(count)]
            assert np.mean(~np.any(met, axis=0)) < 2 * rabitq.MISS


def test_stored_codes_and_blocks_give_the_same_pairs():
    rng = np.random.default_rng(7)
    units = rabitq.unit(np.repeat(rng.standard_normal((300, 24)), 3, axis=0) + 0.2 * rng.standard_normal((900, 24)))
    codes = rabitq.Codes.of(units)
    again = rabitq.Codes.read(codes.stored().to_pylist())
    want = {(i, j) for i, j in np.argwhere(codes.possible(slice(None), slice(None))).tolist() if i < j}
    side = np.arange(900) % 2
    for same in (True, False):
        got = [(min(p), max(p)) for i, j in again.pairs(side, same) for p in zip(i.tolist(), j.tolist())]
        assert len(got) == len(set(got)) and set(got) == {(i, j) for i, j in want if same or side[i] != side[j]}
    i, j = np.triu_indices(900, 1)
    assert not ((units @ units.T)[i, j] >= rabitq.LEAST)[~again.close(i, j)].any()


def test_links_join_as_pairs_do():
    rng = np.random.default_rng(8)
    i, j = rng.integers(0, 500, (2, 300))
    one, other = common.Forest(500), common.Forest(500)
    one.link(i, j)
    for a, b in zip(i, j):
        other.join(a, b)
    assert (one.root == other.root).all()


@needs_tables
def test_embeddings_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op3_rabitq"](spark, SF).collect()) == expected_vectors(rows)


def expected_nearest(rows, k, chosen):
    fine = {i: np.array(v, float) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in filter(chosen, fine):
        near = sorted((-float(np.einsum("i,i->", v, fine[q])), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))
        out[q] = near[:k]
    return out


def test_nearest_of_few_rows_is_whole_and_ties_go_to_smaller_ids(spark):
    rows = vectors(60)
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, ids string")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = defaultdict(list)
    found = forest.nearest(df, lambda i: i % 2 == 0, 45)
    for r in found.collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = expected_nearest(rows, 45, lambda i: i % 2 == 0)
    assert {q: [(n + 1, i) for n, (_, i) in enumerate(near)] for q, near in want.items() if near} == {q: [x[:2] for x in sorted(g)] for q, g in got.items()}
    assert all(abs(s + want[q][n - 1][0]) < 1e-12 for q, g in got.items() for n, _, s in g)
    assert forest.nearest(df.limit(0), lambda i: i % 2 == 0).collect() == []


def test_repeated_rows_count_once(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in forest.nearest(df, lambda i: i >= 1).collect())
    assert got == [(1, 1, 2, 0.5), (2, 1, 1, 0.5)]


@needs_tables
def test_recall_over_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = expected_nearest(rows, 20, lambda i: i % 20 == 0)
    got = defaultdict(set)
    for r in QUERIES["op9_prefix_forest"](spark, SF).collect():
        got[r["query_id"]].add(r["vec_id"])
    assert set(got) == set(want)
    assert np.mean([len(got[q] & {i for _, i in near}) / 20 for q, near in want.items()]) >= 0.9
