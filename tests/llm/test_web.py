"""Archives and URL rules on dirty rows and against plain versions."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import urls, warc
from ledgerlens.llm.queries import QUERIES, URL_RULES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")

LONG, EXACT = "é" * 700, "x" * 1000
PAGES = [
    (1, "http://a.org/1", LONG), (9, "http://a.org/9?q=\r\nX: y", LONG), (4, None, LONG), (2, "u", "x" * 999), (3, "u", "x" * 999),
    (5, "u", EXACT), (6, "u", EXACT), (7, "u", None), (8, "u", ""), (10, "http://é/ü", "\r\n\r\nWARC/1.1\r\n\r\n\u0000"), (11, "u", "z" * 2_000_000),
    (12, "u", "z" * 2_000_000), (None, "u", EXACT), (None, "u", "small"), (9, "twice", LONG), (13, "u", "q" * 3000), (13, "u", "r" * 3000),
]


def expected_records(rows):
    holders = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000 and i is not None:
            holders[html] = max(holders.get(html, i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        holder = holders.get(html, i)
        same = holder == i
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "response" if same else "revisit", None if same else holder))
    return sorted(out, key=repr)


def pages(spark):
    return spark.createDataFrame([(*p, "f", 1) for p in PAGES], "page_id long, url string, html string, file string, offset int")


def test_archives_of_dirty_rows(spark):
    got = sorted((tuple(r) for r in warc.archived(pages(spark)).collect()), key=repr)
    assert got == expected_records(PAGES)
    assert warc.archived(pages(spark).limit(0)).collect() == []


def test_index_points_at_single_records(spark, tmp_path):
    folder = str(tmp_path / "archive")
    index = warc.write(pages(spark), folder)
    for r in index.collect():
        data = (tmp_path / "archive" / r["file"]).read_bytes()
        fields, payload = warc.parse(data[r["offset"] : r["offset"] + r["length"]])
        assert fields["WARC-Type"] == r["record_type"] and fields["WARC-Payload-Digest"] == f"sha1:{r['digest']}"
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        assert r["record_type"] == "revisit" or hashlib.sha1(payload).hexdigest() == r["digest"]
    picked = index.filter(F.col("page_id").isin(4, 10))
    found = {r["page_id"]: r for r in warc.fetch(picked, folder).collect()}
    assert set(found) == {4, 10}
    assert bytes(found[10]["payload"]).decode() == PAGES[9][2] and found[10]["url"] == "http://%C3%A9/%C3%BC"
    assert found[4]["refers_to"] == 9 and found[4]["url"] is None


def test_reads_are_coalesced_up_to_gaps_and_spans(spark):
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("a", 1000, 300), ("a", 1300, 5), ("b", 10, 1), ("a", 10, 10)]
    index = spark.createDataFrame(rows, "file string, offset long, length long")
    got = sorted((r["file"], r["begin"], r["end"], len(r["records"])) for r in warc.ranges(index, 5, 1250).collect())
    assert got == [("a", 0, 30, 3), ("a", 100, 110, 1), ("a", 1000, 1300, 1), ("a", 1300, 1305, 1), ("b", 10, 11, 1)]


def test_a_changed_payload_is_noticed(spark, tmp_path):
    folder = tmp_path / "archive"
    index = warc.write(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), str(folder))
    (path,) = folder.glob("part-*.gz")
    bad = warc.record(1, "u", b"tixt", "response", None, hashlib.sha1(b"text").hexdigest())
    path.write_bytes(bad)
    with pytest.raises(Exception, match="digest"):
        warc.fetch(index.withColumn("length", F.lit(len(bad)).cast("long")), str(folder)).collect()


@needs_tables
def test_archive_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in QUERIES["op1_warc_index"](spark, SF).collect()), key=repr) == expected_records(rows)


URLS = [
    None, "", "no scheme/net/", "http://", "http://net", "http://net/", "HTTP://Sub.NET/en/x", "x://a.example.net/en/1", "x://example.net/en", "x://example.net/EN/",
    "x://notexample.net/en/", "https://example.com/de/y?z", "https://www.example.com/de", "http://org/fr/", "http://a.b.org/fr/2#t", "http://a.org?/fr/", "http://a.org#/fr/",
    "a://b://net/", "http://net./", "http://user@x.net:80/", "http://ÄB.net/é", "http://a..net/", "http://" + "s." * 3000 + "net/x", "http://net/" + "p" * 50_000, "x://\nnet/",
    "http://example.net/en/deep/er", "http://q.example.net/en/deep/", "http://!.net/", "http://net\"/", "http://xorg/fr/",
]
RULES = [*URL_RULES, ("example.net", "/en/deep/", "block"), ("q.example.net", "/", "allow"), ("q.example.net", "/", "block"), ("", "/", "block"), (None, "x", "block"), ("A.Org", None, "block"), ("net", "/", "block"), ("b.org", "/f", "allow")]


def plain_judgement(url, rules, otherwise="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = []
    for h, p, v in rules:
        h, p = (h or "").lower(), p or ""
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), len(h), v, h + p))
    best = max(fits, default=(0, 0, otherwise, None))
    return host, path, best[3], best[2]


@pytest.mark.parametrize("rules", [RULES, URL_RULES, []])
def test_rules_on_dirty_urls(spark, rules):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(0, URLS[6], "h", "r"), (None, URLS[7], "h", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((repr(r["page_id"]), r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in urls.judged(df, table).collect())
    want = [(repr(i), *plain_judgement(u, rules)) for i, u, *_ in rows]
    assert got == sorted((i, h, p, r or "", v) for i, h, p, r, v in want)
    assert urls.judged(df.limit(0), table).collect() == []


def test_sweep_goes_over_ranges(spark):
    """A rule's interval spans many ranges of the sort; the stack is carried from one to the next."""
    hosts = [f"h{i:04}.{'x' if i % 2 else 'y'}.net" for i in range(600)] + ["zz.org", "net", "com"]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    rules = spark.createDataFrame([("net/", "net", "/", "block"), ("y.net/", "y.net", "/", "allow")], "rule string, host string, path string, verdict string")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r["host"]: sorted(x["host"] for x in r["stack"] or []) for r in urls.stacks(df, rules).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for h in hosts:
        assert got[h] == sorted(x for x in ("net", "y.net") if h == x or h.endswith("." + x))
    plan = urls.judged(df.selectExpr("1 AS page_id", "concat('http://', host, '/') AS url"), rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@needs_tables
def test_url_query(spark):
    url = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op2_url_sweep"](spark, SF).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_judgement(url[r["page_id"]], URL_RULES)
