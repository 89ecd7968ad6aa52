"""One query per operator, on its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import secrets
from .collocations import collocations
from .common import read
from .forest import nearest
from .langid import languages
from .minhash import near_duplicates
from .negatives import hard_negatives
from .packing import packed
from .pieces import round_trips
from .rabitq import near_vectors
from .secrets import digests
from .sharding import sharded
from .toxicity import toxicity
from .urls import judged
from .warc import archived

#: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_warc_index(spark, sf_dir):
    return archived(read(spark, sf_dir, "pages"))


def op2_url_sweep(spark, sf_dir):
    return judged(read(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op3_rabitq(spark, sf_dir):
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op9_prefix_forest(spark, sf_dir):
    return nearest(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op4_toxicity(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_best_fit(spark, sf_dir):
    return packed(read(spark, sf_dir, "documents"))


def op6_viterbi(spark, sf_dir):
    return round_trips(read(spark, sf_dir, "documents"))


def op7_minhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


def op8_hash_ring(spark, sf_dir):
    return sharded(read(spark, sf_dir, "documents"))


def op10_secret_links(spark, sf_dir):
    return digests(read(spark, sf_dir, "documents"))


def op11_nearest_centroid(spark, sf_dir):
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return languages(read(spark, sf_dir, "documents"), rest != 2, rest == 2)


def op12_toivonen(spark, sf_dir):
    return collocations(read(spark, sf_dir, "documents"))


def op13_kronecker_negatives(spark, sf_dir):
    relabel = lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, relabel)


QUERIES = {"op1_warc_index": op1_warc_index, "op2_url_sweep": op2_url_sweep, "op3_rabitq": op3_rabitq, "op4_toxicity": op4_toxicity, "op5_best_fit": op5_best_fit, "op6_viterbi": op6_viterbi, "op7_minhash": op7_minhash, "op8_hash_ring": op8_hash_ring, "op9_prefix_forest": op9_prefix_forest, "op10_secret_links": op10_secret_links, "op11_nearest_centroid": op11_nearest_centroid, "op12_toivonen": op12_toivonen, "op13_kronecker_negatives": op13_kronecker_negatives}
def _found(kind: str, pattern: str, fits: str) -> str:
    """Matches of a kind with what lies between them, so that lengths add up to places."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, regexp_extract_all(t, '{quoted}') AS m, string_split_regex(t, '{quoted}') AS gaps,
        {fits.format(p=quoted)} AS ok FROM d"""


def _secrets_sql() -> str:
    named = "list_transform(regexp_extract_all(t, '{{p}}', 1), lambda g: length(g) >= {0})"
    every = "list_transform(regexp_extract_all(t, '{p}'), lambda g: true)"
    kinds = [
        ("assign", secrets.ASSIGN, named.format(8)), ("access", secrets.ACCESS, every), ("hex", secrets.HEX, every),
        ("login", secrets.LOGIN, named.format(3)),
        ("key", "[A-Za-z0-9/+=]+", "list_transform(regexp_extract_all(t, '{p}'), lambda g: length(g) = 40)"),
        ("endpoint", secrets.ENDPOINT, every),
    ]
    near = f"o.doc_id = c.doc_id AND o.s <= c.e + {secrets.SCOPE} AND o.e + {secrets.SCOPE} >= c.s"
    order = "list_position(['assign', 'access', 'hex', 'login', 'key', 'endpoint'], kind)"
    joined = f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, {order}){{0}}, '')"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        found AS ({" UNION ALL ".join(_found(*k) for k in kinds)}),
        each AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found),
        pos AS MATERIALIZED (
            SELECT doc_id, kind, e - length(word) AS s, e FROM (
                SELECT doc_id, kind, m[i] AS word, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                    + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT) AS e FROM each WHERE ok[i])
        ), base AS (SELECT * FROM pos WHERE kind IN ('assign', 'access', 'hex')),
        weak AS (
            SELECT * FROM pos c WHERE kind IN ('login', 'key', 'endpoint')
              AND NOT EXISTS (SELECT 1 FROM base o WHERE o.doc_id = c.doc_id AND o.s < c.e AND o.e > c.s)
        ), parts AS (SELECT * FROM base WHERE kind <> 'access' UNION ALL SELECT * FROM weak WHERE kind = 'key'),
        logins AS (SELECT * FROM weak c WHERE kind = 'login' AND EXISTS (SELECT 1 FROM parts o WHERE {near})),
        ids AS (SELECT * FROM base WHERE kind = 'access' UNION ALL SELECT * FROM logins),
        keys AS (SELECT * FROM weak c WHERE kind = 'key' AND EXISTS (SELECT 1 FROM ids o WHERE {near})),
        values_ AS (SELECT * FROM base WHERE kind <> 'access' UNION ALL SELECT * FROM keys),
        ends AS (SELECT * FROM weak c WHERE kind = 'endpoint' AND EXISTS (SELECT 1 FROM ids o WHERE {near}) AND EXISTS (SELECT 1 FROM values_ o WHERE {near})),
        spans AS (SELECT * FROM base UNION ALL SELECT * FROM logins UNION ALL SELECT * FROM keys UNION ALL SELECT * FROM ends)
        SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex, sha256({joined.format(" FILTER (kind IN ('assign', 'access', 'hex'))")}) AS base_sha256,
            {joined.format("")} AS spans, count(*) FILTER (kind IN ('login', 'key', 'endpoint')) AS n_linked
        FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


ORACLE: dict[str, str] = {
    "op10_secret_links": _secrets_sql(),
    "op1_warc_index": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS t, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), h AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY t) ELSE page_id END AS holder FROM p
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> holder THEN holder END AS refers_to
        FROM h""",
    "op3_rabitq": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), link AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ), reach(id, root) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT b, root FROM reach JOIN link ON a = id
        ), least AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
        SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links, root AS component_id, vec_id = root AS kept
        FROM embeddings JOIN least ON id = vec_id""",
    "op7_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS MATERIALIZED (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w
        ), held AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        link AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b FROM held a JOIN held b ON a.x = b.x AND a.doc_id < b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), near AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reach JOIN near ON a = id),
        least AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
        SELECT doc_id, len(s) AS n_shingles, root AS component_id, doc_id = root AS kept FROM sets JOIN least ON id = doc_id""",
    "op2_url_sweep": """
        WITH u AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), s AS (
            SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
        ), r(h, p, v) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), m AS (
            SELECT page_id, host, path, h || p AS rule, v,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS k
            FROM s LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        )
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1""",
    "op13_kronecker_negatives": """
        WITH q AS MATERIALIZED (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pair AS MATERIALIZED (
            SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM q a JOIN q b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)
        ), positive AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM pair WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank,
            other AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN pair USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY rank <= 5""",
    "op12_toivonen": r"""
        WITH w AS (
            SELECT lang, list_filter(regexp_extract_all(piece, '[^\x20\x09]+'), lambda x: x <> '') AS w FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                FROM documents)
        ), total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        each AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) s(k) WHERE len(w) >= k),
        f AS MATERIALIZED (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM each GROUP BY ALL HAVING count(*) >= 100
        ), c AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
        inside AS (
            SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS covered FROM (
                SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL
        ), cut AS (
            SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, n, j,
                (1000::HUGEINT * c.a::HUGEINT * n::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN total USING (lang)
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.p[1:c.j], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.p[c.j + 1:c.k], ' ')
            LEFT JOIN inside s ON s.lang = c.lang AND s.phrase = c.phrase
            WHERE s.covered IS NULL OR 100 * s.covered < 100 * c.a
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, j) = 1
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM cut QUALIFY rank <= 2000""",
}
