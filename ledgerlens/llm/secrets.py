"""Secrets in texts: strong patterns, and weak ones where the other parts of a credential stand near."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCOPE = 200  # code points between parts of one credential, at most
_SPAN = "struct<start: int, end: int>"
_NONE = f"array<{_SPAN}>"

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LOGIN = r"""(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]+)"""
KEY = r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+=]{40}(?![A-Za-z0-9/+=])"
ENDPOINT = r"(?i:https?|ftp|jdbc:[a-z]+|mongodb|redis|amqp)://[A-Za-z0-9.-]+(?::[0-9]+)?"

#: Kinds in the order of spans with equal starts.
KINDS = ("assign", "access", "hex", "login", "key", "endpoint")


def matched(text, pattern: str, least: int = 0) -> F.Column:
    """Spans of the leftmost non-overlapping matches in code points; with ``least``, of those whose first group is that long.

    Matches and what lies between them come from the same search, so their lengths add up to the places.
    """
    pat = F.lit(pattern)
    lengths = F.transform(F.regexp_extract_all(text, pat, F.lit(0)), F.char_length)
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(lengths)), lengths, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends"))
    ends = F.aggregate(
        steps, start,
        lambda acc, x: F.struct((acc["at"] + x["g"] + x["m"]).alias("at"), F.concat(acc["ends"], F.array(acc["at"] + x["g"] + x["m"])).alias("ends")),
    )["ends"]
    spans = F.zip_with(ends, lengths, lambda e, m: F.struct((e - m).alias("start"), e.alias("end")))
    if not least:
        return spans
    fits = F.transform(F.regexp_extract_all(text, pat, F.lit(1)), lambda g: F.char_length(g) >= least)
    return F.transform(F.filter(F.zip_with(spans, fits, lambda s, f: F.struct(s.alias("s"), f.alias("f"))), lambda x: x["f"]), lambda x: x["s"])


def _near(span, others) -> F.Column:
    """Whether one of ``others`` lies within the scope of ``span``."""
    return F.exists(others, lambda o: (o["start"] <= span["end"] + SCOPE) & (o["end"] + SCOPE >= span["start"]))


def _apart(spans, *others) -> F.Column:
    """The spans that none of ``others`` overlaps."""
    taken = F.concat(*others)
    return F.filter(spans, lambda s: ~F.exists(taken, lambda o: (o["start"] < s["end"]) & (o["end"] > s["start"])))


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and, by kind, the spans (code points, end exclusive) found in every whole text.

    Strong kinds are always reported: ``assign`` (a named secret with a value of 8 or more), ``access`` (key identifiers) and
    ``hex`` (32 or more). Weak kinds only where complementary parts stand within ``SCOPE`` code points, and only apart from strong
    spans: ``login`` with a secret (assign, hex or key); ``key`` (40 characters) with a key identifier or a login; ``endpoint`` with
    both an identifier (access or login) and a secret (assign, hex or key).

    Each row is worked on by itself with built-in functions: no shuffle, whatever the texts or ids. Null text counts as empty;
    rows that repeat or have no doc_id are kept as they are; other columns are left out.
    """
    none = F.array().cast(_NONE)
    body = F.col("text")
    low = F.lower(body)
    named = F.contains(low, F.lit("passw")) | F.contains(low, F.lit("secret")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("apikey")) | F.contains(low, F.lit("api_key"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    strong = rows.select(
        "doc_id", "text",
        F.when(named, matched(body, ASSIGN, 8)).otherwise(none).alias("assign"),
        F.when(F.contains(body, F.lit("AKIA")), matched(body, ACCESS)).otherwise(none).alias("access"),
        F.when(F.rlike(body, F.lit(HEX)), matched(body, HEX)).otherwise(none).alias("hex"),
    )
    logs = F.contains(low, F.lit("user")) | F.contains(low, F.lit("login")) | F.contains(low, F.lit("client")) | F.contains(low, F.lit("account"))
    login, key, endpoint = logs, F.rlike(body, F.lit(r"[A-Za-z0-9/+=]{40}")), F.contains(body, F.lit("://"))
    weak = strong.select(
        "*",
        F.when(login, _apart(matched(body, LOGIN, 3), F.col("assign"), F.col("access"), F.col("hex"))).otherwise(none).alias("logins"),
        F.when(key, _apart(matched(body, KEY), F.col("assign"), F.col("access"), F.col("hex"))).otherwise(none).alias("keys"),
        F.when(endpoint, _apart(matched(body, ENDPOINT), F.col("assign"), F.col("access"), F.col("hex"))).otherwise(none).alias("endpoints"),
    )
    secret = F.concat("assign", "hex", "keys")
    logged = weak.withColumn("login", F.filter("logins", lambda s: _near(s, secret))).drop("logins")
    keyed = logged.withColumn("key", F.filter("keys", lambda s: _near(s, F.concat("access", "login")))).drop("keys")
    secret = F.concat("assign", "hex", "key")
    return keyed.withColumn(
        "endpoint",
        F.filter("endpoints", lambda s: _near(s, F.concat("access", "login")) & _near(s, secret)),
    ).drop("endpoints")


def _ordered(kinds: tuple[str, ...]) -> F.Column:
    """The spans of the kinds by start, then by kind as listed."""

    def tagged(rank: int, kind: str) -> F.Column:
        return F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

    return F.array_sort(F.concat(*(tagged(*k) for k in enumerate(kinds))))


def _joined(kinds: tuple[str, ...]) -> F.Column:
    names = F.array(*(F.lit(k) for k in kinds))
    return F.array_join(F.transform(_ordered(kinds), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked (weak spans reported) of every row; see ``spans``."""
    return spans(docs).select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_joined(KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        _joined(KINDS).alias("spans"),
        (F.size("login") + F.size("key") + F.size("endpoint")).cast("long").alias("n_linked"),
    )


def redacted(docs: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every reported span (overlapping ones as one) replaced by ``mask`` in its text column; null stays null."""
    carried = F.struct(*(F.col(c) for c in docs.columns))
    seen = spans(docs.select(carried.alias("row"), F.col(text).alias("text")), "row", "text")
    rows = seen.withColumnRenamed("doc_id", "row")
    body = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        upto = F.greatest(s["start"] - acc["at"], F.lit(0))
        out = F.concat(acc["out"], F.substring(body, acc["at"] + 1, upto), F.when(fresh, F.lit(mask)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    every = _ordered(KINDS)
    folded = F.aggregate(every, start, step, lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.char_length(body))))
    clean = F.when(F.size(every) == 0, F.col("row")[text]).otherwise(folded)
    return rows.select(*(clean.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
