"""LIKE rules as a table: the first rule that fits each row, found through an index of the rules' literal fragments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import folded
from ..sources.session import staged

GRAM = 3  # letters of a key; shorter fragments are keys of their own length
SPREAD = 64  # parts into which texts are dealt for rules without any letter
SHARE = 20_000  # texts of one key that meet a rule in one part; keys of more texts are dealt into parts
FIRST, LAST = "\u0002", "\u0003"  # stand before a key that a text must begin or end with


def _grams(text: Column, size: int) -> Column:
    """All stretches of ``size`` letters of a text, each once."""
    starts = F.sequence(F.lit(1), F.length(text) - (size - 1))
    every = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def fragments(pattern: Column) -> Column:
    """The literal stretches of a LIKE pattern between its wildcards, escapes resolved."""
    raw = F.regexp_extract_all(pattern, F.lit(r"((?:\\.|[^%_\\])+)"), F.lit(1))
    return F.transform(raw, lambda f: F.regexp_replace(f, r"\\(.)", "$1"))


def _edge(mark: str, gram: int, letters: Column) -> Column:
    """A key for the letters at an edge: the marks alone are longer than any other key."""
    return F.concat(F.lit(mark * (gram + 1)), letters)


def _rule_edges(pattern: Column, gram: int) -> Column:
    """What any text that fits begins and ends with, up to ``gram`` letters: the first fragment if no wildcard stands before it, the
    last one if none stands behind it."""
    parts = fragments(pattern)
    open_start, open_end = pattern.rlike(r"^[%_]"), pattern.rlike(r"(?s)(?:^|[^\\])(?:\\\\)*[%_]\z")
    head, tail = F.get(parts, F.lit(0)), F.get(parts, F.size(parts) - 1)
    begins = F.when(~open_start, _edge(FIRST, gram, F.left(head, F.lit(gram))))
    ends = F.when(~open_end, _edge(LAST, gram, F.right(tail, F.lit(gram))))
    return F.array_compact(F.array(begins, ends))


def _text_keys(text: Column, gram: int, kinds: set[tuple[str, int]]) -> Column:
    """The keys of a text of the given kinds: the mark (none for a stretch anywhere) and the number of letters."""
    none = F.array().cast("array<string>")
    ends = {FIRST: F.left, LAST: F.right}
    keys = [F.when(F.length(text) >= n, F.array(_edge(m, gram, ends[m](text, F.lit(n))))).otherwise(none) if m else _grams(text, n) for m, n in sorted(kinds)]
    return F.array_distinct(F.concat(none, *keys))


def _rule_grams(pattern: Column, gram: int) -> Column:
    """What any text that fits contains: the stretches of ``gram`` letters of all fragments; where no fragment is that long,
    those of the longest length there is."""
    parts = fragments(pattern)

    def of(size: int) -> Column:
        return F.array_distinct(F.flatten(F.transform(parts, lambda f: _grams(f, size))))

    longest = F.array_max(F.transform(parts, F.length))
    found = F.array().cast("array<string>")
    for size in range(1, gram + 1):
        found = F.when(longest >= size, of(size)).otherwise(found)
    return found


def _like(value: Column, pattern: Column) -> Column:
    return F.call_function("like", value, pattern)


def first_rules(
    df: DataFrame,
    col: str,
    rules: DataFrame,
    take: Sequence[str],
    also: Sequence[str] = (),
    pattern: str = "pattern",
    unless: str | None = None,
    rank: str = "rank",
    ci: bool = False,
    gram: int = GRAM,
) -> DataFrame:
    """``df`` with the columns ``take`` of the rule that fits with the smallest ``rank``; null where none does.

    A rule fits a row if ``col`` is like its ``pattern``, isn't like its ``unless``, and each column c of ``also`` is like its
    ``c_like`` and not like its ``c_unlike`` (columns of ``rules``; null is no condition). Ranks that tie are told apart by the
    pattern, then by the taken columns. A null in ``col`` fits no pattern, a null in ``also`` no condition on it. Rules
    with a null pattern or rank never fit. Patterns are those of SQL: ``%``, ``_``, and ``\\`` as escape; ``ci`` compares small letters.

    Of rules that ask for the same only the first one is tried. Every rule is filed under the rarest stretch of ``gram`` letters that a
    fitting text must contain, or begin or end with, by the number of different texts that have it. Different texts (as many as there are,
    not as many as rows) meet the rules filed under their own stretches in an equi-join, then the whole rule is checked. Texts that
    share a frequent stretch are dealt into parts of about ``SHARE`` texts, and its rules stand in each, so no task gets all of them.
    Rules without a letter, such as ``%`` or ``__``, are few by nature; they meet the texts dealt into ``SPREAD`` parts. So rules and
    texts may both be many, and no rule is compared with every row.
    """
    conditions = [c for a in also for c in (f"{a}_like", f"{a}_unlike") if c in rules.columns]
    names = [pattern, rank, *([unless] if unless else []), *conditions, *[t for t in take if t not in (pattern, rank, unless)]]
    known = rules.select(*dict.fromkeys(names)).filter(F.col(pattern).isNotNull() & F.col(rank).isNotNull())
    asked = list(dict.fromkeys([pattern, *([unless] if unless else []), *conditions]))
    given = [rank, *[c for c in known.columns if c not in asked and c != rank]]
    known = known.groupBy(*asked).agg(F.min(F.struct(*given)).alias("_given")).select(*[F.col(c) if c in asked else F.col(f"_given.{c}") for c in known.columns])
    filed = known.withColumn("_rule", F.struct(*known.columns)).select("_rule", folded(F.col(f"_rule.{pattern}"), ci).alias("_pattern"))
    filed = staged(filed.withColumn("_grams", F.concat(_rule_grams(F.col("_pattern"), gram), _rule_edges(F.col("_pattern"), gram))), "rules")

    keys = [col, *also]
    texts = staged(df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(F.lit(1).alias("_one")).drop("_one"), "rule_texts")
    low = folded(F.col(col), ci)
    wanted = filed.select(F.explode("_grams").alias("_gram")).distinct()
    mark = F.when(F.length("_gram") > gram, F.left("_gram", F.lit(1))).otherwise("")
    kinds = wanted.select(mark.alias("m"), (F.length("_gram") - F.when(mark != "", gram + 1).otherwise(0)).alias("n")).distinct()
    laid = _text_keys(low, gram, {(k.m, k.n) for k in kinds.collect()})  # at most three marks by ``gram`` lengths
    by_gram = staged(texts.select(*keys, F.explode(laid).alias("_gram")).join(wanted, "_gram", "left_semi"), "rule_grams")
    often = by_gram.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = (
        filed.select("_rule", "_pattern", F.explode("_grams").alias("_gram")).join(often, "_gram")
        .groupBy("_rule", "_pattern").agg(F.min(F.struct("_n", "_gram")).alias("_key"), F.count(F.lit(1)).alias("_found"))
    )
    # a stretch that no text has rules its rule out, so only rules all of whose stretches occur go on
    whole = rarest.join(filed.select("_rule", "_pattern", F.size("_grams").alias("_size")), ["_rule", "_pattern"]).filter("_found = _size")
    parts = F.ceil(F.col("_key._n") / F.lit(SHARE)).cast("long")
    keyed = whole.select("_rule", "_pattern", F.col("_key._gram").alias("_gram"), parts.alias("_parts"))
    asking = keyed.select("_rule", "_pattern", "_gram", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
    dealt = by_gram.join(keyed.select("_gram", "_parts").distinct(), "_gram").withColumn("_part", F.pmod(F.xxhash64(*keys), F.col("_parts")))
    indexed = dealt.drop("_parts").join(asking, ["_gram", "_part"]).drop("_gram", "_part")
    part = F.pmod(F.xxhash64(*keys), F.lit(SPREAD))
    bare = filed.filter(F.size("_grams") == 0).select("_rule", "_pattern", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("_part"))
    unfiled = texts.withColumn("_part", part).join(bare, "_part").drop("_part")

    fits = _like(low, F.col("_pattern"))
    if unless:
        fits = fits & ~F.coalesce(_like(low, folded(F.col(f"_rule.{unless}"), ci)), F.lit(False))
    for a in also:
        own = folded(F.col(a), ci)
        if f"{a}_like" in conditions:
            like = F.col(f"_rule.{a}_like")
            fits = fits & (like.isNull() | F.coalesce(_like(own, folded(like, ci)), F.lit(False)))
        if f"{a}_unlike" in conditions:
            like = F.col(f"_rule.{a}_unlike")
            fits = fits & (like.isNull() | F.coalesce(~_like(own, folded(like, ci)), F.lit(False)))
    order = F.struct(F.col(f"_rule.{rank}"), F.col(f"_rule.{pattern}"), *[F.col(f"_rule.{t}") for t in take])
    met = indexed.unionByName(unfiled).filter(fits)
    best = met.groupBy(*keys).agg(F.min(F.struct(order.alias("o"), F.col("_rule"))).alias("_best"))
    found = best.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(f"_best._rule.{t}").alias(t) for t in take])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.drop(*[t for t in take if t in df.columns]).join(found, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def classify_by_rules(df: DataFrame, col: str, rules: DataFrame, default: Column, out: str, **how) -> DataFrame:
    """``classify_by_name`` with the ladder as a table: the ``label`` of the first rule that fits, else ``default``."""
    found = first_rules(df, col, rules.withColumnRenamed("label", "_label"), ["_label"], **how)
    return found.withColumn(out, F.coalesce("_label", default)).drop("_label")
