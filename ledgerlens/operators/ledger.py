"""Ledger corrections driven by task and rule tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import exact
from ..functions.rules import rows_table


def lookup_measure(
    tasks: DataFrame, view: DataFrame, keys: Mapping[str, str], value: str, order: str, task_id: str = "task_id"
) -> DataFrame:
    """Tasks with ``new_value``: per task the value found under its key (task column -> view column).

    Several rows under one key: the one smallest by ``order``. The view is reduced per key before it
    meets the tasks, so a key that repeats without end costs one row.
    """
    found = view.groupBy(*keys.values()).agg(F.min_by(value, order).alias("new_value"))
    renamed = found.select(*[F.col(v).alias(t) for t, v in keys.items()], "new_value")
    return tasks.join(renamed, list(keys), "left")


def live_transactions(
    tx: DataFrame,
    cases: DataFrame,
    analyses: DataFrame,
    objects: DataFrame,
    object_types: DataFrame,
    products: DataFrame,
    case_type: str,
    source_types: Sequence[str],
    case_id: int | None = None,
) -> DataFrame:
    """Transactions of cases of one type whose own object, source (of an allowed type), destination and
    both products are alive. Only existence matters, so every test is a semi-join."""
    if case_id is not None:
        tx, cases = tx.filter(F.col("case_id") == case_id), cases.filter(F.col("case_id") == case_id)
    typed_cases = cases.join(analyses.filter(F.col("name") == case_type), "analysis_id", "left_semi")
    alive = objects.filter(F.col("is_deleted") != 1)
    allowed = object_types.filter(F.col("code_name").isin(list(source_types)))
    sources = alive.join(allowed, alive["object_type_id"] == allowed["id"], "left_semi")
    goods = products.filter(F.col("is_deleted") != 1)

    def exists(df: DataFrame, column: str, side: DataFrame, key: str = "id") -> DataFrame:
        wanted = side.select(F.col(key).alias("_id"))
        return df.join(wanted, F.col(column) == F.col("_id"), "left_semi")

    kept = exists(tx, "case_id", typed_cases, "case_id")
    kept = exists(kept, "product_id", goods)
    kept = exists(kept, "second_product_id", goods)
    kept = exists(kept, "source_id", sources)
    kept = exists(kept, "dest_id", alive)
    return exists(kept, "id", alive)


def reassign_measure(tx: DataFrame, live: DataFrame, tasks: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """All transactions, with ``measured``/``reconciled`` rewritten where a task applies.

    A transaction is known by (case_id, id): ids recur across cases, and every case is corrected by itself.
    ``tasks``: task_id, target key columns (``keys``: task column -> transaction column), new_value.
    Every live match is zeroed, the lowest id of a task in a case gets the value. Tasks without value or
    without rows do nothing; where several tasks share a target the last one (highest task_id) decides.
    """
    targets, one = list(keys), ["case_id", "id"]
    last = (
        tasks.filter(F.col("new_value").isNotNull())
        .groupBy(*targets)
        .agg(F.max("task_id").alias("task_id"), F.max_by("new_value", "task_id").alias("new_value"))
    )
    on_tx = last.select(*[F.col(t).alias(keys[t]) for t in targets], "task_id", "new_value")
    matched = live.select(*one, *keys.values()).join(on_tx, list(keys.values()))
    # a transaction that is listed twice, or under two keys, is still one: the last task decides
    hits = matched.groupBy(*one).agg(
        F.max("task_id").alias("task_id"), F.max_by("new_value", "task_id").cast("double").alias("_new")
    )
    firsts = hits.groupBy("case_id", "task_id").agg(F.min(F.struct("id", "_new")).alias("_first"))
    firsts = firsts.select("case_id", "_first.id", F.col("_first._new").alias("_value"))
    marks = hits.select(*one, F.lit(1).alias("_hit")).join(firsts, one, "left")
    joined = tx.join(marks, one, "left")
    hit = F.col("_hit").isNotNull()
    new = {"measured": F.coalesce("_value", F.lit(0.0)), "reconciled": F.lit(0.0)}
    return joined.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in tx.columns])


def wildcard_rule_sum(
    rules: Sequence[Mapping] | DataFrame,
    facts: DataFrame,
    wild_keys: Sequence[str],
    exact_key: str,
    value: str,
    target: str = "target_id",
) -> DataFrame:
    """(target, sum_value): sum of the facts each rule catches. In ``wild_keys`` a rule's 0 means any
    value, ``exact_key`` must be equal (a rule's null reads as 0). Targets without facts are absent.

    Each fact is written out once per wildcard pattern in use, with the wild keys blanked to 0. Those that meet
    a rule are summed per masked key with map-side combine, so that the key "anything" is one row however many
    rules ask for it, and the sums meet the rules in an equi-join. One scan of the facts, no disjunctive join,
    one plan for any number of rules; the patterns in use are at most 2^keys numbers.
    """
    types = dict(facts.dtypes)
    if not isinstance(rules, DataFrame):
        columns = [*wild_keys, exact_key, target]
        schema = ", ".join(f"{c} {types.get(c, 'bigint')}" for c in columns)
        rules = rows_table(facts.sparkSession, schema, [[r[c] for c in columns] for r in rules])
    code = reduce(lambda a, b: a + b, [F.when(F.col(k) == 0, F.lit(1 << i)).otherwise(0) for i, k in enumerate(wild_keys)])
    keyed = rules.select(
        code.alias("_pattern"),
        *[F.col(k).cast(types[k]).alias(k) for k in wild_keys],
        F.coalesce(F.col(exact_key), F.lit(0)).cast(types[exact_key]).alias(exact_key),
        target,
    )
    match = ["_pattern", *wild_keys, exact_key]
    patterns = keyed.agg(F.collect_set("_pattern")).scalar()
    amount = F.coalesce(exact(value), F.lit(0)).alias("_amount")
    laid = facts.withColumn("_patterns", patterns).select(F.explode("_patterns").alias("_pattern"), *wild_keys, exact_key, amount)
    masked = laid.select(
        "_pattern",
        *[
            F.when(F.col("_pattern").bitwiseAND(F.lit(1 << i)) != 0, F.lit(0).cast(types[k])).otherwise(F.col(k)).alias(k)
            for i, k in enumerate(wild_keys)
        ],
        exact_key,
        "_amount",
    )
    sums = masked.join(keyed.select(*match), match, "left_semi").groupBy(*match).agg(F.sum("_amount").alias("_amount"))
    return sums.join(keyed, match).groupBy(target).agg(F.sum("_amount").cast("double").alias("sum_value"))


def apply_incoming(ledger: DataFrame, sums: DataFrame, kinds: DataFrame, case_id: int | None = None) -> DataFrame:
    """Ledger rows that have a sum get coming_mix = sum and end_mass = open + sum - what was measured
    (accumulated for a cumulative case, daily otherwise). ``kinds``: case_id, is_cumulative.
    All right-hand sides read the row as it was."""
    got = sums.select(F.col("target_id").alias("id"), "sum_value")
    joined = ledger.join(got, "id", "left").join(kinds.select("case_id", "is_cumulative"), "case_id", "left")
    measured = F.when(F.col("is_cumulative") == 1, F.coalesce("measured_accum", F.lit(0.0))).otherwise(
        F.coalesce("measured_day", F.lit(0.0))
    )
    hit = F.col("sum_value").isNotNull() & F.col("is_cumulative").isNotNull()
    if case_id is not None:
        hit = hit & (F.col("case_id") == case_id)
    new = {
        "coming_mix": F.col("sum_value"),
        "end_mass": F.col("open_mass") + F.col("sum_value") - measured,
    }
    return joined.select(
        *[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in ledger.columns]
    )


def override_rows(df: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    """Rows meeting the condition get columns set from constants or expressions over the old row."""
    types = dict(df.dtypes)

    def new(column: str) -> Column:
        v = values[column]
        v = v if isinstance(v, Column) else F.lit(v)
        return F.when(condition, v.cast(types[column])).otherwise(F.col(column)).alias(column)

    return df.select(*[new(c) if c in values else F.col(c) for c in df.columns])


def upsert_measures(
    target: DataFrame,
    source: DataFrame,
    on: tuple[str, str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
    defaults: Mapping[str, object],
) -> DataFrame:
    """Matched target rows get ``update``, unmatched source rows become rows from ``insert`` over ``defaults``.

    ``on`` = (target key, source key), the source key unique. A full outer join: the target, which may
    stand for a long computation, is read once.
    """
    key, source_key = on
    types = dict(target.dtypes)
    side = source.withColumnRenamed(source_key, "_key").withColumn("_sent", F.lit(1))
    joined = target.withColumn("_held", F.lit(1)).join(side, F.col(key) == F.col("_key"), "full")
    held, sent = F.col("_held").isNotNull(), F.col("_sent").isNotNull()

    def value(c: str) -> Column:
        kept = F.when(sent, update[c].cast(types[c])).otherwise(F.col(c)) if c in update else F.col(c)
        new = F.col("_key") if c == key else insert.get(c, F.lit(defaults.get(c)))
        return F.when(held, kept).otherwise(new.cast(types[c])).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def latest_changes(changes: DataFrame, members: DataFrame, min_case: int) -> DataFrame:
    """(case_id, group_id, seq, new_value): the last change of a group's member per case.

    ``changes``: id, case_id, measured, seq (rows where ``measured`` was written). Cases before the
    cut-off are skipped. Changes are reduced per meter with map-side combine before they meet the
    members, so a meter that changes without end costs one row per case.
    """
    per_meter = (
        changes.filter(F.col("case_id") >= min_case)
        .groupBy("case_id", "id")
        .agg(F.max_by("measured", "seq").alias("measured"), F.max("seq").alias("seq"))
    )
    return (
        per_meter.join(members.select("id", "group_id"), "id")
        .groupBy("case_id", "group_id")
        .agg(F.max("seq").alias("seq"), F.max_by("measured", "seq").alias("new_value"))
    )


def spread_changes(meters: DataFrame, latest: DataFrame, members: DataFrame) -> DataFrame:
    """Meters of a changed group take the group's value in the same case, where null or different.
    Adds ``synced`` (1 where the value was written). A null value spreads nowhere.

    The values are laid out per member first: one join on (case, id), and meters outside every group do
    not pile up under a null key.
    """
    values = (
        latest.filter(F.col("new_value").isNotNull())
        .join(members.select("id", "group_id"), "group_id")
        .select("case_id", "id", "new_value")
    )
    known = meters.join(values, ["case_id", "id"], "left")
    hit = F.col("new_value").isNotNull() & (
        F.col("measured").isNull() | (F.col("measured") != F.col("new_value"))
    )
    written = F.when(hit, F.col("new_value")).otherwise(F.col("measured"))
    return known.select(
        *[written.alias(c) if c == "measured" else F.col(c) for c in meters.columns],
        F.when(hit, F.lit(1)).otherwise(F.lit(0)).alias("synced"),
    )


def sync_group(meters: DataFrame, changes: DataFrame, members: DataFrame, min_case: int) -> DataFrame:
    """A change of one member of a meter group reaches all members of the same case."""
    return spread_changes(meters, latest_changes(changes, members, min_case), members)


def change_log(changes: DataFrame, members: DataFrame, min_case: int) -> DataFrame:
    """(seq, step, info) per change: started, then skipped with the reason, or applied with the values,
    then finished. A skipped change ends there; a meter of no group starts and finishes only."""
    grouped = changes.join(members.select("id", "group_id"), "id", "left")
    member = F.col("group_id").isNotNull()
    early = F.col("case_id") < min_case
    skipped = F.when(member & early, F.concat(F.lit("skipped: case "), F.col("case_id"), F.lit(f" < {min_case}")))
    applied = F.when(
        member & ~early,
        F.concat(F.lit("applied: value "), F.col("measured"), F.lit(", case "), F.col("case_id")),
    )
    finished = F.when(~(member & early), F.lit("finished"))
    steps = F.array(F.lit("started"), skipped, applied, finished)
    return grouped.select("seq", F.posexplode(steps).alias("step", "info")).filter(F.col("info").isNotNull())
