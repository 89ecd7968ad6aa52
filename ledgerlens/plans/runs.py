"""Runs: from their inputs to stored tables, the way a schedule starts them.

Each run writes complete tables through a sink and gives back what it reads from there. Paths are the
caller's; a failed run leaves the old content.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import midnights_between, ntz
from ..operators import ledger as L
from ..operators import snapshots as S
from ..operators import timeseries as T
from ..operators.periods import reporting_period
from ..sources import merge, sinks


class RunError(RuntimeError):
    """What a run raises after its errors are stored."""


def _reloaded(df: DataFrame, path: str) -> DataFrame:
    sinks.full_reload(df, path)
    return df.sparkSession.read.parquet(path)


def _of_case(ledger: DataFrame, case_id: int, correct: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """One case of a ledger that is stored by case, corrected: its partition is written again, no other. The first time, when
    nothing is stored yet, the whole ledger is."""
    if not merge.Store(ledger.sparkSession, path).exists():
        merge.store(ledger, path, ["case_id"])
    own = correct(ledger.filter(F.col("case_id") == case_id))
    merge.replace_partitions(own, path, ["case_id"], emptied=[{"case_id": case_id}])
    return ledger.sparkSession.read.schema(ledger.schema).parquet(path)


def sampling_run(
    as_of: str,
    shifts: DataFrame,
    transfers: DataFrame,
    entities: DataFrame,
    aliases: DataFrame,
    attributes: DataFrame,
    alias_name: str | Column,
    readings: DataFrame,
    current: str,
    backup: str,
) -> DataFrame:
    """Tag values of the last closed period: they become the current table, and the day's part of the backup
    (rows past midnight stay with the day the period began; a re-run replaces them)."""
    moment = transfers.sparkSession.range(0, 1, 1, 1).select(ntz(as_of).alias("ts"))
    period = reporting_period(moment, "ts", shifts).first()
    start, end = str(period.period_start), str(period.period_end)
    values = T.tag_values_at_boundaries(transfers, entities, aliases, attributes, alias_name, readings, start, end)
    stored = _reloaded(values, current)
    sinks.replace_day(stored, backup, start[:10])
    return stored


def remains_run(
    settings: DataFrame,
    objects: DataFrame,
    states: DataFrame,
    at: str,
    target: str,
    errors: str,
    attribute: str = "TagID",
    name_like: str = "T_%",
    point: str = "sampling_point_id",
) -> DataFrame:
    """State of every sampling point as of a time, defaults for what is unknown, as the current table.

    Points come out of the settings as text. Those that are no number go to the error log; the others are
    loaded, and then the run raises. The settings are read once: one job tells the points apart and counts them."""
    ids = T.tag_id_list(T.active_tag_settings(settings, objects, attribute, name_like))
    number = F.col("tag_id").try_cast("bigint")
    points = S.split_once(ids, {"id of a sampling point is no number": number.isNotNull()})
    found = T.snapshot_at(points.good.select(number.alias(point)), states, point, at)
    stored = _reloaded(S.fill_defaults(found, S.typed_defaults(found, skip=[point])), target)
    if points.failed:
        named = points.bad.select(F.concat_ws(": ", "error_message", "tag_id").alias("error_message"))
        sinks.append_errors(named, errors)
        raise RunError(f"{points.failed} of {points.rows} sampling points were left out, see {errors}")
    return stored


def accumulation_run(
    case_id: int, cases: DataFrame, settings: DataFrame, objects: DataFrame, readings: DataFrame, target: str,
    attribute: str = "TagID", name_like: str = "M_%",
) -> DataFrame:
    """Accumulated quantity of every tag of the settings over the days of a case, once each, as the current
    table. ``readings``: tag_id, ts, value (and what else describes a tag). Fails before anything is written
    when the case, its days or the tags are missing."""
    case = cases.filter(F.col("case_id") == case_id)
    S.require(case, f"case {case_id} has no start")
    days = F.abs(midnights_between(F.col("start_time"), F.col("end_time")))
    row = S.require(case.filter(days >= 1), f"case {case_id} has no whole day").select("start_time", days.alias("days")).first()
    ids = T.tag_id_list(T.active_tag_settings(settings, objects, attribute, name_like))
    S.require(ids, "no tags to accumulate")
    sums = T.period_accumulation(ids, readings, str(row.start_time), row.days, by="tag_id")
    filled = S.fill_defaults(sums, {"accumulation": 0.0})
    return _reloaded(S.dedupe_exact(filled, ["tag_id", "accumulation"]), target)


def restore_run(spark: SparkSession, backup: str, current: str, year: int, month: int, day: int, days: int, ts: str = "ts") -> DataFrame:
    """The backup's rows of some days become the current table, all of them or none."""
    return _reloaded(S.restore_range(spark.read.parquet(backup), year, month, day, days, ts).drop("run_date"), current)


def reassign_run(
    case_id: int,
    case_type: str,
    tasks: DataFrame,
    view: DataFrame,
    source: Mapping[str, str],
    value: str,
    order: str,
    tx: DataFrame,
    goal: Mapping[str, str],
    cases: DataFrame,
    analyses: DataFrame,
    objects: DataFrame,
    object_types: DataFrame,
    products: DataFrame,
    source_types: Sequence[str],
    target: str,
    by_case: bool = False,
) -> DataFrame:
    """Measures moved between transactions of one case: look-up of the new values in that case (``view`` has
    case_id and case_type), its live transactions, rewriting. The whole ledger is stored, other cases as they were;
    with ``by_case`` it is stored by case and only the case's own partition is written (``tx`` may be read from there)."""
    seen = view.filter((F.col("case_id") == case_id) & (F.col("case_type") == case_type))
    looked = L.lookup_measure(tasks, seen, source, value, order)
    live = L.live_transactions(tx, cases, analyses, objects, object_types, products, case_type, source_types, case_id)
    if by_case:
        return _of_case(tx, case_id, lambda own: L.reassign_measure(own, live, looked, goal), target)
    return _reloaded(L.reassign_measure(tx, live, looked, goal), target)


def incoming_run(
    case_id: int,
    rules: Sequence[Mapping] | DataFrame,
    facts: DataFrame,
    wild_keys: Sequence[str],
    exact_key: str,
    value: str,
    ledger: DataFrame,
    kinds: DataFrame,
    reset_like: str,
    target: str,
    by_case: bool = False,
) -> DataFrame:
    """Received quantities of one case by wildcard rules, applied to its ledger rows; rows of names that match
    ``reset_like`` start anew from what came in. The whole ledger is stored, other cases as they were; ``by_case`` as above."""
    of_case = facts.filter(F.col("case_id") == case_id)
    sums = L.wildcard_rule_sum(rules, of_case, wild_keys, exact_key, value)
    reset = (F.col("case_id") == case_id) & F.coalesce(F.col("name").like(reset_like), F.lit(False))
    new = {"open_mass": 0, "measured_day": F.col("coming_mix"), "measured_accum": F.col("coming_mix"), "end_mass": 0}

    def corrected(rows: DataFrame) -> DataFrame:
        return L.override_rows(L.apply_incoming(rows, sums, kinds, case_id), reset, new)

    return _of_case(ledger, case_id, corrected, target) if by_case else _reloaded(corrected(ledger), target)
