"""Periods, cases and tag sampling on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import periods as P
from ..operators import timeseries as T
from . import roles as R
from .roles import more_ctes, read, with_ctes

DAYTIME = "yyyy-MM-dd HH:mm:ss"
DUCK_DAYTIME = "'%Y-%m-%d %H:%M:%S'"


def stamp(col):
    return F.date_format(col, DAYTIME)


def reporting_period(spark, sf):
    out = P.reporting_period(read(spark, sf, "events").select("event_id", "ts"), "ts", R.shifts(spark))
    return out.select(
        "event_id", stamp("period_start").alias("period_start"), stamp("period_end").alias("period_end")
    )


def _case_rows(df):
    return df.select("case_id", "model_id", stamp("start_time").alias("start_time"), stamp("end_time").alias("end_time"))


def select_cases(spark, sf):
    return _case_rows(P.select_cases(R.cases(spark, sf), R.analyses(spark), "1997-03-01", "1997-04-01"))


def select_cases_exact(spark, sf):
    return _case_rows(P.select_cases(R.cases(spark, sf), R.analyses(spark), "1997-03-01", "1997-04-01", exact=True))


def case_kind(spark, sf):
    named = R.cases(spark, sf).join(R.analyses(spark), "analysis_id")
    out = P.case_kind(named, "span").withColumnRenamed("is_cumulative", "by_span")
    out = P.case_kind(out, "analysis_id", "month").withColumnRenamed("is_cumulative", "by_id")
    out = P.case_kind(out, "name", "Cumulative").withColumnRenamed("is_cumulative", "by_name")
    return out.select("case_id", "by_span", "by_id", "by_name")


def _kinded(spark, sf):
    return P.case_kind(R.cases(spark, sf), "analysis_id", "MONTH")


def month_to_date_cases(spark, sf):
    return P.month_to_date_cases(_kinded(spark, sf), 19970320).select("case_id")


def case_sets(spark, sf):
    """A daily and a cumulative case side by side."""
    kinded = _kinded(spark, sf)
    daily = P.case_sets(kinded, 19970320).withColumn("of_case", F.lit(19970320))
    monthly = P.case_sets(kinded, 199703).withColumn("of_case", F.lit(199703))
    return daily.union(monthly)


WEEK = ("1997-03-03 08:00:00", "1997-03-10 08:00:00")


def interval_overlap(spark, sf):
    out = T.interval_overlap(R.order_transfers(spark, sf), *WEEK)
    return out.select("transfer_id", stamp("start_time").alias("start_time"), stamp("end_time").alias("end_time"))


def _periods(cases):
    return cases.select("case_id", F.col("start_time").alias("period_start"), F.col("end_time").alias("period_end"))


def interval_overlap_periods(spark, sf):
    """Orders under way in each month of the calendar."""
    months = R.cases(spark, sf).filter("analysis_id = 'MONTH'")
    out = T.interval_overlap_periods(R.order_transfers(spark, sf), _periods(months), "case_id")
    return out.select("case_id", "transfer_id")


def interval_overlap_cases(spark, sf):
    """Transfers of some hours, or open to the end, in every day and month of the log."""
    out = T.interval_overlap_periods(R.event_transfers(spark, sf), _periods(R.log_cases(spark, sf)), "case_id", slot=3600)
    return out.select("case_id", "transfer_id")


def boundary_times(spark, sf):
    live = T.interval_overlap(R.order_transfers(spark, sf), *WEEK)
    return T.boundary_times(live, *WEEK).select(stamp("ts").alias("ts"))


def entity_tags(spark, sf):
    return T.entity_tags(
        R.order_transfers(spark, sf), R.entities(spark, sf), R.aliases(spark, sf), R.attributes(spark, sf), "MassTotal"
    )


def tag_catalog(spark, sf):
    return T.tag_catalog(R.event_documents(spark, sf), "properties", "/Properties/@TagName")


def _midnights(spark, sf):
    return read(spark, sf, "events").select(F.col("ts").cast("date").cast("timestamp_ntz").alias("ts")).distinct()


def _grid(spark, sf):
    return T.sample_grid(R.readings(spark, sf).select("tag").distinct(), _midnights(spark, sf))


def sample_grid(spark, sf):
    return _grid(spark, sf).select("tag", stamp("ts").alias("ts"))


def asof_last_value(spark, sf):
    out = T.asof_last_value(_grid(spark, sf), R.readings(spark, sf))
    return out.select("tag", stamp("ts").alias("ts"), "value")


def asof_per_event(spark, sf):
    """Irregular points: the last reading of the same tag at or before each order-like moment of the log."""
    points = read(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("T"), F.col("user_id")).alias("tag"),
        F.timestamp_add("HOUR", F.lit(-6), F.col("ts")).alias("ts"),
    )
    return T.asof_last_value(points, R.readings(spark, sf)).select("event_id", "value")


def accumulate_to(spark, sf):
    out = T.accumulate_to(_grid(spark, sf), R.readings(spark, sf), start="2024-01-08")
    return out.select("tag", stamp("ts").alias("ts"), "value")


DAY = ("2024-01-15 08:00:00", "2024-01-16 08:00:00")


def accumulate_meter(spark, sf):
    """The readings as a counter that starts again whenever it falls."""
    out = T.accumulate_to(_grid(spark, sf), R.readings(spark, sf), start="2024-01-08", mode="meter")
    return out.select("tag", stamp("ts").alias("ts"), F.round("value", 6).alias("value"))


def tag_values_at_boundaries(spark, sf):
    out = T.tag_values_at_boundaries(
        R.event_transfers(spark, sf),
        R.entities(spark, sf),
        R.aliases(spark, sf),
        R.attributes(spark, sf),
        "MassTotal",
        R.readings(spark, sf),
        *DAY,
    )
    return out.select("tag", "object_type", "alias_id", "value", stamp("ts").alias("ts"))


def snapshot_at(spark, sf):
    events = read(spark, sf, "events")
    out = T.snapshot_at(events.select("user_id"), events, "user_id", "2024-01-15 00:00:00")
    return out.select("user_id", stamp("ts").alias("ts"), "event_id", "event_type", "value")


def period_accumulation(spark, sf):
    readings = R.readings(spark, sf)
    return T.period_accumulation(readings.select("tag").distinct(), readings, "2024-01-15", 7)


def active_tag_settings(spark, sf):
    return T.active_tag_settings(R.tag_settings(spark, sf), R.tag_objects(spark, sf), "TAGID", "T_%")


def tag_id_list(spark, sf):
    tags = T.active_tag_settings(R.tag_settings(spark, sf), R.tag_objects(spark, sf), "TAGID", "M_%")
    return T.tag_id_list(tags)


QUERIES = {
    f.__name__: f
    for f in (
        reporting_period, select_cases, select_cases_exact, case_kind, month_to_date_cases, case_sets,
        interval_overlap, interval_overlap_periods, interval_overlap_cases, boundary_times, entity_tags, tag_catalog, sample_grid, asof_last_value, asof_per_event,
        accumulate_to, accumulate_meter, tag_values_at_boundaries, snapshot_at, period_accumulation, active_tag_settings, tag_id_list,
    )
}

_CASE_COLS = f"""case_id, model_id, strftime(start_time, {DUCK_DAYTIME}) AS start_time,
  strftime(end_time, {DUCK_DAYTIME}) AS end_time"""
_MTD = """SELECT c.case_id FROM cases c JOIN cases k ON k.case_id = {k}
  WHERE c.analysis_id = 'DAY' AND year(c.start_time) = year(k.start_time) AND month(c.start_time) = month(k.start_time)
    AND c.end_time <= k.end_time"""
_LIVE = f"""live AS (SELECT * FROM transfers WHERE start_time <= TIMESTAMP '{WEEK[1]}'
  AND (end_time IS NULL OR end_time >= TIMESTAMP '{WEEK[0]}'))"""
_LIVE_DAY = f"""live AS (SELECT * FROM transfers WHERE start_time <= TIMESTAMP '{DAY[1]}'
  AND (end_time IS NULL OR end_time >= TIMESTAMP '{DAY[0]}'))"""
_TAGS = """SELECT DISTINCT alt.tag, o.object_type, a.alias_id
  FROM {t} t JOIN entities o ON o.uid = t.source_uid OR o.uid = t.destination_uid
  JOIN aliases a ON (o.object_type = 'Unit' AND (a.node_id = t.source_node OR a.node_id = t.dest_node))
    OR (o.object_type = 'Tank' AND a.alias_name = 'MassTotal' AND (a.module_id = t.source_uid OR a.module_id = t.destination_uid))
  JOIN alias_tags alt ON alt.object_id = a.alias_id"""
_TIMES = """SELECT start_time AS ts FROM live UNION SELECT coalesce(end_time, TIMESTAMP '{hi}') FROM live
  UNION SELECT TIMESTAMP '{lo}' UNION SELECT TIMESTAMP '{hi}'"""
_GRID = """tags AS (SELECT DISTINCT tag FROM readings), times AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS ts FROM events),
grid AS (SELECT tag, ts FROM tags CROSS JOIN times)"""
_ACTIVE = """SELECT o.sf_id, o.sf_name, s.settings AS tag_id FROM settings s JOIN objects o ON s.af_element = o.sf_id
  WHERE lower(s.attribute) = 'tagid' AND length(trim(s.settings)) > 0 AND s.is_deleted = 0 AND o.sf_name LIKE '{like}'"""

ORACLE = {
    "reporting_period": f"""SELECT event_id, strftime(s, {DUCK_DAYTIME}) AS period_start,
  strftime(s + INTERVAL 24 HOUR, {DUCK_DAYTIME}) AS period_end
FROM (SELECT event_id, CASE WHEN hour(ts) < 8 THEN date_trunc('day', ts) - INTERVAL 40 HOUR
  ELSE date_trunc('day', ts) - INTERVAL 16 HOUR END AS s FROM events)""",
    "select_cases": with_ctes("analyses", "cases") + f"""SELECT {_CASE_COLS} FROM cases JOIN analyses USING (analysis_id)
WHERE start_time >= TIMESTAMP '1997-03-01' AND end_time <= TIMESTAMP '1997-04-01'""",
    "select_cases_exact": with_ctes("analyses", "cases") + f"""SELECT {_CASE_COLS} FROM cases JOIN analyses USING (analysis_id)
WHERE start_time = TIMESTAMP '1997-03-01' AND end_time = TIMESTAMP '1997-04-01'""",
    "case_kind": with_ctes("analyses", "cases") + """SELECT case_id,
  CAST(day(start_time) = 1 AND date_diff('day', start_time, end_time) > 1 AS INT) AS by_span,
  CAST(analysis_id = 'MONTH' AS INT) AS by_id, CAST(name = 'cumulative' AS INT) AS by_name
FROM cases JOIN analyses USING (analysis_id)""",
    "month_to_date_cases": with_ctes("cases") + _MTD.format(k=19970320),
    "case_sets": with_ctes("cases") + f"""SELECT 'current' AS role, 19970320 AS case_id, 19970320 AS of_case
UNION ALL SELECT 'previous', prev_case_id, 19970320 FROM cases WHERE case_id = 19970320
UNION ALL SELECT 'month', case_id, 19970320 FROM ({_MTD.format(k=19970320)})
UNION ALL SELECT 'opening', prev_case_id, 19970320 FROM cases WHERE case_id = (SELECT min(case_id) FROM ({_MTD.format(k=19970320)}))
UNION ALL SELECT 'current', 199703, 199703
UNION ALL SELECT 'month', 199703, 199703
UNION ALL SELECT r, prev_case_id, 199703 FROM cases, (VALUES ('previous'), ('opening')) v(r)
  WHERE case_id = (SELECT min(case_id) FROM ({_MTD.format(k=199703)}))""",
    "interval_overlap": more_ctes("order_transfers") + _LIVE + f"""
SELECT transfer_id, strftime(start_time, {DUCK_DAYTIME}) AS start_time, strftime(end_time, {DUCK_DAYTIME}) AS end_time FROM live""",
    "interval_overlap_periods": with_ctes("cases", "order_transfers") + """SELECT case_id, transfer_id FROM cases p
JOIN transfers t ON t.start_time <= p.end_time AND (t.end_time IS NULL OR t.end_time >= p.start_time) WHERE p.analysis_id = 'MONTH'""",
    "interval_overlap_cases": more_ctes("event_transfers") + """days AS (
  SELECT CAST(unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS DATE) AS d FROM events),
periods AS (SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS case_id, CAST(d AS TIMESTAMP) AS lo, CAST(d + 1 AS TIMESTAMP) AS hi FROM days
  UNION ALL SELECT DISTINCT CAST(strftime(d, '%Y%m') AS INT), CAST(date_trunc('month', d) AS TIMESTAMP),
    CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS TIMESTAMP) FROM days)
SELECT case_id, transfer_id FROM periods JOIN transfers ON start_time <= hi AND (end_time IS NULL OR end_time >= lo)""",
    "boundary_times": more_ctes("order_transfers") + _LIVE + f"""
SELECT strftime(ts, {DUCK_DAYTIME}) AS ts FROM ({_TIMES.format(lo=WEEK[0], hi=WEEK[1])})""",
    "entity_tags": with_ctes("order_transfers", "tagging") + _TAGS.format(t="transfers"),
    "tag_catalog": """SELECT DISTINCT user_id AS object_id, 'T' || user_id AS tag FROM events
WHERE user_id % 10 <> 7 AND user_id % 11 <> 5""",
    "sample_grid": more_ctes("readings") + _GRID + f" SELECT tag, strftime(ts, {DUCK_DAYTIME}) AS ts FROM grid",
    "asof_last_value": more_ctes("readings") + _GRID + f"""
SELECT g.tag, strftime(g.ts, {DUCK_DAYTIME}) AS ts, coalesce(r.value, 0) AS value
FROM grid g ASOF LEFT JOIN readings r ON g.tag = r.tag AND g.ts >= r.ts""",
    "asof_per_event": more_ctes("readings") + """points AS (
  SELECT event_id, 'T' || user_id AS tag, ts - INTERVAL 6 HOUR AS ts FROM events)
SELECT p.event_id, coalesce(r.value, 0) AS value FROM points p ASOF LEFT JOIN readings r ON p.tag = r.tag AND p.ts >= r.ts""",
    "accumulate_to": more_ctes("readings") + _GRID + f"""
SELECT g.tag, strftime(g.ts, {DUCK_DAYTIME}) AS ts, CAST(coalesce(sum(CAST(r.value AS DECIMAL(18,3))), 0) AS DOUBLE) AS value
FROM grid g LEFT JOIN readings r ON g.tag = r.tag AND r.ts <= g.ts AND r.ts >= TIMESTAMP '2024-01-08' GROUP BY g.tag, g.ts""",
    "accumulate_meter": more_ctes("readings") + _GRID + f""",
step AS (SELECT tag, ts, CAST(value AS DECIMAL(18,6)) AS v, lag(CAST(value AS DECIMAL(18,6))) OVER (PARTITION BY tag ORDER BY ts, value) AS p
  FROM readings WHERE ts >= TIMESTAMP '2024-01-08' AND value IS NOT NULL),
gain AS (SELECT tag, ts, CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE greatest(v, 0) END AS g FROM step)
SELECT g.tag, strftime(g.ts, {DUCK_DAYTIME}) AS ts, round(CAST(coalesce(sum(s.g), 0) AS DOUBLE), 6) AS value
FROM grid g LEFT JOIN gain s ON g.tag = s.tag AND s.ts <= g.ts GROUP BY g.tag, g.ts""",
    "tag_values_at_boundaries": more_ctes("readings", "event_transfers", "tagging") + _LIVE_DAY + f""",
tags AS ({_TAGS.format(t="live")}), times AS ({_TIMES.format(lo=DAY[0], hi=DAY[1])}),
grid AS (SELECT * FROM tags CROSS JOIN times),
level AS (SELECT g.*, coalesce(r.value, 0) AS value FROM (SELECT * FROM grid WHERE object_type = 'Tank') g
  ASOF LEFT JOIN readings r ON g.tag = r.tag AND g.ts >= r.ts),
amount AS (SELECT g.tag, g.object_type, g.alias_id, g.ts, CAST(coalesce(sum(CAST(r.value AS DECIMAL(18,3))), 0) AS DOUBLE) AS value
  FROM (SELECT * FROM grid WHERE object_type = 'Unit') g
  LEFT JOIN readings r ON g.tag = r.tag AND r.ts <= g.ts AND r.ts >= TIMESTAMP '{DAY[0]}' GROUP BY ALL)
SELECT tag, object_type, alias_id, value, strftime(ts, {DUCK_DAYTIME}) AS ts FROM level
UNION ALL SELECT tag, object_type, alias_id, value, strftime(ts, {DUCK_DAYTIME}) FROM amount""",
    "snapshot_at": f"""SELECT user_id, strftime(max(ts), {DUCK_DAYTIME}) AS ts, arg_max(event_id, ts) AS event_id,
  arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
FROM events WHERE ts <= TIMESTAMP '2024-01-15' GROUP BY user_id""",
    "period_accumulation": with_ctes("readings") + """SELECT tag,
  CAST(sum(CASE WHEN ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22' THEN CAST(value AS DECIMAL(18,3)) END) AS DOUBLE)
  AS accumulation FROM readings GROUP BY tag""",
    "active_tag_settings": with_ctes("tag_settings") + _ACTIVE.format(like="T_%"),
    "tag_id_list": more_ctes("tag_settings") + f"""active AS ({_ACTIVE.format(like="M_%")})
SELECT DISTINCT trim(tag_id) AS tag_id FROM active""",
}
