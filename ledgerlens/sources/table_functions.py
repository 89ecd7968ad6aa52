"""Operators as SQL table functions of the session: parameters, some of them optional, and lateral use."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def table_function(
    name: str,
    df: DataFrame,
    where: Mapping[str, tuple[str, str]],
    required: tuple[str, ...] = (),
    defaults: Mapping[str, str] | None = None,
) -> None:
    """``SELECT ... FROM name(...)`` over the rows of ``df``, which is planned with each call, so filters and columns reach its scans.

    ``where`` gives for each parameter, in the order of the call, its SQL type and a predicate, in which ``{}`` stands for
    the parameter and ``r`` for the rows, as ``("int", "r.case_id = {}")``. Parameters in ``required`` come first and always count; the
    others have the SQL text in ``defaults`` as their default, or NULL, and NULL means no restriction. So a call may leave them out, or name
    those it wants (``name(division => 'A')``).

    In ``FROM cases c, LATERAL name(c.case_id)`` Spark turns an equality with a required parameter into an equi-join; a column
    given for an optional parameter would have to be tried with every row, so give these constants there. The function is the
    session's own and replaces one of the same name.
    """
    defaults = defaults or {}
    for n in (name, *where):
        if not _NAME.fullmatch(n):
            raise ValueError(f"no name for a function or parameter: {n!r}")
    if unknown := {*required, *defaults} - set(where):
        raise ValueError(f"no such parameters: {sorted(unknown)}")
    if list(where)[: len(required)] != list(required):
        raise ValueError("required parameters come first")
    rows = f"{name}_rows_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(rows)
    params, tests = [], []
    for p, (kind, predicate) in where.items():
        given = f"{name}.{p}"
        test = predicate.format(given)
        params.append(f"{p} {kind}" if p in required else f"{p} {kind} DEFAULT {defaults.get(p, 'NULL')}")
        tests.append(test if p in required else f"({given} IS NULL OR {test})")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    picked = ", ".join(f"r.`{c}`" for c in df.columns)
    df.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(params)}) RETURNS TABLE ({columns}) "
        f"RETURN SELECT {picked} FROM {rows} r" + (f" WHERE {' AND '.join(tests)}" if tests else "")
    )


def overlap_function(name: str, intervals: DataFrame) -> None:
    """``name(since, until)``: the intervals that overlap a time, both ends included, either end open if it is left out.
    ``intervals``: start_time, end_time (null: open)."""
    table_function(
        name,
        intervals.filter("start_time is not null"),
        {"since": ("timestamp_ntz", "(r.end_time IS NULL OR r.end_time >= {0} OR r.start_time >= {0})"), "until": ("timestamp_ntz", "r.start_time <= {}")},
    )
