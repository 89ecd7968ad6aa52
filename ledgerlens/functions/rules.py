"""Rule tables turned into Columns and small DataFrames.

Rules (labels, ladders, name patterns, wildcard keys) are data handed in by the caller. They have a known
length on the driver, so inlining them as literals is bounded by construction.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import like_any


def rows_table(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """Literal rows as a JVM-side relation; ``schema`` is ``"name type, ..."``."""
    names = [f.split()[0] for f in schema.split(",")]
    text = json.dumps([dict(zip(names, row)) for row in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def first_match(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    if not branches:
        return default
    (cond, value), *rest = branches
    chain = F.when(cond, value)
    for cond, value in rest:
        chain = chain.when(cond, value)
    return chain.otherwise(default)


def labels(col: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Code to label; ``default`` is used for unmapped codes (their own text when omitted)."""
    default = col.cast("string") if default is None else default
    return first_match([(col == F.lit(k), F.lit(v)) for k, v in mapping.items()], default)


def ladder(col: Column, rules: Sequence[Mapping], default: Column, ci: bool = False) -> Column:
    """Ordered LIKE ladder. A rule is ``{"label", "any": [...], "all_but": [(pattern, exception), ...]}``."""
    branches = []
    for rule in rules:
        cond = like_any(col, rule.get("any", ()), ci)
        for pattern, exception in rule.get("all_but", ()):
            cond = cond | (like_any(col, [pattern], ci) & ~like_any(col, [exception], ci))
        branches.append((cond, F.lit(rule["label"])))
    return first_match(branches, default)
