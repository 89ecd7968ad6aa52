"""Text helpers: blank handling, prefixes, LIKE groups."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def text_before(col: Column, delimiter: str) -> Column:
    """Trimmed text left of the first delimiter; the whole text when it is absent."""
    at = F.locate(delimiter, col)
    return F.when(at > 0, F.trim(F.left(col, at - 1))).otherwise(col)


def folded(col: Column, ci: bool) -> Column:
    return F.lower(col) if ci else col


def like_any(col: Column, patterns: Iterable[str], ci: bool = False) -> Column:
    match = [col.ilike(p) if ci else col.like(p) for p in patterns]
    return reduce(lambda a, b: a | b, match) if match else F.lit(False)


def like_none(col: Column, patterns: Iterable[str], ci: bool = False) -> Column:
    return ~like_any(col, patterns, ci)


def one_of(col: Column, values: Iterable[str], ci: bool = False) -> Column:
    values = [v.lower() for v in values] if ci else list(values)
    return folded(col, ci).isin(values) if values else F.lit(False)
