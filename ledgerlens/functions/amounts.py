"""Amounts are summed as decimals, so a total does not depend on the order rows arrive in."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,12)"  # up to 26 digits before the point: small and large amounts alike keep their value
MONEY = "decimal(18,3)"
TICKS = 1e4


def exact(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(EXACT)


def money(col: Column) -> Column:
    return col.cast(MONEY)


def zero() -> Column:
    return F.lit(0).cast(MONEY)


def or_zero(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, zero())


def _ticks(x: Column) -> tuple[Column, Column]:
    """Ten-thousandths of a double, and whether its exact decimal is so many of them.

    From 1024 on neighbouring doubles are further apart than the difference allowed, so they must be equal; below, the difference, the
    rounding of both and that of the shortest digits stay under half of the twelfth place. A thousand million amounts under the
    bound have a sum that a long holds.
    """
    n = F.rint(x * TICKS)
    return n, (F.abs(x - n / TICKS) <= 1e-13) & (F.abs(n) < 2.0**33)


def nearest(col: Column | str, whole: Column | None = None) -> Column:
    """The double nearest to a double's exact decimal; ``whole``: where it is known to be ten-thousandths, which need no decimal."""
    x = F.col(col) if isinstance(col, str) else col
    plain = exact(x).cast("double")
    return plain if whole is None else F.when(whole, _ticks(x)[0] / TICKS).otherwise(plain)


def all_whole(cols: Iterable[str]) -> Column:
    """Whether the doubles are ten-thousandths or null."""
    return reduce(and_, [F.coalesce(_ticks(F.col(c))[1], F.lit(True)) for c in cols])


def exact_sum(col: Column | str) -> Column:
    """The sum of the exact decimals of doubles; those of ten-thousandths are added up as whole numbers."""
    x = F.col(col) if isinstance(col, str) else col
    n, whole = _ticks(x)
    ticks = F.sum(F.when(whole, n.cast("bigint"))).cast("decimal(20,0)") * F.lit(Decimal("0.0001"))
    rest = F.sum(F.when(~whole, exact(x))).cast("decimal(37,12)")  # one digit less, so that the sum of both keeps its places
    return F.coalesce(ticks + rest, ticks, rest).cast(EXACT)


def total(col: Column | str) -> Column:
    """Sum rounded to ledger places; null when there is nothing to sum."""
    return F.sum(exact(col)).cast(MONEY)
