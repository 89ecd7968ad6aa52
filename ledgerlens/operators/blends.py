"""Blended products: one config row per product instead of one code block per product."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import money, or_zero, total, zero
from .report import MEASURES, literal_row


@dataclass(frozen=True)
class Blend:
    """How one product's blend row is built.

    daily: "abs" or "plain" (earlier stock + arrivals - stock, with or without sign), "coming" (ledger).
    shipped_day: "day", or "by_kind" (day for a daily case, accumulated otherwise).
    shipped_month: "rest" (opening + month - stock), "month" (the month production), "none" (0).
    opening: "opening" (ledger of the opening case), or "by_kind" (ledger's own opening if cumulative).
    """

    product: str
    name: str
    pattern: str
    opening_pattern: str | None = None
    daily: str = "abs"
    shipped_day: str = "day"
    shipped_month: str = "rest"
    opening: str = "opening"
    rewrite_base: bool = True
    literal: bool = False


LEDGER = {"day": "measured_day", "accum": "measured_accum", "end": "end_mass", "open": "open_mass", "coming": "coming_mix"}


def ledger_sums(blends: Sequence[Blend], ledger: DataFrame, current: int, opening: int | None) -> DataFrame:
    """(product, l_day, l_accum, l_end, l_open, l_coming, l_opening) per blend, by name pattern.

    One scan with conditional sums for all patterns, turned into rows afterwards: no pattern join.
    """
    used = ledger.filter(F.col("case_id").isin([c for c in (current, opening) if c is not None]))
    now, before = F.col("case_id") == current, F.col("case_id") == F.lit(opening).cast("int")
    sums = []
    for i, b in enumerate(blends):
        named = F.col("name").ilike(b.pattern)
        sums += [total(F.when(now & named, F.col(c))).alias(f"{k}_{i}") for k, c in LEDGER.items()]
        opened = F.col("name").ilike(b.opening_pattern or b.pattern)
        sums.append(total(F.when(before & opened, money(F.col("end_mass")))).alias(f"opening_{i}"))
    rows = [
        F.struct(
            F.lit(b.product).alias("product"),
            *[F.col(f"{k}_{i}").alias(f"l_{k}") for k in (*LEDGER, "opening")],
        )
        for i, b in enumerate(blends)
    ]
    return used.agg(*sums).select(F.inline(F.array(*rows)))


def _pick(blends: Sequence[Blend], attribute: str, formulas: dict[str, Column]) -> Column:
    """The formula each product's config names."""
    out = F.lit(None).cast("decimal(18,3)")
    for value, formula in formulas.items():
        products = [b.product for b in blends if getattr(b, attribute) == value]
        if products:
            out = F.when(F.col("product").isin(products), money(formula)).otherwise(out)
    return out


def blend_balance(
    df: DataFrame,
    blends: Sequence[Blend],
    sums: DataFrame,
    arrivals: DataFrame,
    daily_case: bool,
) -> DataFrame:
    """Adds a blend row per base row of a configured product and rewrites the base row where configured.

    ``sums`` from ``ledger_sums``; ``arrivals``: product, day_total, month_total, one row per product. A rewrite leaves alone
    what the blend row reads, so base and blend come out of one projection over one joined row.
    """
    variants = [b for b in blends if not b.literal]
    arrived = arrivals.select("product", F.col("day_total").alias("_day"), F.col("month_total").alias("_month"))
    joined = df.join(sums, "product", "left").join(arrived, "product", "left")
    stock = or_zero("measured")
    day_gap = money(or_zero("measured_old") + or_zero(money(F.col("_day"))) - stock)
    month_gap = money(or_zero("measured_start") + or_zero(money(F.col("_month"))) - stock)

    daily = _pick(variants, "daily", {"abs": F.abs(day_gap), "plain": day_gap, "coming": F.col("l_coming")})
    month = money(F.abs(month_gap))
    opening = _pick(
        variants,
        "opening",
        {"opening": F.col("l_opening"), "by_kind": F.col("l_opening" if daily_case else "l_open")},
    )
    shipped_day = _pick(
        variants,
        "shipped_day",
        {"day": F.col("l_day"), "by_kind": F.col("l_day" if daily_case else "l_accum")},
    )
    shipped_month = _pick(
        variants, "shipped_month", {"rest": opening + month - F.col("l_end"), "month": month, "none": F.lit(0)}
    )
    names = F.lit(None).cast("string")
    for b in variants:
        names = F.when(F.col("product") == b.product, F.lit(b.name)).otherwise(names)
    blend_values = {
        "product": names,
        "produced_day": daily,
        "produced_month": month,
        "shipped_day": shipped_day,
        "shipped_month": shipped_month,
        "measured": F.col("l_end"),
        "measured_start": opening,
    }
    rewritten = F.coalesce(F.col("product").isin([b.product for b in variants if b.rewrite_base]), F.lit(False))
    base_values = {
        "produced_day": money(F.col("_day")),
        "produced_month": money(F.col("_month")),
        "shipped_day": F.abs(day_gap),
        "shipped_month": F.abs(month_gap),
    }
    base = F.struct(
        *[
            (F.when(rewritten, base_values[c]).otherwise(F.col(c)) if c in base_values else F.col(c)).alias(c)
            for c in ("product", *MEASURES)
        ]
    )
    blend = F.struct(*[money_or_text(c, blend_values).alias(c) for c in ("product", *MEASURES)])
    blended = F.coalesce(F.col("product").isin([b.product for b in variants]), F.lit(False))
    out = joined.select(F.inline(F.when(blended, F.array(base, blend)).otherwise(F.array(base))))
    for b in blends:
        if b.literal:
            out = literal_row(out, b.name, {})
    return out


def money_or_text(column: str, values: dict[str, Column]) -> Column:
    if column == "product":
        return values[column]
    return money(values[column]) if column in values else zero()
