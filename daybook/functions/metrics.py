"""Metric expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; NULL on a zero or NULL divisor (never an ANSI error)."""
    return F.try_divide(_col(num), _col(den))


def round2(x: str | Column) -> Column:
    """HALF_UP rounding to two decimals, as the reports print money and ratios."""
    return F.round(_col(x), 2)


def pct_change(current: str | Column, base: str | Column) -> Column:
    """``round((current / base - 1) * 100, 2) || '%'``; NULL when the base is missing or 0."""
    change = F.round((ratio(current, base) - F.lit(1)) * F.lit(100), 2)
    return F.concat(change.cast("string"), F.lit("%"))


def cents_to_amount(cents_sum: str | Column) -> Column:
    """Sum of minor units (1/100) as a 2-decimal amount (double)."""
    return F.round(_col(cents_sum) / F.lit(100), 2)
