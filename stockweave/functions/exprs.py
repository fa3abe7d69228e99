"""Scalar expressions shared by the feature, cascade and metric operators.

All are plain Column arithmetic, so they stay inside whole-stage codegen and
are safe under ANSI mode (no division by zero can be reached).

Ratios of integers are rounded as ``round(100 * x / y) / 100``: one rounding
of one correctly rounded quotient, which gives the same value on any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column) -> Column:
    """A double rounded to a whole one, halves away from zero: the value of ``round(x)``, which
    goes through a decimal for each row.  ``x`` less its nearest whole number is exact."""
    near = F.rint(x)
    rest = x - near
    return F.when((rest == 0.5) & (x > 0), near + 1).when((rest == -0.5) & (x < 0), near - 1).otherwise(near)


def fixed_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """num / den rounded to ``digits`` places; null when den is 0 or either is null."""
    scale = float(10**digits)
    return F.round(F.try_divide(F.lit(scale) * num, den.cast("double"))) / F.lit(scale)


def ratio(up: Column, down: Column) -> Column:
    """up/down, or 100 where the quotient has no meaning (null operand, zero divisor)."""
    return F.coalesce(fixed_ratio(up, down), F.lit(100.0))


def divide(hist: Column, cur: Column, k: int) -> Column:
    """Current level over the historic level scaled down by ``k``; 100 without history."""
    return F.coalesce(fixed_ratio(F.lit(k) * cur, hist), F.lit(100.0))


def ratio_neg(up: Column, down: Column) -> Column:
    """Signed ratio: a zero divisor gives +100 or -100 by the sign of ``up``; nulls give -100."""
    return F.coalesce(
        fixed_ratio(up, down),
        F.when((down == 0) & (up >= 0), F.lit(100.0)),
        F.lit(-100.0),
    )


def min_max(x: Column, low: Column, high: Column) -> Column:
    """Position of x in [low, high] with two decimals; null on a zero range."""
    return fixed_ratio(x - low, high - low)


def floor_zero(x: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(x < 0, F.lit(0)).otherwise(x)


def shrinkage(adjustment: Column) -> Column:
    """Size of a negative adjustment, else 0."""
    return F.when(adjustment < 0, -adjustment).otherwise(F.lit(0)).cast("bigint")


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def footfall_bin(scale: Column) -> Column:
    """Ten right-closed bins over (0, 1]; 0 and null fall into bin 1."""
    hundredths = F.round(scale * 100).cast("int")
    return F.coalesce(F.greatest(F.ceil(hundredths / F.lit(10.0)).cast("int"), F.lit(1)), F.lit(1))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; null on an empty whole."""
    return F.round(F.try_divide(F.lit(10000.0) * part, whole.cast("double"))) / F.lit(100.0)


def percent_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(percent(part, whole), F.lit(0.0))
