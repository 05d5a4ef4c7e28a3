"""Ratios and exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Row ratios carry four decimals; 22 integer digits hold the largest possible
# ratio of two 64-bit counters, so the cast cannot overflow, and a sum of them
# keeps ten more digits.
EXACT_RATIO = "decimal(26,4)"


def per_hundred(part: Column, whole: Column) -> Column:
    """``part`` per hundred of ``whole`` with four decimals; 0.0 unless whole > 0."""
    return F.when(whole > 0, F.round(part / whole * 100, 4)).otherwise(F.lit(0.0))


def as_exact(ratio: Column) -> Column:
    """A four-decimal ratio as a decimal, so sums do not depend on row order."""
    return ratio.cast(EXACT_RATIO)


def exact_sum(ratio: Column) -> Column:
    """Sum of four-decimal ratios, exact whatever the row order.

    Ratios below 10,000 are summed as whole ten-thousandths in 64 bits, which
    hold 9e10 of them; only larger ones need decimals, which cost an object per row.
    """
    small = F.sum(F.when(F.abs(ratio) < 10_000, F.round(ratio * 10_000).cast("long")))
    large = F.sum(F.when(F.abs(ratio) >= 10_000, as_exact(ratio)))
    zero = F.lit(0).cast("decimal(20,0)")
    units = F.coalesce(small.cast("decimal(20,0)"), zero) * F.lit("0.0001").cast("decimal(5,4)")
    return units + F.coalesce(large, zero)


def ratio_half_up(numerator: Column, denominator: Column, scale: int) -> Column:
    """``numerator / denominator`` rounded half-up (away from zero), exactly.

    Works on integers throughout: binary fractions and intermediate decimal
    scales would move ties.  NULL when the denominator is zero or NULL.
    Meant for aggregated rows, not for the scan.
    """
    shift = F.lit(10**scale).cast("decimal(10,0)")
    top = (F.abs(numerator) * shift).cast("decimal(37,0)")
    bottom = F.abs(denominator).cast("decimal(20,0)")
    doubled = (top * 2 + bottom).cast("decimal(38,0)")
    step = (bottom * 2).cast("decimal(21,0)")
    units = ((doubled - doubled % step) / step).cast("double")
    sign = F.signum(numerator.cast("double")) * F.signum(denominator.cast("double"))
    # Adding zero turns a negative zero into a plain one.
    return F.when(denominator != 0, sign * units / F.lit(float(10**scale)) + F.lit(0.0))
