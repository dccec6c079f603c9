"""Rounding, exact sums and safe division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, halves away from zero, in binary arithmetic.

    Spark's own ``round`` goes through decimal text and differs from common databases at ties.
    """
    scale = float(10**digits)
    magnitude = F.floor(F.abs(value) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
    return F.when(value < 0, -magnitude).otherwise(magnitude) + F.lit(0.0)  # no negative zero


def exact_score_sum(score: Column) -> Column:
    """Sum of a four-decimal score that does not depend on row order.

    ``decimal(8,4)`` lets Spark add unscaled longs and still holds 10^14 after the sum.
    """
    return F.sum(score.cast("decimal(8,4)"))


def mean_of(total: Column, count: Column, digits: int) -> Column:
    return round_half_away(total.cast("double") / count, digits)


def percent_of(part: Column, whole: Column, digits: int = 1) -> Column:
    return round_half_away(F.lit(100.0) * part / whole, digits)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
