"""Window columns over aggregates (few rows per app, never raw reviews)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numbers import round_half_away


def change_vs_previous(value: str, group: Sequence[str], order: Sequence[Column], digits: int) -> Column:
    """Difference to the previous row of the group, rounded."""
    ordered = Window.partitionBy(*group).orderBy(*order)
    return round_half_away(F.col(value) - F.lag(value).over(ordered), digits)


def rolling_rows_mean(value: str, group: Sequence[str], order: Sequence[Column], rows: int, digits: int) -> Column:
    """Unweighted mean of this row and the ``rows - 1`` before it."""
    frame = Window.partitionBy(*group).orderBy(*order).rowsBetween(1 - rows, 0)
    return round_half_away(F.avg(value).over(frame), digits)


def trailing_months_mean(
    daily: DataFrame, month_ends: DataFrame, group: Sequence[str], months: int, digits: int
) -> DataFrame:
    """Mean of daily means over (end - months, end] for each month end.

    ``daily`` has group columns, ``day`` and ``day_mean``; ``month_ends`` has ``month_index``,
    ``month_name`` and ``month_end``. A day can only count towards its own month and the next
    ``months``, so the range condition becomes an equality on the month number. The mean of
    quotients is first settled to seven places, so that noise in its last bits cannot move a tie.
    """
    spread = daily.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(months)))).withColumn(
        "month_index", F.year("day") * 12 + F.month("day") - 1 + F.col("_ahead")
    )
    inside = (F.col("day") <= F.col("month_end")) & (
        F.col("day") > F.add_months(F.col("month_end"), -months)
    )
    return (
        spread.join(month_ends, "month_index")
        .filter(inside)
        .groupBy(*group, "month_index", "month_name")
        .agg(round_half_away(round_half_away(exact_mean("day_mean"), 7), digits).alias("rolling_avg"))
    )


def exact_mean(value: str) -> Column:
    """Mean of doubles that does not depend on the order in which partitions are added up.

    Values are added as whole billionths.
    """
    billionths = F.floor(F.col(value) * F.lit(1e9) + F.lit(0.5))
    return F.sum(billionths) / F.lit(1e9) / F.count(value)
