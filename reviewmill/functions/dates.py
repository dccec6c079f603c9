"""Calendar features. All inputs are zone-less timestamps or dates, so no session zone enters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POST_RELEASE_DAYS = 14


def day_of(moment: Column) -> Column:
    return moment.cast("date")


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def parse_timestamp(text: Column) -> Column:
    """Text to a zone-less timestamp; null where it does not parse."""
    return F.try_cast(text, "timestamp_ntz") if hasattr(F, "try_cast") else text.try_cast("timestamp_ntz")


def month_key(moment: Column) -> Column:
    """``2026-07``"""
    return F.substring(day_of(moment).cast("string"), 1, 7)


def week_start(moment: Column) -> Column:
    """Monday of the week, as a date."""
    day = day_of(moment)
    return F.date_sub(day, F.weekday(day))


def week_label(moment: Column) -> Column:
    """``2026-07-06/2026-07-12``, Monday to Sunday."""
    monday = week_start(moment)
    return F.concat_ws("/", monday.cast("string"), F.date_add(monday, 6).cast("string"))


def quarter_key(moment: Column) -> Column:
    """``2026Q3``"""
    day = day_of(moment)
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def quarter_name(moment: Column) -> Column:
    """``Q3 2026``"""
    day = day_of(moment)
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"), F.lit(" "), F.year(day).cast("string"))


def month_name(moment: Column) -> Column:
    """``Jul 2026``"""
    return F.date_format(day_of(moment), "MMM yyyy")


def date_key(moment: Column) -> Column:
    """``20260706`` as an int."""
    day = day_of(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_since(moment: Column, release: Column) -> Column:
    """Whole days from a midnight release to ``moment``, never below 0; null stays null."""
    days = F.datediff(day_of(moment), day_of(release))
    return F.when(days < 0, F.lit(0)).otherwise(days)


def in_post_release_window(days: Column, last_day: int = POST_RELEASE_DAYS) -> Column:
    """1 for days 0..last_day inclusive, else 0; null days give 0."""
    return F.coalesce((days <= last_day).cast("int"), F.lit(0))


def shift_days(moment: Column, days: int) -> Column:
    """Midnight of the day ``days`` away from ``moment``."""
    return midnight(F.date_add(day_of(moment), days))


def window_label(moment: Column, release: Column, days: int = POST_RELEASE_DAYS) -> Column:
    """``pre_release_14d`` for [-14, 0) days, ``post_release_14d`` for [0, 14), else null."""
    return F.when(
        (moment < release) & (moment >= shift_days(release, -days)), F.lit(f"pre_release_{days}d")
    ).when(
        (moment >= release) & (moment < shift_days(release, days)), F.lit(f"post_release_{days}d")
    )
