"""Additive review measures by any attribute, slicers, and the dashboard tables built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions import dates as D
from reviewmill.functions import numbers as N
from reviewmill.operators.windows import trailing_months_mean
from reviewmill.plans.star import MONTH, Star
from reviewmill.schemas import DETAIL_COLUMNS

# Where an attribute lives: its dimension and the fact column that leads there.
DIMENSION_OF = {
    "app_name": ("dim_app", "app_key"),
    "app_id": ("dim_app", "app_key"),
    "app_version": ("dim_app_version", "version_key"),
    "version_release_date": ("dim_app_version", "version_key"),
    "issue_category": ("dim_issue_category", "issue_key"),
    "issue_description": ("dim_issue_category", "issue_key"),
    "year": ("dim_date", "date_key"),
    "month": ("dim_date", "date_key"),
    "week_start": ("dim_date", "date_key"),
    "month_name": ("dim_date", "date_key"),
    "quarter": ("dim_date", "date_key"),
    "date": ("dim_date", "date_key"),
}

SUMS = ("n", "rating_sum", "sentiment_sum", "positive", "negative", "replied", "fresh", "fresh_rating_sum")


def _ones(condition: Column) -> Column:
    return F.sum(condition.cast("int"))


def review_sums() -> list[Column]:
    """Sums and counts every measure is made of; they add up across any grouping."""
    fresh = F.col("is_post_release_window") == 1
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"),
        N.exact_score_sum(F.col("sentiment_score")).alias("sentiment_sum"),
        _ones(F.col("sentiment_label") == "positive").alias("positive"),
        _ones(F.col("sentiment_label") == "negative").alias("negative"),
        _ones(F.col("has_developer_reply") == 1).alias("replied"),
        _ones(fresh).alias("fresh"),
        F.coalesce(F.sum(F.when(fresh, F.col("rating"))), F.lit(0)).alias("fresh_rating_sum"),
    ]


def sums_by(star: Star, by: Sequence[str]) -> DataFrame:
    """``review_sums`` by attributes of the fact or its dimensions.

    The fact is aggregated by its own keys first, so dimensions only meet aggregates, and a
    dimension of any size never has to travel to the reviews.
    """
    keys = list(dict.fromkeys(DIMENSION_OF[a][1] if a in DIMENSION_OF else a for a in by))
    sums = star.facts.groupBy(*keys).agg(*review_sums())
    tables = star.tables()
    for key in keys:
        wanted = [a for a in by if DIMENSION_OF.get(a, ("", ""))[1] == key]
        if wanted:
            dimension = tables[DIMENSION_OF[wanted[0]][0]]
            sums = sums.join(dimension.select(key, *wanted), key)
    return sums.groupBy(*by).agg(*[F.sum(s).alias(s) for s in SUMS])


def avg_rating(digits: int = 2) -> Column:
    return N.mean_of(F.col("rating_sum"), F.col("n"), digits)


def avg_sentiment(digits: int = 3) -> Column:
    return N.mean_of(F.col("sentiment_sum"), F.col("n"), digits)


def measures(star: Star, by: Sequence[str] = ()) -> DataFrame:
    """All measures by any attributes (none: one total row)."""
    fresh = N.safe_divide(F.col("fresh_rating_sum"), F.col("fresh"))
    return sums_by(star, by).select(
        *by,
        F.col("n").alias("total_reviews"),
        avg_rating(4).alias("avg_rating"),
        avg_sentiment(4).alias("avg_sentiment"),
        N.round_half_away(N.safe_divide(F.col("negative"), F.col("n")), 4).alias("pct_negative"),
        N.round_half_away(N.safe_divide(F.col("positive"), F.col("n")), 4).alias("pct_positive"),
        N.round_half_away(fresh, 4).alias("post_release_avg_rating"),
        N.round_half_away(N.safe_divide(F.col("replied"), F.col("n")), 4).alias("developer_reply_rate"),
    )


def slice_reviews(
    reviews: DataFrame,
    apps: Sequence[str] | None = None,
    versions: Sequence[str] | None = None,
    issues: Sequence[str] | None = None,
    labels: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Filter cleaned reviews; ``start`` and ``end`` are inclusive days. All filters reach the scan."""
    chosen = {"app_name": apps, "app_version": versions, "issue_category": issues, "sentiment_label": labels}
    for name, values in chosen.items():
        if values is not None:
            reviews = reviews.filter(F.col(name).isin(*values))
    moment = F.col("review_date")
    if start is not None:
        reviews = reviews.filter(moment >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        reviews = reviews.filter(moment < D.midnight(F.date_add(F.lit(end).cast("date"), 1)))
    return reviews


def slice_star(
    star: Star,
    apps: Sequence[str] | None = None,
    versions: Sequence[str] | None = None,
    issues: Sequence[str] | None = None,
    labels: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> Star:
    """The same slicers on the star; dates also prune the month folders of the fact."""
    tables = star.tables()

    def sliced(fact: DataFrame) -> DataFrame:
        fact = slice_reviews(fact, labels=labels, start=start, end=end)
        if start is not None:
            fact = fact.filter(F.col(MONTH) >= start[:7])
        if end is not None:
            fact = fact.filter(F.col(MONTH) <= end[:7])
        for name, values in {"app_name": apps, "app_version": versions, "issue_category": issues}.items():
            if values is not None:
                dimension, key = DIMENSION_OF[name]
                keys = tables[dimension].filter(F.col(name).isin(*values)).select(key)
                fact = fact.join(keys, key, "left_semi")
        return fact

    return star.with_fact(sliced(star.fact_reviews), sliced(star.facts))


def month_ends(star: Star) -> DataFrame:
    """Last date of each month present in the date dimension."""
    return star.dim_date.groupBy((F.col("year") * 12 + F.col("month") - 1).alias("month_index"), "month_name").agg(
        F.max(D.day_of(F.col("date"))).alias("month_end")
    )


def trailing_rating(star: Star, months: int = 3) -> DataFrame:
    """Rolling mean of daily average ratings per app over calendar months.

    For a month whose last date in the data is E the period is (E - 3 months, E]; each date of
    the app counts once, whatever its number of reviews. A month is shown when the period has
    any review of the app.
    """
    daily = sums_by(star, ["app_name", "date"]).select(
        "app_name", D.day_of(F.col("date")).alias("day"), (F.col("rating_sum") / F.col("n")).alias("day_mean")
    )
    return trailing_months_mean(daily, month_ends(star), ["app_name"], months, 4)


def rating_trend(star: Star) -> DataFrame:
    """Average and trailing three-month rating by month and app."""
    monthly = sums_by(star, ["app_name", "month_name"]).select(
        "app_name", "month_name", avg_rating(4).alias("avg_rating")
    )
    rolling = trailing_rating(star).select(
        "app_name", "month_name", F.col("rolling_avg").alias("rolling_3_month_avg_rating")
    )
    return rolling.join(monthly, ["app_name", "month_name"], "left").select(
        "app_name", "month_name", "avg_rating", "rolling_3_month_avg_rating"
    )


def sentiment_by_month(star: Star) -> DataFrame:
    by = ("app_name", "month_name", "sentiment_label")
    return sums_by(star, by).select(*by, F.col("n").alias("review_count"))


def version_averages(star: Star) -> DataFrame:
    return sums_by(star, ["app_version"]).select(
        "app_version", avg_rating(4).alias("avg_rating"), avg_sentiment(4).alias("avg_sentiment")
    )


def issue_matrix(star: Star) -> DataFrame:
    """Apps by issue category, all categories of the dimension, 0 where none."""
    names = [r["issue_category"] for r in star.dim_issue_category.orderBy("issue_key").collect()]  # the keyword table's
    counts = sums_by(star, ["app_name", "issue_category"])
    return counts.groupBy("app_name").pivot("issue_category", names).agg(F.sum("n")).na.fill(0, names)


def rating_vs_previous_release(star: Star) -> DataFrame:
    """Average rating of each app version against the previous release date of any app.

    The previous date is taken over the release dates of all versions of all apps, while the
    rating compared with stays within the app. As in a spreadsheet, blanks count as 0 in a
    difference and equal each other: where no earlier date exists the comparison falls on the
    reviews without a release date. This is a reading of the written measure, not of a run.
    """
    dates = star.dim_app_version.select("version_release_date").distinct()
    ordered = Window.orderBy(F.col("version_release_date").asc_nulls_first())  # one row per calendar day
    previous = dates.withColumn("previous_date", F.lag("version_release_date").over(ordered))
    by = ["app_name", "app_version", "version_release_date"]
    current = sums_by(star, by).select(*by, (F.col("rating_sum") / F.col("n")).alias("avg"))
    earlier = sums_by(star, ["app_name", "version_release_date"]).select(
        F.col("app_name").alias("_app"),
        F.col("version_release_date").alias("_date"),
        (F.col("rating_sum") / F.col("n")).alias("prev_avg"),
    )
    at_date = previous.withColumnRenamed("version_release_date", "_current")
    same_date = F.col("version_release_date").eqNullSafe(F.col("_current"))
    same_app = (F.col("app_name") == F.col("_app")) & F.col("previous_date").eqNullSafe(F.col("_date"))
    change = F.col("avg") - F.coalesce(F.col("prev_avg"), F.lit(0.0))
    return (
        current.join(at_date, same_date)
        .join(earlier, same_app, "left")
        .select(
            *by,
            N.round_half_away(F.col("avg"), 4).alias("avg_rating"),
            N.round_half_away(F.col("prev_avg"), 4).alias("prev_version_avg_rating"),
            N.round_half_away(change, 4).alias("rating_change_vs_prev_version"),
        )
    )


def issue_share(star: Star) -> DataFrame:
    """Share of all reviews by issue; the total is a window over at most six rows."""
    counts = sums_by(star, ["issue_category"])
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "issue_category",
        F.col("n").alias("review_count"),
        N.round_half_away(F.col("n") / total, 4).alias("share_of_reviews"),
    )


def release_window_matrix(star: Star) -> DataFrame:
    by = ["app_name", "app_version", "is_post_release_window"]
    return sums_by(star, by).select(
        *by, F.col("n").alias("review_count"), avg_rating(4).alias("avg_rating"), avg_sentiment(4).alias("avg_sentiment")
    )


def top_complaints(star: Star, max_rating: int = 2) -> DataFrame:
    """Low-rated reviews, most liked first (a distributed sort; take a head with ``limit``)."""
    return (
        star.fact_reviews.filter(F.col("rating") <= max_rating)
        .select("review_id", "review_text", "rating", "thumbs_up")
        .orderBy(F.col("thumbs_up").desc_nulls_last(), "review_id")
    )


def review_detail(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(*DETAIL_COLUMNS)
