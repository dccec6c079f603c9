"""The eight analytic reports. All of them aggregate the fact by key before meeting a dimension."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions import dates as D
from reviewmill.functions import numbers as N
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.operators.ranking import top_ranked
from reviewmill.operators.windows import change_vs_previous, rolling_rows_mean
from reviewmill.plans.measures import avg_rating, avg_sentiment, sums_by
from reviewmill.plans.star import Star
from reviewmill.sources.writers import write_table
from reviewmill.staging import Stage


def app_ranking(star: Star, stage: Stage) -> DataFrame:
    return (
        sums_by(star, ["app_key", "app_name"])
        .select(
            "app_name",
            F.col("n").alias("review_count"),
            avg_rating().alias("avg_rating"),
            avg_sentiment().alias("avg_sentiment"),
            N.percent_of(F.col("positive"), F.col("n")).alias("pct_positive"),
            N.percent_of(F.col("negative"), F.col("n")).alias("pct_negative"),
            N.percent_of(F.col("replied"), F.col("n")).alias("developer_reply_rate"),
        )
        .orderBy(F.desc("avg_rating"), F.desc("avg_sentiment"), "app_name")
    )


def version_health(star: Star, stage: Stage) -> DataFrame:
    """Versions against the one released before in the same app; null dates come first."""
    by = ["app_name", "app_version", "version_release_date"]
    stats = sums_by(star, ["app_key", "version_key", *by]).select(
        "app_key",
        "version_key",
        *by,
        F.col("n").alias("review_count"),
        avg_rating().alias("avg_rating"),
        avg_sentiment().alias("avg_sentiment"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("version_release_date", "app_version", "version_key")]
    return (
        stats.withColumns(
            {
                "rating_change_vs_prev": change_vs_previous("avg_rating", ["app_name"], order, 2),
                "sentiment_change_vs_prev": change_vs_previous("avg_sentiment", ["app_name"], order, 3),
            }
        )
        .orderBy("app_name", *order)
        .drop("app_key", "version_key")
    )


def issue_frequency(star: Star, stage: Stage) -> DataFrame:
    """Issue counts with the app total as a window over one row per category and app."""
    counts = sums_by(star, ["app_key", "app_name", "issue_category"]).select(
        "app_key",
        "app_name",
        "issue_category",
        F.col("n").alias("issue_review_count"),
        F.sum("n").over(Window.partitionBy("app_key")).alias("total_reviews"),
    )
    share = N.percent_of(F.col("issue_review_count"), F.col("total_reviews"))
    return (
        counts.filter(F.col("issue_category") != "none")
        .withColumn("pct_of_app_reviews", share)
        .orderBy("app_name", F.desc("issue_review_count"), "issue_category")
        .drop("app_key")
    )


def monthly_trend(star: Star, stage: Stage) -> DataFrame:
    by = ["app_key", "date_key"]
    daily = star.facts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"),
        N.exact_score_sum(F.col("sentiment_score")).alias("sentiment_sum"),
    )
    months = (
        daily.join(star.dim_date.select("date_key", "date", "month_name"), "date_key")
        .join(star.dim_app.select("app_key", "app_name"), "app_key")
        .groupBy("app_key", "app_name", "month_name")
        .agg(
            F.min("date").alias("month_start"),
            *[F.sum(c).alias(c) for c in ("n", "rating_sum", "sentiment_sum")],
        )
        .select(
            "app_name",
            "month_name",
            "month_start",
            F.col("n").alias("review_count"),
            avg_rating().alias("avg_rating"),
            avg_sentiment().alias("avg_sentiment"),
        )
    )
    rolling = rolling_rows_mean("avg_rating", ["app_name"], [F.col("month_start")], 3, 2)
    return (
        months.withColumn("rolling_3mo_avg_rating", rolling)
        .orderBy("app_name", "month_start")
        .drop("month_start")
    )


def release_windows(star: Star, days: int = D.POST_RELEASE_DAYS) -> DataFrame:
    """Sums of the app's reviews (any version) before and after each release.

    Release dates are midnights, so a review lies in a window exactly when its day does. The
    fact is reduced to one row per app and day; every release is spread over its 2 x ``days``
    days. The range condition is thereby an equality, and cost follows days, not reviews.
    """
    daily = star.facts.groupBy("app_key", D.day_of(F.col("review_date")).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"),
        N.exact_score_sum(F.col("sentiment_score")).alias("sentiment_sum"),
    )
    offset = F.explode(F.sequence(F.lit(-days), F.lit(days - 1))).alias("offset")
    releases = (
        star.dim_app_version.filter(F.col("version_release_date").isNotNull())
        .join(star.dim_app, "app_id")
        .select("app_key", "app_name", "version_key", "app_version", "version_release_date", offset)
        .withColumn("day", F.date_add(D.day_of(F.col("version_release_date")), F.col("offset")))
    )
    sides = {"pre": F.col("offset") < 0, "post": F.col("offset") >= 0}
    sums = [
        F.sum(F.when(inside, F.col(c))).alias(f"{side}_{c}")
        for side, inside in sides.items()
        for c in ("n", "rating_sum", "sentiment_sum")
    ]
    return (
        releases.join(daily, ["app_key", "day"])
        .groupBy("app_name", "version_key", "app_version", "version_release_date")
        .agg(*sums)
    )


def release_impact(star: Star, stage: Stage) -> DataFrame:
    """Pre against post window; versions without reviews on either side drop out."""
    def averages(side: str):
        n = F.col(f"{side}_n")
        return [
            n.alias(f"{side}_review_count"),
            N.mean_of(F.col(f"{side}_rating_sum"), n, 2).alias(f"{side}_avg_rating"),
            N.mean_of(F.col(f"{side}_sentiment_sum"), n, 3).alias(f"{side}_avg_sentiment"),
        ]

    def delta(name: str, digits: int):
        return N.round_half_away(F.col(f"post_avg_{name}") - F.col(f"pre_avg_{name}"), digits)

    return (
        release_windows(star)
        .filter(F.col("pre_n").isNotNull() & F.col("post_n").isNotNull())
        .select("app_name", "app_version", "version_release_date", *averages("pre"), *averages("post"))
        .withColumns({"rating_delta": delta("rating", 2), "sentiment_delta": delta("sentiment", 3)})
        .orderBy("sentiment_delta", "app_name", "app_version")
    )


def liked_complaints(star: Star, stage: Stage, k: int = 5, max_rating: int = 2) -> DataFrame:
    """Most liked low-rated reviews per app by RANK, ties included.

    The date as last sort key lets the range sort spread a large tie over many tasks.
    """
    low = star.fact_reviews.filter(F.col("rating") <= max_rating)
    return (
        top_ranked(low, ["app_key"], "thumbs_up", k, stage, "complaint_cutoffs")
        .join(star.dim_app, "app_key")
        .join(star.dim_issue_category, "issue_key")
        .select("app_name", "review_text", "rating", "thumbs_up", "issue_category", "review_date")
        .orderBy("app_name", F.desc("thumbs_up"), "review_date")
    )


def reply_split(star: Star, stage: Stage) -> DataFrame:
    by = ["app_name", "has_developer_reply"]
    return (
        sums_by(star, ["app_key", *by])
        .select(
            *by,
            F.col("n").alias("review_count"),
            avg_rating().alias("avg_rating"),
            avg_sentiment().alias("avg_sentiment"),
        )
        .orderBy("app_name", F.desc("has_developer_reply"))
    )


def worst_versions(star: Star, stage: Stage, min_reviews: int = 10, k: int = 20) -> DataFrame:
    by = ["version_key", "app_key"]
    issue = star.dim_issue_category.select("issue_key", (F.col("issue_category") != "none").cast("int").alias("is_issue"))
    tagged = star.facts.join(broadcast_if_small(issue), "issue_key")
    sums = tagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"),
        N.exact_score_sum(F.col("sentiment_score")).alias("sentiment_sum"),
        F.sum((F.col("sentiment_label") == "negative").cast("int")).alias("negative"),
        F.sum("is_issue").alias("issue_review_count"),
    )
    return (
        sums.filter(F.col("n") >= min_reviews)
        .join(star.dim_app_version.drop("app_id"), "version_key")
        .join(star.dim_app, "app_key")
        .select(
            "app_name",
            "app_version",
            "version_release_date",
            F.col("n").alias("review_count"),
            avg_rating().alias("avg_rating"),
            avg_sentiment().alias("avg_sentiment"),
            N.percent_of(F.col("negative"), F.col("n")).alias("pct_negative"),
            "issue_review_count",
        )
        .orderBy("avg_rating", F.desc("pct_negative"), "app_name", F.col("app_version").asc_nulls_first())
        .limit(k)
    )


REPORTS: dict[str, Callable[[Star, Stage], DataFrame]] = {
    "q1_app_ranking": app_ranking,
    "q2_version_health": version_health,
    "q3_issue_frequency": issue_frequency,
    "q4_monthly_trend": monthly_trend,
    "q5_release_impact": release_impact,
    "q6_liked_complaints": liked_complaints,
    "q7_reply_split": reply_split,
    "q8_worst_versions": worst_versions,
}


def run_reports(
    star: Star, folder: str, stage: Stage, names: Iterable[str] | None = None, fmt: str = "csv"
) -> dict[str, str | None]:
    """Write each report to ``folder/<name>``; a failing report does not stop the others.

    Returns the error text per report, None for success. ``require_all_reports`` stops a caller that needs all of them.
    """
    outcome: dict[str, str | None] = {}
    for name in names if names is not None else REPORTS:
        try:
            write_table(REPORTS[name](star, stage), f"{folder}/{name}", fmt)
            outcome[name] = None
        except Exception as error:  # noqa: BLE001 - reported to the caller
            outcome[name] = f"{type(error).__name__}: {error}"
    return outcome


def require_all_reports(outcome: Mapping[str, str | None]) -> list[str]:
    """The names of the reports of ``run_reports``; stops when one of them failed, so that no failure passes for a result."""
    failed = {name: error for name, error in outcome.items() if error is not None}
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(outcome)} reports failed: " + "; ".join(f"{n}: {e}" for n, e in failed.items()))
    return list(outcome)
