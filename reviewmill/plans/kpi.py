"""Summary sheets: one row per app, and headline figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import numbers as N
from reviewmill.staging import Stage

# Issue columns of the summary.
ISSUES = ("crash", "login", "payment", "ui", "performance")


def app_summary(cleaned: DataFrame, categories: Sequence[str] = ISSUES) -> DataFrame:
    """Reviews, averages, sentiment fractions and issue counts per app, in one aggregate."""
    def fraction(label: str):
        hits = F.sum((F.col("sentiment_label") == label).cast("int"))
        return N.round_half_away(hits / F.count(F.lit(1)), 4)

    issues = [F.sum((F.col("issue_category") == i).cast("int")).alias(i) for i in categories]
    return (
        cleaned.filter(F.col("app_name").isNotNull())
        .groupBy("app_name")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            N.mean_of(F.sum("rating"), F.count("rating"), 2).alias("avg_rating"),
            N.mean_of(N.exact_score_sum(F.col("sentiment_score")), F.count("sentiment_score"), 3).alias("avg_sentiment"),
            fraction("negative").alias("negative_share"),
            fraction("positive").alias("positive_share"),
            *issues,
        )
        .orderBy("app_name")
    )


def best_and_worst(cleaned: DataFrame) -> DataFrame:
    """Apps with the highest and lowest mean rating; ties go to the first name."""
    means = cleaned.groupBy("app_name").agg(F.avg("rating").alias("mean"))
    return means.agg(
        F.min_by("app_name", F.struct(-F.col("mean"), F.col("app_name"))).alias("best_app"),
        F.min_by("app_name", F.struct(F.col("mean"), F.col("app_name"))).alias("worst_app"),
    )


def most_common_issue(cleaned: DataFrame) -> DataFrame:
    """Most frequent category other than "none"; ties go to the smallest name."""
    counts = cleaned.filter(F.col("issue_category") != "none").groupBy("issue_category").agg(F.count(F.lit(1)).alias("n"))
    top = F.min_by("issue_category", F.struct(-F.col("n"), F.col("issue_category")))
    return counts.agg(F.coalesce(top, F.lit("none")).alias("top_issue"))


def kpi_table(cleaned: DataFrame, stage: Stage) -> DataFrame:
    """(metric, value as text): one pass to stored (app, issue) sums, everything else from those."""
    cells = cleaned.groupBy("app_name", "issue_category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rated"),
        N.exact_score_sum(F.col("sentiment_score")).alias("sentiment_sum"),
    )
    cells = stage.put(cells, "kpi_cells")
    apps = cells.groupBy("app_name").agg(F.sum("rating_sum").alias("s"), F.sum("rated").alias("r"))
    mean = F.col("s") / F.col("r")
    named = apps.filter(F.col("app_name").isNotNull())
    issues = cells.filter(F.col("issue_category") != "none").groupBy("issue_category").agg(F.sum("n").alias("n"))

    def row(metric: str, source: DataFrame, value) -> DataFrame:
        return source.agg(value.cast("string").alias("value")).select(F.lit(metric).alias("metric"), "value")

    rows = [
        row("Total Reviews", cells, F.sum("n")),
        row("Apps Compared", named, F.count("app_name")),
        row("Overall Avg Rating", cells, N.mean_of(F.sum("rating_sum"), F.sum("rated"), 2)),
        row("Overall Avg Sentiment", cells, N.mean_of(F.sum("sentiment_sum"), F.sum("n"), 3)),
        row("Highest Avg Rating App", named, F.min_by("app_name", F.struct(-mean, F.col("app_name")))),
        row("Lowest Avg Rating App", named, F.min_by("app_name", F.struct(mean, F.col("app_name")))),
        row("Most Common Issue", issues, F.coalesce(F.min_by("issue_category", F.struct(-F.col("n"), F.col("issue_category"))), F.lit("none"))),
    ]
    table = rows[0]
    for extra in rows[1:]:
        table = table.unionByName(extra)
    return table
