"""Release dates inferred from the first review of each app version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import dates as D
from reviewmill.operators.joins import broadcast_if_small


def first_seen(reviews: DataFrame) -> DataFrame:
    """(app_id, app_version, version_release_date) for every named version.

    An aggregate with map-side combine; rows without a version have no release.
    """
    return (
        reviews.filter(F.col("app_version").isNotNull())
        .groupBy("app_id", "app_version")
        .agg(F.min("review_date").alias("_first"))
        .select("app_id", "app_version", D.midnight(D.day_of(F.col("_first"))).alias("version_release_date"))
    )


def with_release(reviews: DataFrame, releases: DataFrame) -> DataFrame:
    """Attach release date, whole days since it, and the post-release flag.

    ``releases`` should be a stored table: its measured size decides broadcast or shuffle.
    """
    days = D.days_since(F.col("review_date"), F.col("version_release_date"))
    return (
        reviews.join(broadcast_if_small(releases), ["app_id", "app_version"], "left")
        .withColumn("days_since_version_release", days)
        .withColumn("is_post_release_window", D.in_post_release_window(F.col("days_since_version_release")))
    )
