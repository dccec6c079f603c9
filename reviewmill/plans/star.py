"""Star schema: four dimensions and one fact table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import dates as D
from reviewmill.functions.text import ISSUE_KEYWORDS
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.operators.keys import dense_keys
from reviewmill.schemas import FACT_COLUMNS, ISSUE_DIMENSION, LONG_KEYS
from reviewmill.staging import Stage

MONTH = "review_month"

# What the dimensions and the fact are made of, but for the texts.
FACT_SOURCE = {*FACT_COLUMNS, "app_id", "app_name", "app_version", "version_release_date", "issue_category", MONTH} - {*LONG_KEYS}


@dataclass(frozen=True)
class Star:
    """``fact_reviews`` has the texts and reads them from the cleaned reviews; ``stored_fact`` is the same rows without them, by month."""

    fact_reviews: DataFrame
    dim_app: DataFrame
    dim_app_version: DataFrame
    dim_date: DataFrame
    dim_issue_category: DataFrame
    stored_fact: DataFrame | None = None

    @property
    def facts(self) -> DataFrame:
        """The fact for all that asks for no text."""
        return self.fact_reviews if self.stored_fact is None else self.stored_fact

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fact_reviews": self.fact_reviews.select(*FACT_COLUMNS),
            "dim_app": self.dim_app,
            "dim_app_version": self.dim_app_version,
            "dim_date": self.dim_date,
            "dim_issue_category": self.dim_issue_category,
        }

    def with_fact(self, fact: DataFrame, stored_fact: DataFrame | None = None) -> Star:
        return replace(self, fact_reviews=fact, stored_fact=stored_fact)


def review_facets(cleaned: DataFrame) -> DataFrame:
    """The distinct facets of the reviews, from which every dimension is built.

    One row per app, name, version, release date, day and issue, with the latest ``review_date``: rows follow
    days and versions, not reviews, and ``dim_app`` to ``dim_date`` give the same tables on them as on ``cleaned``.
    """
    return cleaned.groupBy(
        "app_id", "app_name", "app_version", "version_release_date", D.day_of(F.col("review_date")).alias("_day"), "issue_category"
    ).agg(F.max("review_date").alias("review_date")).drop("_day")


def app_names(cleaned: DataFrame) -> DataFrame:
    """One name per app: the latest by review date, so a renamed app does not double its rows."""
    latest = F.max_by("app_name", F.struct("review_date", "app_name"))
    return cleaned.groupBy("app_id").agg(latest.alias("app_name"))


def dim_app(cleaned: DataFrame, stage: Stage) -> DataFrame:
    order = [F.col("app_name").asc_nulls_last(), F.col("app_id").asc()]
    return dense_keys(app_names(cleaned), "app_key", order, stage, "dim_app")


def dim_app_version(cleaned: DataFrame, stage: Stage) -> DataFrame:
    """Versions by release date; null versions are rows of their own, ordered last."""
    versions = cleaned.select("app_id", "app_version", "version_release_date").distinct()
    order = [F.col("version_release_date").asc_nulls_last(), F.col("app_id").asc(), F.col("app_version").asc_nulls_last()]
    return dense_keys(versions, "version_key", order, stage, "dim_app_version")


def dim_date(cleaned: DataFrame) -> DataFrame:
    """Dates present in the data; no calendar fill."""
    days = cleaned.select(D.day_of(F.col("review_date")).alias("day")).distinct()
    day = F.col("day")
    return days.select(
        D.midnight(day).alias("date"),
        D.date_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        D.month_name(day).alias("month_name"),
        D.quarter_name(day).alias("quarter"),
        D.midnight(D.week_start(day)).alias("week_start"),
    )


def dim_issue_category(spark: SparkSession, keywords: Sequence[tuple[str, Sequence[str]]] = ISSUE_KEYWORDS) -> DataFrame:
    """One row per category of ``keywords``, in order, and "none". A category of the user's own describes itself."""
    described = {category: text for _, category, text in ISSUE_DIMENSION}
    categories = [c for c in dict.fromkeys(c for c, _ in keywords) if c != "none"] + ["none"]
    names = ("issue_key", "issue_category", "issue_description")
    rows = [(key, c, described.get(c, c)) for key, c in enumerate(categories, 1)]
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])))


def attach_app(cleaned: DataFrame, apps: DataFrame) -> DataFrame:
    return cleaned.join(broadcast_if_small(apps.select("app_id", "app_key")), "app_id", "left")


def attach_version(cleaned: DataFrame, versions: DataFrame) -> DataFrame:
    """Null matches null: reviews without a version have a version key as well."""
    side = versions.select(
        F.col("app_id").alias("_app"), F.col("app_version").alias("_version"), "version_key"
    )
    same = (F.col("app_id") == F.col("_app")) & F.col("app_version").eqNullSafe(F.col("_version"))
    return cleaned.join(broadcast_if_small(side), same, "left").drop("_app", "_version")


def attach_issue(cleaned: DataFrame, issues: DataFrame) -> DataFrame:
    side = issues.select("issue_category", "issue_key")
    return cleaned.join(broadcast_if_small(side), "issue_category", "left")


def build_star(
    cleaned: DataFrame, stage: Stage | None = None, keywords: Sequence[tuple[str, Sequence[str]]] = ISSUE_KEYWORDS
) -> Star:
    """Build and store the star schema from a ``cleaned`` table tagged with ``keywords``.

    The reviews are read once, without their texts, and stored; their facets give the dimensions, and they give the fact. Dimensions
    are stored first: their measured size decides how the fact joins them. The fact
    is laid out by month, with adaptive rebalancing so that a hot month becomes many files. No text is stored or
    moved for it: ``fact_reviews`` attaches the keys to ``cleaned`` where that is read.
    """
    stage = stage or Stage(cleaned.sparkSession)
    reviews = stage.put(cleaned.select(*[c for c in cleaned.columns if c in FACT_SOURCE]), "reviews_without_texts")
    facets = stage.put(review_facets(reviews), "facets")
    if not facets.filter(F.col("review_date").isNull()).isEmpty():
        raise ValueError("reviews without a review_date have no date key")
    apps = stage.put(dim_app(facets, stage), "dim_app")
    versions = stage.put(dim_app_version(facets, stage), "dim_app_version")
    dates = stage.put(dim_date(facets), "dim_date")
    issues = stage.put(dim_issue_category(cleaned.sparkSession, keywords), "dim_issue_category")
    unknown = facets.select("issue_category").distinct().join(issues, "issue_category", "left_anti").limit(1).collect()
    if unknown:
        raise ValueError(f"issue category {unknown[0]['issue_category']!r} is not in the keyword table")

    def with_keys(rows: DataFrame) -> DataFrame:
        return (
            rows.transform(attach_app, apps)
            .transform(attach_version, versions)
            .transform(attach_issue, issues)
            .withColumn("date_key", D.date_key(F.col("review_date")))
        )

    fact = with_keys(reviews).select(*[c for c in FACT_COLUMNS if c not in LONG_KEYS], MONTH)
    stored = stage.put(fact.hint("rebalance", MONTH), "fact_reviews", partition_by=[MONTH])
    return Star(with_keys(cleaned).select(*FACT_COLUMNS, MONTH), apps, versions, dates, issues, stored)
