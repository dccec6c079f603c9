"""Row counts along the way, as a table (step, detail, row_count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.dedup import copy_order, maybe_copied, review_key
from reviewmill.plans.star import Star
from reviewmill.staging import Stage


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def _row(df: DataFrame, step: str, detail: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(step).alias("step"), F.lit(detail).alias("detail"), "row_count"
    )


def dedup_counts(raw: DataFrame, stage: Stage | None = None) -> DataFrame:
    """(rows_in, after_dedup, after_null_drop) without moving a text.

    Rows that surely have no copy are counted where they are read. The text is part of the others' key, so only the key, whether the
    text is missing and the rating of the first copy have to meet; copies combine on the map side.
    """
    marked = maybe_copied(raw, stage or Stage(raw.sparkSession))
    if marked is None:
        marked = raw.withColumn("_maybe", F.lit(False))
    copied = F.col("_maybe")
    no_text, no_rating = F.col("review_text").isNull(), F.col("rating").isNull()
    rows = marked.select(
        F.when(copied, review_key()).alias("key"), no_text.alias("no_text"), no_rating.alias("no_rating"),
        F.when(copied, F.struct(*copy_order(raw))).alias("place"),
    )
    # Rows without a key are one group here and a review each.
    reviews = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.count_if(~F.col("no_text") & ~F.col("no_rating")).alias("usable"),
        F.min_by(F.col("no_rating"), "place").alias("no_rating"), F.max("no_text").alias("no_text"),
    )
    alone = F.col("key").isNull()
    first_usable = (~F.col("no_text") & ~F.col("no_rating")).cast("bigint")
    sums = {
        "rows_in": F.col("copies"),
        "after_dedup": F.when(alone, F.col("copies")).otherwise(1),
        "after_null_drop": F.when(alone, F.col("usable")).otherwise(first_usable),
    }
    return reviews.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in sums.items()])


def cleaning_counts(raw: DataFrame, cleaned: DataFrame, stage: Stage | None = None) -> DataFrame:
    """One pass over each table: the counts of both value columns come from their combinations."""
    steps = ("rows_in", "after_dedup", "after_null_drop")
    counted = dedup_counts(raw, stage).select(
        F.inline(F.array(*[F.struct(F.lit("clean").alias("step"), F.lit(c).alias("detail"), F.col(c).alias("row_count")) for c in steps]))
    )
    cells = cleaned.groupBy("issue_category", "sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    split = cells.select(
        F.inline(
            F.array(
                F.struct(F.lit("clean").alias("step"), F.lit("final").alias("detail"), F.col("n")),
                *[F.struct(F.lit(c).alias("step"), F.col(c).alias("detail"), F.col("n")) for c in ("issue_category", "sentiment_label")],
            )
        )
    )
    return counted.unionByName(split.groupBy("step", "detail").agg(F.sum("n").alias("row_count")))


def star_counts(star: Star) -> DataFrame:
    parts = [_row(df, "star", name) for name, df in (star.tables() | {"fact_reviews": star.facts}).items()]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def audit(raw: DataFrame, cleaned: DataFrame, star: Star, stage: Stage | None = None) -> DataFrame:
    return cleaning_counts(raw, cleaned, stage).unionByName(star_counts(star))
