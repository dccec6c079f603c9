"""Top-k by rank inside groups that may be very large or fully tied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage


def rank_cutoffs(rows: DataFrame, group: Sequence[str], score: str, k: int) -> DataFrame:
    """Per group, the lowest ``score`` whose descending RANK is at most ``k``.

    RANK <= k means: fewer than k rows score higher. The rows are first reduced to one count
    per (group, score); only the k best distinct scores of a group meet in one task.
    """
    best = Window.partitionBy(*group).orderBy(F.col(score).desc_nulls_last())
    above = best.rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.groupBy(*group, score)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_place", F.row_number().over(best))
        .filter(F.col("_place") <= k)
        .withColumn("_higher", F.coalesce(F.sum("_n").over(above), F.lit(0)))
        .filter(F.col("_higher") < k)
        .groupBy(*group)
        .agg(F.min(score).alias("_cutoff"), F.max(F.col(score).isNull()).alias("_null_cutoff"))
    )


def top_ranked(
    rows: DataFrame, group: Sequence[str], score: str, k: int, stage: Stage, name: str
) -> DataFrame:
    """Rows with RANK() OVER (PARTITION BY group ORDER BY score DESC) <= k, all ties included.

    No group is ever sorted or gathered: the rows are filtered in place by their group's
    cut-off, so the cost of a million-way tie is only its own output. The least cut-off of all groups is one
    number, known before the rows are read, and so reaches the scan: row groups below it are skipped.
    """
    cutoffs = stage.put(rank_cutoffs(rows, group, score, k), name)
    in_rank = (F.col(score) >= F.col("_cutoff")) | F.col("_null_cutoff")
    return at_least(rows, score, cutoffs).join(broadcast_if_small(cutoffs), list(group)).filter(in_rank).drop("_cutoff", "_null_cutoff")


def at_least(rows: DataFrame, score: str, cutoffs: DataFrame) -> DataFrame:
    """``rows`` from the least cut-off on; all of them where a group takes rows without a score."""
    least = cutoffs.agg(F.min("_cutoff").alias("score"), F.max("_null_cutoff").alias("nulls")).first()
    if least["score"] is None or least["nulls"]:
        return rows
    return rows.filter(F.col(score) >= F.lit(least["score"]).cast(rows.schema[score].dataType))
