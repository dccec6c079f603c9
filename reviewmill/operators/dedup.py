"""Exact duplicate removal that keeps the first copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.joins import BROADCAST_BYTES, bloom_filter, look_up, maybe_in, payload_bytes
from reviewmill.schemas import DEDUP_KEYS, INGEST_ORDER, LONG_KEYS
from reviewmill.staging import Stage

REVIEW_KEY = "review_key"


def review_key(keys: Sequence[str] = DEDUP_KEYS) -> Column:
    """SHA-256 over the identity columns.

    Each value is prefixed with its number of bytes, which is known without reading a text, and null has its own
    mark, so different tuples never serialise to the same text, and null equals null.
    """
    def framed(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("~"))

    return F.unhex(F.sha2(F.concat(*[framed(k) for k in keys]), 256))


def copy_order(raw: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order_by: Sequence[str] | None = None) -> list[str]:
    """Columns that order the copies of a review."""
    ordered = list(order_by or [c for c in INGEST_ORDER if c in raw.columns])
    return ordered + [c for c in raw.columns if c not in ordered and c not in keys]


def keep_first(
    raw: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order_by: Sequence[str] | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """One row per review: the first by ``order_by``, ties broken by every other column.

    Without ``order_by`` rows that carry their ``INGEST_ORDER`` are taken in file order. Adds ``review_key``.

    With a ``stage`` rows stay where they are read: see ``first_in_place``. Without one a single lazy plan
    shuffles every row by ``review_key``; ``row_number() = 1`` lets Spark drop surplus copies before
    that (a group limit on the map side), so a review copied a billion times sends one row per map task.
    """
    if stage is not None:
        return first_in_place(raw, stage, keys, order_by)
    return _first_of_window(raw.withColumn(REVIEW_KEY, review_key(keys)), copy_order(raw, keys, order_by), keys)


def _first_of_window(keyed: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    # The identity columns are constant inside a group. Listing them keeps every column alive
    # below the window, so plans that read this result twice share a single shuffle.
    ordered = list(order) + [k for k in keys if k not in order]
    first = Window.partitionBy(REVIEW_KEY).orderBy(*[F.col(c).asc_nulls_first() for c in ordered])
    return keyed.withColumn("_copy", F.row_number().over(first)).filter(F.col("_copy") == 1).drop("_copy")


def repeated_reviews(raw: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order_by: Sequence[str] | None = None) -> DataFrame:
    """(review_key, _first, _ties) of the reviews that have copies: where the first one stands and how many rows stand there.

    Only keys and the ordering columns meet. Equal places are counted before the copies of a review
    meet, so a review copied a billion times sends one row per place and map task; places in files are
    unique and need no count.
    """
    order = copy_order(raw, keys, order_by)
    keyed = raw.select(review_key(keys).alias(REVIEW_KEY), *order)
    if _in_file_order(raw, order_by):
        places = keyed.select(REVIEW_KEY, F.struct(*INGEST_ORDER).alias("_place"), F.lit(1).cast("bigint").alias("_rows"))
    else:
        places = keyed.groupBy(REVIEW_KEY, F.struct(*order).alias("_place")).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        places.groupBy(REVIEW_KEY)
        .agg(F.sum("_rows").alias("_copies"), F.min(F.struct("_place", "_rows")).alias("_best"))
        .filter(F.col("_copies") > 1)
        .select(REVIEW_KEY, F.col("_best._place").alias("_first"), F.col("_best._rows").alias("_ties"))
    )


def _in_file_order(raw: DataFrame, order_by: Sequence[str] | None) -> bool:
    return not order_by and all(c in raw.columns for c in INGEST_ORDER)


def maybe_copied(raw: DataFrame, stage: Stage, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame | None:
    """``raw`` plus ``_maybe``: false only for rows that surely have no copy. None when no row has one.

    Copies agree in the short identity columns, so hashes of these are counted and those that occur again make a Bloom filter of
    bounded size. No text is read for it; only rows that it lets through have to be compared with their texts.
    """
    short = [k for k in keys if k not in LONG_KEYS] or list(keys)
    hashed = F.xxhash64(*short)
    again = raw.select(hashed.alias("_identity")).groupBy("_identity").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    again = stage.put(again.select("_identity"), "identities_met_again")
    if again.isEmpty():
        return None
    bloom, blocks = bloom_filter(again, "_identity")
    filtered = (stage.put(bloom, "identity_filter"), blocks)
    return maybe_in(raw.withColumn("_identity", hashed), "_identity", filtered).drop("_identity")


def first_in_place(
    raw: DataFrame, stage: Stage, keys: Sequence[str] = DEDUP_KEYS, order_by: Sequence[str] | None = None
) -> DataFrame:
    """``keep_first`` that moves keys instead of rows.

    A first pass stores the first places of the reviews that have copies; a second one drops every row that is
    not at its review's first place. Both take the key of rows only that ``maybe_copied`` lets through. While that table is small the
    rows are neither shuffled nor sorted; beyond, only rows of reviews that may have copies travel. Rows that are equal in every
    column share a place: they alone are told apart by a window.
    """
    order = list(INGEST_ORDER) if _in_file_order(raw, order_by) else copy_order(raw, keys, order_by)
    columns = [*raw.columns, REVIEW_KEY]
    marked = maybe_copied(raw, stage, keys)
    if marked is None:
        return raw.withColumn(REVIEW_KEY, review_key(keys))
    repeated = stage.put(repeated_reviews(marked.filter("_maybe").drop("_maybe"), keys, order_by), "repeated_reviews")
    repeated = repeated.withColumnRenamed(REVIEW_KEY, "_key")
    keyed = marked.withColumn("_key", F.when(F.col("_maybe"), review_key(keys))).drop("_maybe").withColumn("_task", F.spark_partition_id())
    if payload_bytes(repeated) <= BROADCAST_BYTES:
        placed = look_up(keyed, repeated, "_key", ["_task"], "left", stage=stage)
    else:
        # A look-up of this size stores and deals its rows, so those without a key stay out of it.
        alone, travelling = keyed.filter(F.col("_key").isNull()), keyed.filter(F.col("_key").isNotNull())
        placed = look_up(travelling, repeated, "_key", ["_task"], "left", stage=stage).unionByName(alone, allowMissingColumns=True)
    kept = placed.filter(F.col("_first").isNull() | F.struct(*order).eqNullSafe(F.col("_first"))).withColumn(REVIEW_KEY, review_key(keys))
    if repeated.filter(F.col("_ties") > 1).isEmpty():
        return kept.select(*columns)
    tied = F.coalesce(F.col("_ties") > 1, F.lit(False))
    return kept.filter(~tied).select(*columns).unionByName(_first_of_window(kept.filter(tied).select(*columns), order, keys))


def drop_unusable(reviews: DataFrame) -> DataFrame:
    """Drop reviews without text or rating; ratings become integers."""
    return reviews.dropna(subset=["review_text", "rating"]).withColumn(
        "rating", F.col("rating").cast("int")
    )
