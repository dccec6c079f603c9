"""Dense surrogate keys 1..n in sort order, without a one-task global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

# monotonically_increasing_id keeps the place inside the partition in its lower bits.
PLACE_BITS = 33


def dense_keys(table: DataFrame, key: str, order: Sequence[Column], stage: Stage, name: str) -> DataFrame:
    """Number the rows of ``table`` by ``order`` (which must be total).

    Rows are range-partitioned once, sorted and stored with an id that holds the partition and the
    place inside it; a second pass adds the number of rows in earlier ranges. Only one count
    per range meets in a single task.
    """
    ranged = table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = stage.put(ranged, f"{name}_ranges").withColumns(
        {"_range": F.shiftright("_id", PLACE_BITS), "_slot": F.col("_id").bitwiseAND((1 << PLACE_BITS) - 1) + 1}
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    offsets = stage.put(offsets, f"{name}_offsets")
    return stored.join(broadcast_if_small(offsets), "_range").select(
        (F.col("_before") + F.col("_slot")).cast("int").alias(key), *table.columns
    )
