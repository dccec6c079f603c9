"""Joins against tables that may or may not be small."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.staging import Stage

BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64


def payload_bytes(table: DataFrame) -> int:
    """Measured size of a stored table: text widths plus a fixed overhead per row."""
    widths = F.lit(ROW_OVERHEAD_BYTES).cast("bigint")
    for field in table.schema.fields:
        width = F.octet_length(F.col(field.name).cast("string"))
        widths = widths + F.coalesce(width, F.lit(0))
    return table.agg(F.coalesce(F.sum(widths), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(table: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``table`` for broadcast when its measured size is within the limit.

    Beyond the limit the table is returned unmarked: the join then shuffles, and adaptive
    execution splits hot partitions. Use it on stored tables only - measuring runs one scan.
    """
    return F.broadcast(table) if payload_bytes(table) <= limit_bytes else table


# --- look-ups in tables of any size -----------------------------------------------------------------

BLOOM_BLOCKS = 1 << 20
VALUES_A_BLOCK = 6
BITS_A_VALUE = 3
HOT_VALUES = 64


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), value), F.lit(blocks))


def _bits(value: Column) -> Column:
    """A 64-bit word in which the places of ``value`` are set."""
    spread, one = F.xxhash64(F.lit("bits"), value), F.lit(1).cast("bigint")
    word = F.lit(0).cast("bigint")
    for i in range(BITS_A_VALUE):
        place = F.shiftrightunsigned(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", one, place))
    return word


def bloom_filter(table: DataFrame, column: str) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of the values of ``column``: rows (_block, _set), and the number of blocks.

    At most ``BLOOM_BLOCKS`` rows of two numbers, whatever the size of ``table``, so it may be broadcast; beyond
    ``VALUES_A_BLOCK`` values a block it lets more strangers pass and still no value of the table is missed.
    """
    blocks = min(BLOOM_BLOCKS, 1 << max(6, (table.count() // VALUES_A_BLOCK).bit_length()))
    word = table.select(_block(F.col(column), blocks).alias("_block"), _bits(F.col(column)).alias("_word"))
    return word.groupBy("_block").agg(F.bit_or("_word").alias("_set")), blocks


def maybe_in(rows: DataFrame, column: str, bloom: tuple[DataFrame, int]) -> DataFrame:
    """``rows`` plus ``_maybe``: false only where the value is null or surely not in the filtered table."""
    table, blocks = bloom
    marked = rows.withColumn("_block", _block(F.col(column), blocks)).join(F.broadcast(table), "_block", "left")
    needed = _bits(F.col(column))
    present = F.col(column).isNotNull() & F.coalesce(F.col("_set").bitwiseAND(needed) == needed, F.lit(False))
    return marked.withColumn("_maybe", present).drop("_block", "_set")


def hot_values(rows: DataFrame, column: str) -> DataFrame:
    """Values that more than one in ``HOT_VALUES`` of the non-null rows hold; so there are fewer than that."""
    total = rows.agg(F.count(column).alias("n")).first()["n"]
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") * HOT_VALUES > F.lit(total)).select(column)


def look_up(
    rows: DataFrame,
    table: DataFrame,
    column: str,
    spread_by: Sequence[str],
    how: str = "inner",
    limit_bytes: int = BROADCAST_BYTES,
    stage: Stage | None = None,
    widen: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Join (``inner`` or ``left``) of ``rows`` with ``table`` on ``column``, for tables of any size.

    Within ``limit_bytes`` the table is broadcast. Beyond, a Bloom filter keeps rows that cannot match from the
    exchange (an inner join drops them, a left join takes the value away), the rest is stored and counted, and
    hot values, as well as missing ones, are spread over all partitions by the hash of ``spread_by``.
    ``widen`` replaces columns of the rows that were let through, before they are stored; it keeps ``column`` and those
    it does not know. ``table`` should be stored; null matches nothing. ``_maybe``, ``_hot``, ``_value`` and ``_salt`` are names of its own.
    """
    if payload_bytes(table) <= limit_bytes:
        joined = rows.join(F.broadcast(table), column, how)
        return widen(joined) if widen else joined
    stage = stage or Stage(rows.sparkSession)
    bloom, blocks = bloom_filter(table, column)
    marked = maybe_in(rows, column, (stage.put(bloom, "bloom_filter"), blocks))
    if how == "inner":
        marked = marked.filter("_maybe")
    if widen:
        marked = widen(marked)
    marked = stage.put(marked.withColumn("_value", F.when(F.col("_maybe"), F.col(column))).drop("_maybe"), "to_look_up")

    hot = stage.put(hot_values(marked, "_value").withColumn("_hot", F.lit(True)), "hot_values")
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(partitions)).cast("int")
    salted = marked.join(F.broadcast(hot), "_value", "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col("_value").isNull(), spread).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(partitions - 1))).otherwise(F.array(F.lit(0)))
    spread_table = (
        table.withColumnRenamed(column, "_value").join(F.broadcast(hot), "_value", "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    )
    return salted.drop("_hot").join(spread_table, ["_value", "_salt"], how).drop("_value", "_salt")
