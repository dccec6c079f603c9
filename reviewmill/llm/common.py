"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these ASCII blanks.
BLANKS = r"\x20\x09-\x0D"
WORD = f"[^{BLANKS}]+"

# Texts are handled in slices of about this many bytes, so a task's memory does not follow
# the number of rows in an Arrow batch.
SLICE_BYTES = 4 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def label_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as fold 0, which is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def once(value: Column) -> Column:
    """``value`` as a generated row, which keeps the optimizer from repeating it in later steps."""
    return F.explode(F.array(value))


def utf8(column: pa.Array) -> pa.Array:
    """A text or binary column as plain binary, nulls as empty."""
    return column.cast(pa.binary()).fill_null(b"")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.fromiter((0 if x is None else x for x in _lengths(batch.column(column))), np.int64, batch.num_rows)
        ends = np.cumsum(sizes + 16)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _lengths(column: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def complete_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that end where ``key`` changes, from rows sorted by it.

    A group is held whole, so callers bound group sizes beforehand.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1])
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(changes):
            cut = int(changes[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
