"""Quoted CSV with line breaks inside cells, read by many tasks per file.

Whether a line starts inside a quoted cell depends on the quote marks of everything before it in
its file. Three steps find out without reading a file from its start:

1. Every byte range reports whether it holds an odd number of quote marks.
2. A prefix sum over the ranges of a file, small rows only, says which ranges start inside a cell.
3. Every range joins its own lines to records. What it cannot complete is a fragment: the end
   of a record begun earlier, the beginning of one that goes on, or the middle of one that spans
   the whole range. Fragments meet by file and place; there are two at most per range.

Records are parsed by Spark's own CSV functions. They are stored once, so a table read this way can
be scanned again without another look at the files; a reader that needs them once puts them together where it reads, and only
fragments are stored. Cells must be quoted by RFC 4180: a mark inside
a cell is doubled, and a cell with marks, commas or line breaks stands in marks.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators.joins import BROADCAST_BYTES, payload_bytes
from reviewmill.schemas import INGEST_ORDER, TEXT_COMPRESSION
from reviewmill.staging import Stage

WHOLE, CLOSES, OPENS, MIDDLE = 0, 1, 2, 3
RECORDS = "_file string, _block bigint, _row bigint, kind int, record string"


def ranges_of_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, line) of all physical lines; a range's lines come in order within their task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line"))


def range_starts(lines: DataFrame, stage: Stage) -> DataFrame:
    """(_file, _block, inside): 1 for the ranges that start inside a quoted cell."""
    marks = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    odd = stage.put(lines.groupBy("_file", "_block").agg((F.sum(marks) % 2).cast("int").alias("odd")), "quote_marks")
    uneven = odd.groupBy("_file").agg((F.sum("odd") % 2).alias("odd")).filter("odd = 1").select("_file").first()
    if uneven:
        raise ValueError(f"{uneven['_file']} has an odd number of quote marks; read it with multi_line='one task'")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)).cast("int")
    return stage.put(odd.select("_file", "_block", inside.alias("inside")), "range_starts")


def _with_start(lines: DataFrame, starts: DataFrame, limit_bytes: int) -> DataFrame:
    """``lines`` with ``inside``, a range's lines in order within one task."""
    if payload_bytes(starts) <= limit_bytes:
        return lines.join(F.broadcast(starts), ["_file", "_block"])
    # So many ranges that their list cannot be broadcast: the lines are numbered, dealt and put in order again.
    numbered = lines.withColumn("_line", F.monotonically_increasing_id()).join(starts, ["_file", "_block"])
    return numbered.repartition("_file", "_block").sortWithinPartitions("_file", "_block", "_line").drop("_line")


class _Range:
    """Lines of one byte range on their way to records; a record not yet complete waits in ``held``."""

    def __init__(self, file: str, block: int, inside: int):
        self.file, self.block, self.inside = file, block, inside
        self.begun_here, self.held, self.row = not inside, [], 0

    def feed(self, lines: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
        """(kind, row numbers, records) that the next lines of the range complete."""
        flips = pc.count_substring(lines, '"').to_numpy() % 2
        after = (self.inside + np.cumsum(flips)) % 2
        before = np.concatenate([[self.inside], after[:-1]])
        alone = np.flatnonzero((before == 0) & (after == 0))
        number = self.row + np.cumsum(after == 0) - 1  # records are numbered by the line that ends them
        if len(alone):
            yield WHOLE, number[alone], lines.take(pa.array(alone))
        # All other lines, in order, are stretches from an opening to a closing line.
        parts = np.flatnonzero((before == 1) | (after == 1))
        for i, text in zip(parts.tolist(), lines.take(pa.array(parts)).to_pylist()):
            self.held.append(text)
            if after[i] == 0:
                yield WHOLE if self.begun_here else CLOSES, number[i : i + 1], pa.array(["\n".join(self.held)])
                self.begun_here, self.held = True, []
        self.row += int(np.count_nonzero(after == 0))
        self.inside = int(after[-1])

    def rest(self) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
        if self.held:
            yield OPENS if self.begun_here else MIDDLE, np.array([self.row]), pa.array(["\n".join(self.held)])


def _assemble(batches: Iterator[pa.RecordBatch], kinds: Collection[int] = (WHOLE, CLOSES, OPENS, MIDDLE)) -> Iterator[pa.RecordBatch]:
    def rows(part: _Range, found):
        for kind, number, records in found:
            if kind not in kinds:
                continue
            n = len(records)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.file] * n, pa.string()), pa.array(np.full(n, part.block)), pa.array(number.astype(np.int64)), pa.array(np.full(n, kind, np.int32)), records.cast(pa.string())],
                ["_file", "_block", "_row", "kind", "record"],
            )

    part = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = [batch.column("_file").dictionary_encode().indices.to_numpy(), batch.column("_block").to_numpy()]
        edges = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
        for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            file, block, inside = (batch.column(c)[start].as_py() for c in ("_file", "_block", "inside"))
            if part is None or (part.file, part.block) != (file, block):
                if part:
                    yield from rows(part, part.rest())
                part = _Range(file, block, inside)
            yield from rows(part, part.feed(batch.column("line").slice(start, stop - start)))
    if part:
        yield from rows(part, part.rest())


def stitched(fragments: DataFrame) -> DataFrame:
    """(_file, _block, _row, record) of the records that cross ranges, placed where they begin.

    A record's fragments are one that opens, any number of middles and one that closes, next to each
    other in the order of their file. They are numbered without their texts; then a task holds the
    fragments of one record.
    """
    place = ["_file", "_block", "_row"]
    number = F.sum((F.col("kind") == OPENS).cast("int")).over(Window.partitionBy("_file").orderBy("_block", "_row"))
    numbered = fragments.select(*place, number.alias("_number"))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_row", "record")))
    whole = fragments.join(numbered, place).groupBy("_file", "_number").agg(pieces.alias("pieces"))
    return whole.select("_file", F.col("pieces")[0]["_block"].alias("_block"), F.col("pieces")[0]["_row"].alias("_row"), F.array_join("pieces.record", "\n").alias("record"))


def csv_records(spark: SparkSession, path: str, stage: Stage, broadcast_bytes: int = BROADCAST_BYTES, stored: bool = True) -> DataFrame:
    """(_file, _block, _row, record): the records of all files at ``path`` without their header lines.

    They are ``stored``, or read from the files each time; the files have to stay then. The first three columns order the records of a file. Lines end in a line feed, or in carriage return
    and line feed; blank lines between records are no records.
    """
    lines = ranges_of_lines(spark, path)
    placed = _with_start(lines, range_starts(lines, stage), broadcast_bytes)
    # Lines that the joins let through keep the order of their range, so records can be put together in place.
    placed = placed.select("_file", "_block", "inside", "line")
    if stored:
        parts = stage.put(placed.mapInArrow(_assemble, RECORDS), "csv_records", compression=TEXT_COMPRESSION)
        whole, fragments = parts.filter(F.col("kind") == WHOLE), parts.filter(F.col("kind") != WHOLE)
    else:
        whole = placed.mapInArrow(partial(_assemble, kinds=(WHOLE,)), RECORDS)
        fragments = stage.put(placed.mapInArrow(partial(_assemble, kinds=(CLOSES, OPENS, MIDDLE)), RECORDS), "csv_fragments")
    across = stage.put(stitched(fragments), "csv_records_across")
    records = whole.drop("kind").unionByName(across)
    # A header may hold line breaks as well; it is the first record of its file.
    records = records.filter((F.col("_block") > 0) | (F.col("_row") > 0))
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).filter("record <> ''")


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType, options: Mapping[str, str], stage: Stage, stored: bool = True
) -> DataFrame:
    """``schema`` and the columns of ``INGEST_ORDER``, parsed with Spark's CSV ``options``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    cells = F.from_csv("record", columns, {**options, "multiLine": "true"})
    parsed = csv_records(spark, path, stage, stored=stored).select(cells.alias("_cells"), *INGEST_ORDER)
    return parsed.select(*[F.col("_cells")[name].alias(name) for name in schema.names], *INGEST_ORDER)
