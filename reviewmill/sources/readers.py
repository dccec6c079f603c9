"""Readers and ingest shaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions.text import NA_VALUES, missing_to_null
from reviewmill.schemas import INGEST_ORDER, NULL_MARK, RAW_REVIEWS
from reviewmill.sources.quoted_csv import read_quoted_csv
from reviewmill.staging import Stage


CSV_OPTIONS = {
    "nullValue": NULL_MARK, "quote": '"', "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS][.SSS]",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool | str = True, stage: Stage | None = None, keep_order: bool = False,
    stored: bool = True,
) -> DataFrame:
    """A CSV table as ``write_table`` writes it: empty text and null are told apart.

    With ``multi_line`` a text may hold line breaks; files are still read by many tasks (``quoted_csv``), and the
    records are stored in ``stage``, or, if not ``stored``, put together on each reading. Without it every line is a row. ``"one task"`` reads a file by a single task,
    for files with quote marks inside unquoted cells. ``keep_order`` adds the columns of ``INGEST_ORDER``.
    """
    if multi_line is True:
        rows = read_quoted_csv(spark, path, schema, CSV_OPTIONS, stage or Stage(spark), stored)
        return rows if keep_order else rows.select(*schema.names)
    rows = spark.read.schema(schema).options(header=True, multiLine=bool(multi_line), **CSV_OPTIONS).csv(path)
    return rows.select("*", *_places()) if keep_order else rows


def _places() -> list[Column]:
    """Where a row of a file source stands."""
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def read_raw_reviews(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    na_values: Sequence[str] = NA_VALUES,
    keep_order: bool = True,
    multi_line: bool | str = True,
    stage: Stage | None = None,
) -> DataFrame:
    """Raw reviews with a fixed schema; texts in ``na_values`` become null in CSV sources.

    ``keep_order`` adds the columns of ``INGEST_ORDER``, by which ``keep_first`` lets the first copy in
    file order survive.
    """
    if fmt != "csv":
        raw = spark.read.schema(RAW_REVIEWS).format(fmt).load(path)
        return raw.select(*RAW_REVIEWS.names, *(_places() if keep_order else []))
    # Read as text first, so that a missing mark in a numeric column is null as well.
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_REVIEWS.fields])
    raw = read_csv(spark, path, texts, multi_line, stage, keep_order)

    def typed(field: T.StructField):
        text = missing_to_null(F.col(field.name), na_values)
        if isinstance(field.dataType, T.IntegerType):
            return text.cast("double").cast("int").alias(field.name)
        return text.cast(field.dataType).alias(field.name)

    return raw.select(*[typed(f) for f in RAW_REVIEWS.fields], *(INGEST_ORDER if keep_order else []))


def read_cleaned(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", multi_line: bool | str = True, stage: Stage | None = None,
    stored: bool = True,
) -> DataFrame:
    """A stored cleaned table with typed dates; the last three arguments are those of ``read_csv``."""
    if fmt == "csv":
        return read_csv(spark, path, schema, multi_line, stage, stored=stored)
    return spark.read.schema(schema).format(fmt).load(path)


def shape_batch(rows: DataFrame, fields: Mapping[str, str], app_id: str | None = None, app_name: str | None = None) -> DataFrame:
    """Rename source fields to the raw contract and cast them; tag with the app when given.

    ``fields`` maps contract column to source column; columns without a source are null.
    """
    fixed = {"app_id": app_id, "app_name": app_name}

    def column(field: T.StructField):
        if fixed.get(field.name) is not None:
            source = F.lit(fixed[field.name])
        elif field.name in fields:
            source = F.col(fields[field.name])
        else:
            source = F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in RAW_REVIEWS.fields])


def combine_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches, matched by column name."""
    return reduce(DataFrame.unionByName, batches)


def read_app_folders(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """Batches stored as ``folder/app_name=<name>/`` in one scan."""
    return spark.read.schema(RAW_REVIEWS).format(fmt).load(folder).select(*RAW_REVIEWS.names)


def empty_apps(expected: DataFrame, raw: DataFrame) -> DataFrame:
    """Expected apps without a single row. ``expected`` has app_id."""
    return expected.join(raw.select("app_id").distinct(), "app_id", "left_anti")


def require_all_apps(expected: DataFrame, raw: DataFrame) -> None:
    """Stop when an expected app delivered nothing."""
    found = empty_apps(expected, raw).agg(F.count(F.lit(1)).alias("n"), F.min("app_id").alias("first")).first()
    if found["n"]:
        raise RuntimeError(f"{found['n']} apps without reviews, the first {found['first']}; empty_apps lists them")
