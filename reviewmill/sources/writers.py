"""Sinks. Files are written by the executors; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewmill.plans.star import Star
from reviewmill.schemas import NULL_MARK, TEXT_COMPRESSION


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sort_by: str | None = None) -> None:
    """Replace the table at ``path``. ``sort_by`` orders rows inside each file."""
    if sort_by:
        df = df.sortWithinPartitions(sort_by)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(
            header=True, escape='"', nullValue=NULL_MARK, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    elif fmt == "parquet":
        writer = writer.option("compression", TEXT_COMPRESSION)
    writer.format(fmt).save(path)


def write_cleaned(cleaned: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(cleaned, path, fmt, sort_by="review_date")


def export_star(star: Star, folder: str, fmt: str = "csv") -> list[str]:
    """Write the five star tables to ``folder/<table>``."""
    tables = star.tables()
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}", fmt)
    return list(tables)
