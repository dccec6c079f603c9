"""Session defaults. Size-dependent values stay with the cluster; only semantics are pinned."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "reviewmill", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session: UTC clock, ANSI casts, adaptive plans, skew-join splitting, zstd shuffles.

    Arrow batches are kept short, since a row can hold a long text.

    Extra settings are given as keyword arguments with ``__`` for the dots, for example
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.io.compression.codec", "zstd")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
