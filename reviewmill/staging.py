"""Written intermediate tables in the shared folder the cluster names.

A staged table cuts lineage, survives the loss of executors and - unlike a plan over an
aggregate - has a known size, so a later join can choose broadcast or shuffle from facts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; one temporary folder per application for a local master.

    The session is only read: its own checkpoint folder stays as it is.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="reviewmill-")
    return _LOCAL_FOLDERS[context.applicationId]


class Stage:
    """A fresh sub-folder of the shared folder; every table is written once and never changed."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/stage-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        """A path that has not been used before."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def put(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), compression: str | None = None) -> DataFrame:
        """Write ``df`` as Parquet in a new folder and return the table read back. Without ``compression`` the session's is used."""
        schema, columns = df.schema, df.columns
        path = self.path(name)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if compression:
            writer = writer.option("compression", compression)
        writer.parquet(path)
        return self.spark.read.schema(schema).parquet(path).select(*columns)
