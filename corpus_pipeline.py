"""Documents to a training mix: quality, near duplicates, benchmark leaks, personal data, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm.common import read_table
from reviewmill.llm.decontaminate import drop_leaks
from reviewmill.llm.mixing import mix_documents
from reviewmill.llm.pii import sanitise
from reviewmill.llm.quality import keep_good
from reviewmill.llm.simhash import drop_near_duplicates
from reviewmill.staging import Stage

StageFunction = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"), Stage(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class (four-word shingles, at most four differing bits)."""
    return drop_near_duplicates(docs, Stage(spark), shingle_words=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"), Stage(spark))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    return sanitise(docs, Stage(spark))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, and how often."""
    return mix_documents(docs, Stage(spark))


STAGES: list[tuple[str, StageFunction]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("mixing", mixing),
]

# Trained models, hashes and sampling have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and read again by the next one."""
    stage = Stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage.put(apply(spark, docs, sf_dir), name)
    return docs
