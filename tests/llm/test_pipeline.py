from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from reviewmill.llm import queries
from tests.llm.data import DOC_SCHEMA

FOLDER = "/root/testdata/sf0.001"
BOTH = [n for n in queries.QUERIES if n in queries.ORACLES]


def test_registered():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", BOTH)
def test_equals_sql(spark, name):
    import duckdb

    base = duckdb.connect()
    for table in ("pages", "embeddings", "documents", "labels"):
        base.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    found = queries.QUERIES[name](spark, FOLDER)
    told = base.execute(queries.ORACLES[name])
    names = [d[0] for d in told.description]
    assert sorted(names) == sorted(found.columns)
    rows = sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)
    assert rows == sorted(told.fetchall(), key=str)


def test_stages_in_turn(spark, stage):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, apply in corpus_pipeline.STAGES:
        docs = stage.put(apply(spark, docs, FOLDER), name)
        if name != "mixing":
            assert docs.columns == columns
        after = docs.count()
        assert 0.3 * before < after <= before and (name != "pii" or after == before)
        before = after
    final = docs.collect()
    assert all(r["copies"] in (1, 2) for r in final)
    assert not any(re.search(r"[\w.]+@mail\d\.example\.com", r["text"]) for r in final)
    names = ("doc_id", "text", "copies")
    assert sorted(tuple(r[n] for n in names) for r in corpus_pipeline.run(spark, FOLDER).collect()) == sorted(tuple(r[n] for n in names) for r in final)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, None, None, None), (1, "", "en", "s", 0), (2, "x " * 30_000, "en", None, None)]])
def test_edge_rows_pass_every_stage(spark, stage, rows):
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumn("copies", F.lit(7)).withColumn("id", F.lit("x")).withColumn("text_", F.lit(1))
    for name, apply in corpus_pipeline.STAGES:
        result = apply(spark, docs, FOLDER)
        docs = stage.put(result, name)
    assert docs.count() <= len(rows)
