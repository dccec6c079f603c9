from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import quality as Q
from reviewmill.llm import toxicity as T
from tests.llm.data import DOC_SCHEMA, documents, prose

LABELS = "doc_id bigint, quality int, toxic int"


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def corpus(spark):
    draw = random.Random(6)
    texts, labels = {}, []
    for i in range(600):
        words = prose(i, draw.randint(20, 80))
        toxic, poor = i % 6 == 0, i % 5 == 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["blockhead", "numbskull", "dimwit"])
        if poor:
            words = [w.upper() + "!!" for w in words] if i % 2 else [words[0]] * len(words)
        texts[i] = " ".join(words)
        labels.append((i, int(not poor), int(toxic)))
    labels += [(None, 1, 1), (5000, 1, 0), (3, None, None), (4, 7, 7)]
    texts |= {700: None, 701: "", 702: " \n ", 703: "w " * 50_000}
    docs = documents(spark, texts).withColumn("label", F.lit("x")).withColumn("score", F.lit(9)).withColumn("log_words", F.lit("y"))
    docs = docs.unionByName(docs.filter("doc_id = 10")).unionByName(docs.filter("doc_id = 10").withColumn("doc_id", F.lit(None).cast("bigint")))
    return docs, spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("z"))


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_accuracy_and_edges(spark, stage, kind):
    docs, labels = corpus(spark)
    score = Q.score_quality if kind == "quality" else T.score_toxicity
    rows = score(docs, labels, stage).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for i, r in by_id.items():
        assert 0.0 <= r["score"] <= 1.0 and r["held_out"] == (i is None or fold(i) == 0)
        assert r["predicted"] == int(r["score"] >= (0.3 if kind == "quality" else 0.5))
    truth = {i: int(i % 5 != 0) if kind == "quality" else int(i % 6 == 0) for i in range(600)}
    held = [i for i in range(600) if fold(i) == 0]
    assert np.mean([by_id[i]["predicted"] == truth[i] for i in held]) > 0.95
    assert by_id[700]["score"] == by_id[701]["score"]
    assert len({r["score"] for r in rows if r["doc_id"] in (10, None)}) == 1


@pytest.mark.parametrize("score", [Q.score_quality, T.score_toxicity])
def test_few_labels(spark, stage, score):
    docs = documents(spark, {1: "a b", 2: None})
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in score(docs, none, stage).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 1)], LABELS)
    assert all(r["score"] > 0.99 for r in score(docs, one, stage).collect())
    held_out = next(i for i in range(100) if fold(i) == 0)
    only_held_out = spark.createDataFrame([(held_out, 1, 1)], LABELS)
    assert {r["score"] for r in score(documents(spark, {held_out: "x"}), only_held_out, stage).collect()} == {0.5}
    assert score(spark.createDataFrame([], DOC_SCHEMA), one, stage).count() == 0


def test_held_out_labels_are_not_learnt(spark, stage):
    docs, labels = corpus(spark)
    wrong = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r["doc_id"], r["score"]) for r in T.score_toxicity(docs.filter("doc_id is not null"), x, stage).collect()) for x in (labels, wrong))
    assert a == b


def test_ngrams_equal_plain_python():
    for text in (b"", b"ab", b" a  b\n", "héllo wörld".encode(), b"x" * 50):
        padded = b" " + b" ".join(text.split()) + b" "
        plain = set()
        for n, m in zip((3, 4, 5), T.MULTIPLIERS):
            for at in range(len(padded) - n + 1):
                plain.add(int.from_bytes(padded[at : at + n], "little") * m % 2**64 >> 64 - T.BUCKET_BITS)
        assert set(T.present(text).tolist()) == plain


def test_stretches_lose_nothing(monkeypatch):
    text = random.Random(1).randbytes(3000)
    whole = T.present(text)
    monkeypatch.setattr(T, "BYTES_AT_ONCE", 100)
    assert T.present(text).tolist() == whole.tolist()


def test_rules_are_tree_paths(spark, stage):
    rows = spark.createDataFrame([(float(i % 10 > 4 and i % 7 > 2), float(i % 10), float(i % 7)) for i in range(400)], "label double, a double, b double")
    model = Q.fit_rules(rows, ["a", "b"], stage)
    assert model.rules and any(len(r.terms) == 2 for r in model.rules)
    scored = rows.select("label", model.score().alias("s")).collect()
    assert np.mean([(r["s"] > 0.5) == (r["label"] == 1.0) for r in scored]) > 0.98


def test_keep_good(spark, stage):
    docs, labels = corpus(spark)
    kept = Q.keep_good(docs, labels, stage)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert None in ids and len([i for i in range(600) if (i in ids) != (i % 5 != 0)]) <= 6
