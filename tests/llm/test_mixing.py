from __future__ import annotations

import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from reviewmill.llm import mixing as M
from tests.llm.data import DOC_SCHEMA


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Water-filling one round at a time; ``sizes`` in source order, null last."""
    weight = [weights[i % 3] for i in range(len(sizes))]
    target, full = [0.0] * len(sizes), set()
    while True:
        left = sum(sizes) * share - sum(most * sizes[i] for i in full)
        free = sum(w for i, w in enumerate(weight) if i not in full)
        if not free:
            return [most * s for s in sizes]
        target = [most * s if i in full else left * weight[i] / free for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(target) if i not in full and t >= most * sizes[i]}
        if not over:
            return target
        full |= over


def corpus(spark, counts, seed=1):
    draw = np.random.default_rng(seed)
    rows, doc = [], 0
    for source, n in counts.items():
        for _ in range(n):
            rows.append((doc, " ".join(["w"] * int(draw.integers(1, 60))), "en", source, 0))
            doc += 1
    return rows, spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.mark.parametrize("block_docs", [16, 4096])
def test_mix_meets_targets(spark, stage, block_docs):
    counts = {"a": 300, "B": 20, "é": 90, "": 5, None: 40, "z": 400}
    rows, docs = corpus(spark, counts)
    got = M.cube_mix(docs, stage, block_docs=block_docs).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(rows)))
    sizes = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in counts}
    order = sorted((s for s in counts if s is not None), key=lambda s: s.encode()) + [None]
    expected = dict(zip(order, plain_targets([sizes[s] for s in order])))
    for source in counts:
        own = [r for r in got if r["source"] == source]
        assert {round(r["target"], 6) for r in own} == {round(expected[source], 6)}
        assert {r["source_size"] for r in own} == {sizes[source]}
        assert abs(sum(r["taken"] for r in own) - expected[source]) <= max(3, 0.01 * expected[source])
        assert abs(sum(r["copies"] for r in own) - len(own) * expected[source] / sizes[source]) <= 3
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)
    again = M.cube_mix(docs.repartition(3), stage, block_docs=block_docs).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}


def test_flight_keeps_both_totals():
    draw = np.random.default_rng(4)
    size, prob = draw.integers(0, 500, 400).astype(float).tolist(), draw.random(400).tolist()
    words, docs = sum(s * p for s, p in zip(size, prob)), sum(prob)
    M.flight(size, prob, iter(draw.random(2000).tolist()))
    assert sum(0 < p < 1 for p in prob) <= 2
    assert sum(s * p for s, p in zip(size, prob)) == pytest.approx(words, abs=1e-4)
    assert sum(prob) == pytest.approx(docs, abs=1e-6)


def test_inclusion_is_fair_on_average():
    hits = np.zeros(12)
    for seed in range(3000):
        prob = [0.3] * 12
        M.flight([float(5 + i % 4) for i in range(12)], prob, iter(np.random.default_rng(seed).random(60).tolist()))
        hits += prob
    assert np.abs(hits / 3000 - 0.3).max() < 0.04


def test_equal_sizes_and_single_documents():
    prob = [0.5] * 9
    M.flight([7.0] * 9, prob, iter(np.random.default_rng(0).random(60).tolist()))
    assert sum(0 < p < 1 for p in prob) <= 1
    alone = [0.7]
    M.land([4.0], alone)
    assert alone == [1.0]


def test_word_count(spark):
    texts = ["a b", " a\t\x0bb\n", "\u00a0x y", "", None, "\x1c"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(M.word_count(M.F.col("t"))).collect()
    assert [r[0] for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_edge_rows(spark, stage):
    rows = [(None, "a b", None, None, None), (1, None, None, "s", None), (1, "x y z", None, "s", None), (1, "x y z", None, "s", None)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).selectExpr("*", "1 as size", "'p' as place", "2 as copies")
    got = M.cube_mix(docs, stage).collect()
    assert len(got) == 4 and sum(r["size"] for r in got) == 8
    assert M.cube_mix(spark.createDataFrame([], DOC_SCHEMA), stage).count() == 0
    blank = spark.createDataFrame([(1, "", None, "s", None)], DOC_SCHEMA)
    assert M.cube_mix(blank, stage).first()["taken"] == 0


def test_delivered_documents(spark, stage):
    _, docs = corpus(spark, {"a": 50, "b": 50, "c": 50})
    docs = docs.selectExpr("*", "'old' as target", "'keep' as note")
    out = M.mix_documents(docs, stage)
    assert {"doc_id", "text", "note", "copies", "taken", "target"} <= set(out.columns)
    rows = out.collect()
    assert rows and all(r["copies"] > 0 and r["note"] == "keep" and r["target"] != "old" for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)


def test_documents_without_or_with_repeated_ids_are_delivered(spark, stage):
    _, docs = corpus(spark, {"a": 60, "b": 60, "c": 60})
    ids = F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 7 == 0, F.lit(7)).otherwise(F.col("doc_id"))
    before = docs.count()
    out = M.mix_documents(docs.withColumn("doc_id", ids), stage).collect()
    assert len(out) <= before and any(r["doc_id"] is None for r in out)
    taken = {}
    for r in out:
        assert r["taken"] == r["copies"] * r["size"] and r["size"] == len(r["text"].split())
        taken.setdefault((r["source"], r["target"]), 0)
        taken[r["source"], r["target"]] += r["taken"]
    assert len(taken) == 3
    for (_, target), words in taken.items():
        assert abs(words - target) <= 0.05 * target
