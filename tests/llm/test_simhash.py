from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from reviewmill.llm import simhash as S
from reviewmill.llm.bktree import build, forest_links, search
from reviewmill.llm.components import connected_components
from reviewmill.llm.queries import QUERIES
from tests.llm.data import DOC_SCHEMA, documents, prose, union_find


def plain_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    runs = [words] if 0 < len(words) < k else [words[i : i + k] for i in range(len(words) - k + 1)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = {
    0: "One two THREE four five", 1: "one\ttwo three  four\nfive", 2: None, 3: "", 4: " \x0b ", 5: "ÄÖ äö É é",
    6: "a", 7: "a b c", 8: "x " * 5000, 9: "\u00a0", 10: "one two three four six",
}


def test_fingerprint_matches_plain_python():
    for k in (4, 5):
        for text in TEXTS.values():
            assert S.fingerprint(S.shingle_hashes((text or "").encode(), k)) == plain_fingerprint(text, k)


def test_trees_find_what_brute_force_finds():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 40, dtype=np.uint64)
    words = (base[draw.integers(0, 40, 600)] ^ (np.uint64(1) << draw.integers(0, 64, 600).astype(np.uint64)))[:, None]
    words = np.unique(words)[:, None]
    tree = np.sort(draw.integers(0, 7, len(words)))
    forest, roots = build(words, tree)
    found = set()
    for q, n in search(forest, np.arange(len(words)), roots, 4):
        found |= set(zip(q.tolist(), n.tolist()))
    near = np.bitwise_count(words ^ words.T) <= 4
    assert found == {(a, b) for a, b in zip(*np.nonzero(near & (tree[:, None] == tree[None, :])))}
    label = forest_links(words, tree, np.ones(len(words), bool), np.ones(len(words), bool), 4, pairs_at_once=50)
    expected = union_find(found, range(len(words)))
    assert label.tolist() == [expected[i] for i in range(len(words))]


def test_search_in_the_other_block_only():
    words = np.array([0, 1, 2**40, 2**40 + 1], np.uint64)[:, None]
    tree = np.zeros(4, int)
    nodes, asks = np.array([True, False, True, False]), np.array([False, True, False, True])
    assert forest_links(words, tree, asks, nodes, 1).tolist() == [0, 0, 2, 2]
    assert forest_links(words, tree, ~nodes, np.zeros(4, bool), 1).tolist() == [0, 1, 2, 3]


def test_keys_never_miss_a_pair():
    draw = random.Random(5)
    keys = S.pigeonhole_keys(64, 4)
    for _ in range(300):
        flipped = set(draw.sample(range(64), 4))
        assert any(not flipped & set(k) for k in keys)


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_classes_equal_brute_force(spark, stage, monkeypatch, block_rows):
    monkeypatch.setattr(S, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(S.near_links, "__defaults__", (block_rows,))
    texts = dict(TEXTS)
    for group in range(6):
        words = prose(group, 120)
        for copy in range(8):
            changed = list(words)
            for at in random.Random(copy * 7 + group).sample(range(120), copy // 2):
                changed[at] = "changed"
            texts[20 + group * 10 + copy] = " ".join(changed)
    docs = documents(spark, texts).withColumn("fp0", F.lit("x")).withColumn("id", F.lit(1)).withColumn("component", F.lit(2))
    docs = docs.unionByName(docs.filter("doc_id in (0, 20)"))
    got = S.simhash_classes(docs, stage, shingle_words=4, radius=4).collect()
    prints = {i: plain_fingerprint(t, 4) for i, t in texts.items()}
    pairs = [(a, b) for a, b in combinations(prints, 2) if bin(prints[a] ^ prints[b]).count("1") <= 4]
    parts = union_find(pairs, prints)
    assert len(got) == len(texts) + 2
    for row in got:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == parts[row["doc_id"]]


def test_rows_without_id(spark, stage):
    rows = [(None, "alone here", None, None, None), (None, "same text", None, None, None), (4, "same text", None, None, None)]
    got = {(r["doc_id"], r["component_id"]) for r in S.simhash_classes(spark.createDataFrame(rows, DOC_SCHEMA), stage).collect()}
    assert got == {(None, None), (None, 4), (4, 4)}


def test_one_of_each_class_stays(spark, stage):
    texts = dict(TEXTS)
    for group in range(5):
        words = prose(100 + group, 400)
        for copy in range(4):
            changed = list(words)
            for at in random.Random(copy + 31 * group).sample(range(400), copy):
                changed[at] = f"new{copy}"
            texts[100 + group * 10 + copy] = " ".join(changed)
    # Ids given twice: copies of one text, and two texts of which one is in the class of a smaller id.
    twice = [(100, texts[100]), (7, texts[7]), (102, "a text of its own"), (400, texts[110]), (400, "another text of its own")]
    nameless = [(None, texts[3]), (None, texts[120]), (None, "seen only here"), (None, "seen only  HERE"), (None, "and this one")]
    rows = [*texts.items(), *twice, *nameless]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOC_SCHEMA)
    docs = docs.withColumn("class", F.lit("c")).withColumn("fp0", F.lit(1)).withColumn("component_id", F.lit(2))
    prints = [plain_fingerprint(t, 4) for _, t in rows]
    parts = union_find([(a, b) for a, b in combinations(range(len(rows)), 2) if (prints[a] ^ prints[b]).bit_count() <= 4], range(len(rows)))
    expected = {}
    for n, (i, _) in enumerate(rows):
        expected.setdefault(parts[n], []).append(i)
    expected = [min((i for i in ids if i is not None), default=None) for ids in expected.values()]
    kept = S.drop_near_duplicates(docs, stage, 4, 4)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted(expected, key=str)
    assert len({parts[rows.index((r["doc_id"], r["text"]))] for r in got}) == len(got)
    assert [r["text"] for r in got if r["doc_id"] in (400, 102)] .count("a text of its own") == 1


def test_stage_calls_the_operator(spark, stage):
    """The pipeline's stage keeps the ids that op2 names its classes by."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, folder).select("doc_id").collect()}
    assert kept == {r["component_id"] for r in QUERIES["op2_simhash_bktree"](spark, folder).select("component_id").collect()}


def test_empty_table(spark, stage):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert S.simhash_classes(empty, stage).count() == 0
    assert S.drop_near_duplicates(empty, stage).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_components(spark, stage, kind):
    draw = random.Random(9)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (2000 + 1, 2000)]
    pairs += [(3000 + i, 3001 + i) for i in range(40)]
    nodes = sorted({n for p in pairs if p[0] != p[1] for n in p})
    edges = spark.createDataFrame([*pairs, (None, 1), (2, None)], "a bigint, b bigint").selectExpr(f"cast(a + 100000 as {kind}) a", f"cast(b + 100000 as {kind}) b")
    got = {int(r["node"]) - 100000: int(r["component"]) - 100000 for r in connected_components(edges, "a", "b", stage).collect()}
    assert got == {n: c for n, c in union_find([p for p in pairs if p[0] != p[1]], nodes).items()}


def test_no_edges(spark, stage):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b", stage).count() == 0
