from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import decontaminate as D
from tests.llm.data import DOC_SCHEMA, documents, prose


def items(spark, texts):
    return spark.createDataFrame(list(texts.items()), "item_id bigint, text string").withColumn("hash", F.lit(1))


def test_tokens():
    hashes, ends = D.token_hashes(pa.array(["One, (two)! THREE", "", "!!! ###", "one two three", "é É"]))
    first, _, _, last, accents = np.split(hashes, ends[:-1])
    assert ends.tolist() == [3, 3, 3, 6, 8] and first.tolist() == last.tolist() and accents[0] == accents[1]


def test_masks_compare_only_their_positions():
    tokens = np.arange(100, 112).astype(np.uint64)
    for number, mask in enumerate(D.masks_for(())):
        window = D.window_hashes(tokens, mask, number)
        for at in range(12):
            other = tokens.copy()
            other[at] = 7
            assert (D.window_hashes(other, mask, number)[0] == window[0]) == (at not in mask)


def test_every_stretch_within_the_rule_has_a_seed():
    masks = D.masks_for(())
    for length in range(12, 30):  # a longer stretch holds one of 15 to 29 tokens that is within the rule
        changes = max(x for x in range(length) if length - x >= 12 and 5 * (length - x) >= 4 * length)
        changed = np.array(list(itertools.combinations(range(length), changes)), np.int64)
        bits = np.bitwise_or.reduce(np.int64(1) << changed, axis=1) if changes else np.zeros(1, np.int64)
        hit = np.zeros(len(bits), bool)
        for mask in masks:
            for at in range(length - mask[-1]):
                hit |= bits & sum(1 << (at + i) for i in mask) == 0
        assert hit.all(), (length, changes)


def test_short_passage_at_the_rule(spark, stage):
    words, fresh = prose(77, 15), ["x", "y", "z"]
    texts = {}
    for i, at in enumerate(itertools.combinations(range(15), 3)):
        changed = list(words)
        for j, w in zip(at, fresh):
            changed[j] = w
        texts[i] = " ".join(changed)
    assert set(leaks(spark, stage, documents(spark, texts), items(spark, {1: " ".join(words)}))) == {(i, 1) for i in range(455)}


def test_best_stretch_is_the_best():
    draw = random.Random(2)
    for _ in range(300):
        equal = np.array([draw.random() < 0.7 for _ in range(draw.randint(0, 15))], bool)
        start, end = D.best_stretch(equal, 2.0)
        score = lambda a, b: sum(1.0 if x else -2.0 for x in equal[a:b])
        assert score(start, end) == max([0.0] + [score(a, b) for a in range(len(equal)) for b in range(a, len(equal) + 1)])


def test_leaking_stretch_equals_brute_force():
    draw = random.Random(5)
    for n in range(1500):
        least, identity = draw.choice([(12, 0.8), (5, 0.8), (6, 0.7), (4, 0.9)])
        chance = draw.choice([0.5, 0.7, 0.8, 0.95])
        equal = np.array([draw.random() < chance for _ in range(draw.randint(0, 45))], bool)
        rule = lambda a, b: equal[a:b].sum() >= least and 10 * equal[a:b].sum() >= round(10 * identity) * (b - a)
        every = [(a, b) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if rule(a, b)]
        start, end = D.leaking_stretch(equal, least, identity)
        assert (end > start) == bool(every)
        if every:
            assert (start, end) in every
            if (start, end) != D.best_stretch(equal, identity / (1 - identity) / 2):
                assert (start, end) == min((s for s in every if equal[s[0]] and equal[s[1] - 1]), key=lambda s: (-equal[s[0] : s[1]].sum(), s))


@pytest.mark.parametrize("runs,length,gap", [(3, 100, 22), (3, 30, 14), (3, 12, 5)])
def test_exact_runs_with_changed_words_between(spark, stage, runs, length, gap):
    words = prose(31, runs * length + (runs - 1) * gap)
    changed = [w if i % (length + gap) < length else "other" for i, w in enumerate(words)]
    got = leaks(spark, stage, documents(spark, {1: " ".join(changed)}), items(spark, {1: " ".join(words)}))
    assert set(got) == {(1, 1)}
    row = got[1, 1]
    assert row["matched"] >= length and 5 * row["matched"] >= 4 * row["words"]


def leaks(spark, stage, docs, bench, **options):
    out = D.benchmark_overlaps(docs, bench, stage, **options).collect()
    return {(r["doc_id"], r["item_id"]): r for r in out}


def test_planted_passages(spark, stage):
    bench = {i: " ".join(prose(500 + i, 40)) for i in range(6)} | {50: "alpha beta gamma delta epsilon zeta", 51: "too short item", 52: None, 53: ""}
    texts = {i: " ".join(prose(i, 150)) for i in range(40)}

    def plant(words, at, into):
        own = texts[into].split()
        texts[into] = " ".join(own[:at] + words + own[at:])

    plant(bench[0].split(), 30, 0)                                        # whole
    plant([w.upper() + "," for w in bench[1].split()], 0, 1)              # case and punctuation
    replaced = bench[2].split()
    for at in (5, 16, 27, 38):
        replaced[at] = "other"
    plant(replaced, 150, 2)                                               # one word in ten replaced
    plant(bench[3].split()[8:30], 10, 3)                                  # a part
    plant(bench[4].split()[:9], 10, 4)                                    # too short a part
    scattered = [w if i % 2 else "other" for i, w in enumerate(bench[5].split())]
    plant(scattered, 10, 5)                                               # every other word: no leak
    plant(bench[50].split(), 10, 6)                                       # a short item needs all of it
    plant(bench[50].split()[:5], 10, 7)
    plant("too short item".split(), 10, 8)
    texts[9] = bench[0] + " filler " + bench[1]
    texts[10], texts[11] = None, ""
    docs = documents(spark, texts).withColumn("tokens", F.lit("x")).withColumn("item_id", F.lit(3)).withColumn("row", F.lit(1))
    docs = docs.unionByName(docs.filter("doc_id = 0")).unionByName(docs.filter("doc_id = 0").withColumn("doc_id", F.lit(None).cast("bigint")))
    got = leaks(spark, stage, docs, items(spark, bench))
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (6, 50), (9, 0), (9, 1)}
    assert (got[0, 0]["doc_start"], got[0, 0]["doc_end"], got[0, 0]["matched"]) == (30, 70, 40)
    assert (got[2, 2]["item_start"], got[2, 2]["matched"], got[2, 2]["words"]) == (0, 35, 38)
    assert (got[3, 3]["item_start"], got[3, 3]["item_end"]) == (8, 30)
    assert got[9, 1]["doc_start"] == 41
    kept = D.drop_leaks(docs, items(spark, bench), stage)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in left if i is not None) == [i for i in range(40) if i not in (0, 1, 2, 3, 6, 9)] and left.count(None) == 1


def test_very_common_passage(spark, stage):
    bench = {1: " ".join(prose(1, 30)), 2: " ".join(prose(1, 30)[:20])}
    texts = {i: " ".join(prose(1, 30) + prose(900 + i, 10)) for i in range(300)}
    assert set(leaks(spark, stage, documents(spark, texts), items(spark, bench))) == {(i, j) for i in range(300) for j in (1, 2)}


@pytest.mark.parametrize("docs,bench", [({}, {1: "a b c d e f"}), ({1: "a b c d e f"}, {})])
def test_empty_tables(spark, stage, docs, bench):
    left = documents(spark, docs) if docs else spark.createDataFrame([], DOC_SCHEMA)
    right = items(spark, bench) if bench else spark.createDataFrame([], "item_id bigint, text string")
    assert leaks(spark, stage, left, right) == {}
