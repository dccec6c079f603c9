from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import divergence as D
from tests.llm.data import DOC_SCHEMA


def plain_audit(rows, least_docs=10, top=10):
    """The two parts straight from their definition, with Python's whole numbers."""
    lower = str.maketrans(D.UPPER, D.LOWER)
    counts, holders, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((x or "" for x in row) for row in rows):
        groups.add((lang, source))
        terms = [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        counts[lang, source].update(terms)
        holders[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= least_docs]
        sources = sorted(s for x, s in groups if x == lang)
        share = lambda n, size: 1 + 10**9 * (n + 2) // (size + 2 * len(kept))
        difference = lambda p, q: (p - q) ** 2 // (p + q)
        size = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], size[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(size.values())) for t in kept}
        for s in sources:
            pairs = [(sum(difference(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(difference(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            order = lambda x: (-x[0], x[1].encode())
            out |= {(lang, s, "pair", o, v, i) for i, (v, o) in enumerate(sorted(pairs, key=order), 1)}
            out |= {(lang, s, "term", t, v, i) for i, (v, t) in enumerate(sorted(terms, key=order)[:top], 1)}
    return out


def corpus(seed, docs=260):
    draw = random.Random(seed)
    vocabulary = [w for i in range(60) for w in (f"w{chr(97 + i % 26)}{chr(97 + i // 26)}", f"É{chr(97 + i % 26)}ß")] + ["𝒳y", "ｘ", "Zeta", "zeta"]
    rows = []
    for i in range(docs):
        lang, source = draw.choice(["en", "de", None]), draw.choice(["a", "b", "c", "d", "", None])
        words = [draw.choice(vocabulary[: draw.choice([5, 30, 124])]) for _ in range(draw.randrange(60))]
        rows.append((draw.choice([" ", "1", "\n", "\x7f."]).join(words), lang, source))
    return rows + [(None, "en", "a"), ("", "xx", "only"), ("lonely words", "yy", "p"), ("!", "yy", "q"), ("x", "yy", None), ("a\x00b\x7fc" * 12, "en", "a")]


def table(spark, rows):
    full = [(i, t, lang, source, None) for i, (t, lang, source) in enumerate(rows)]
    return spark.createDataFrame(full, DOC_SCHEMA).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("p", F.lit(1))


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_brute_force(spark, stage, seed):
    rows = corpus(seed)
    got = D.source_divergence(table(spark, rows).repartition(5), stage)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows)


def test_terms_of_slices():
    texts = ["", "Ab", "cD é", None, "12", "x", "y1", "ÀB\x00\x7f𝒳", ""]
    cells = D.utf8(D.pa.array(texts, D.pa.string()))
    for start in range(len(texts)):
        for stop in range(start, len(texts) + 1):
            row, terms = D.terms_of(cells.slice(start, stop - start))
            lower = str.maketrans(D.UPPER, D.LOWER)
            found = [(i, t.translate(lower)) for i, x in enumerate(texts[start:stop]) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", x or "")]
            assert list(zip(row.tolist(), terms.to_pylist())) == found


def test_sources_in_blocks(spark, stage):
    rows = [(t, "en", f"s{i % 7}") for i, (t, _, _) in enumerate(corpus(3))]
    audit = D.Audit(table(spark, rows), stage)
    want = {r[:2] + r[3:5] for r in plain_audit(rows) if r[2] == "pair"}
    for width in (2, 3, 512):
        assert {tuple(r) for r in audit.pairs(width).select("lang", "source", "item", "value").collect()} == want


def test_ties_go_by_utf8_order(spark, stage):
    words = ["b", "a", "ｘ", "𝒳", "é", "z"] + [f"t{c}" for c in "abcdefgh"]
    rows = [(" ".join(words), "en", "hot")] * 30 + [("other things", "en", "cold")] * 30
    got = D.Audit(table(spark, rows), stage).terms().filter("source = 'hot'").orderBy("rank").collect()
    assert [r["item"] for r in got] == sorted(words, key=str.encode)[:10]
    assert len({r["value"] for r in got}) == 1


def test_skyband_holds_what_can_be_ranked():
    draw = np.random.default_rng(4)
    for k in (1, 3, 10):
        n = draw.integers(1, 40, 3000)
        total = n + draw.integers(0, 60, 3000)
        band = D.Skyband(k)
        members = [start + i for start in range(0, 3000, 170) for i in band.feed(n[start : start + 170], total[start : start + 170])]
        dominators = [np.count_nonzero((n[:i] >= n[i]) & (total[:i] <= total[i])) for i in range(3000)]
        assert members == [i for i in range(3000) if dominators[i] < k]


def test_shares_are_exact_beyond_a_product(spark):
    pairs = [(2, 14), (9 * 10**14, 10**15 + 7), (3, 3), (123_456_789_012, 999_999_999_999_989), (10**12, 3 * 10**12)]
    want = [1 + 10**9 * a // b for a, b in pairs]
    a, b = (np.array(x, np.int64) for x in zip(*pairs))
    assert D.share(a, b, np.floor_divide).tolist() == want
    rows = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert [r[0] for r in rows.select(D.share(F.col("a"), F.col("b"))).collect()] == want


def test_no_task_gets_a_source(spark, stage):
    """Terms are spread by term; the only exchange by source alone is that of the merged skybands."""
    audit = D.Audit(table(spark, corpus(1)), stage)
    plan = audit.terms()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 3
    lowest = plan[plan.rindex("MapInArrow") :]
    assert "hashpartitioning(lang" not in lowest


def test_empty_table(spark, stage):
    assert D.source_divergence(spark.createDataFrame([], DOC_SCHEMA), stage).count() == 0
