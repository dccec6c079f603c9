from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.llm import periodicity as P
from reviewmill.llm.queries import QUERIES
from tests.llm.data import DOC_SCHEMA, documents


def plain_runs(words, least_words=6, least_powers=4):
    """Every maximal repetition by trying each period at each place."""
    n, found = len(words), {}
    for q in range(1, n // least_powers + 1):
        start = 0
        while start + q < n:
            stop = start + q
            while stop < n and words[stop] == words[stop - q]:
                stop += 1
            if stop - start >= max(least_words, least_powers * q):
                found.setdefault((start, stop), q)  # smaller periods come first
            start = max(start + 1, stop - q + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def plain_squares(words):
    out = set()
    for end in range(len(words)):
        for d in range(1, (end + 1) // 2 + 1):
            w = words[end - d + 1 : end + 1]
            if w == words[end - 2 * d + 1 : end - d + 1] and not any(
                d % k == 0 and w == w[:k] * (d // k) for k in range(1, d)
            ):
                out.add((end, d))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_squares_are_all_primitive_squares(words):
    assert set(P.squares(words)) == plain_squares(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=1, max_size=6), st.integers(1, 9)), max_size=6))
def test_runs_equal_brute_force(parts):
    words = [w for unit, times in parts for w in unit * times]
    assert P.word_runs(words) == plain_runs(words)
    assert P.word_runs(words, 5, 5) == plain_runs(words, 5, 5)


def test_runs_in_long_mixed_texts():
    for seed in range(40):
        draw = random.Random(seed)
        words = [b"w%d" % min(draw.randrange(60), draw.randrange(60)) for _ in range(900)]
        for _ in range(4):
            a, q = draw.randrange(800), draw.randrange(1, 30)
            for i in range(a + q, min(900, a + q * draw.randrange(2, 9))):
                words[i] = words[i - q]
        assert P.word_runs(words) == plain_runs(words)


def test_the_cut_spares_prose_from_the_automaton():
    draw = random.Random(1)
    prose = [b"w%d" % draw.randrange(500) for _ in range(5000)]
    marks = P.np.fromiter(map(hash, prose), P.np.int64, len(prose)).view(P.np.uint64)
    assert sum(b - a for a, b in P.repeated_stretches(marks, 6)) < 100


@pytest.mark.parametrize("unit", [1, 7, 4000])
def test_very_long_texts(unit):
    words = [b"w%d" % (i % unit) for i in range(30_000)]
    assert P.word_runs(words) == [(0, 30_000, unit)]
    assert P.collapsed(words, P.word_runs(words)) == b" ".join(words[:unit])


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(9)
    texts = {0: None, 1: "", 2: " \t\n", 3: "a a a a a a", 4: "a a a a a", 5: "Ä Ä b Ä Ä b Ä Ä b Ä Ä b ende", 6: "one"}
    for i in range(7, 160):
        n = draw.choice([1, 3, 12, 60, 200])
        words = [f"w{min(draw.randrange(30), draw.randrange(30))}" for _ in range(n)]
        texts[i] = draw.choice([" ", "  ", "\n", "  "]).join(words)
    docs = documents(spark, texts).withColumn("runs", F.lit("clash")).withColumn("_words", F.lit(1)).withColumn("n_words", F.lit(2))
    again = docs.filter("doc_id in (3, 5)")
    nameless = spark.createDataFrame([(None, "b b b b b b", None, None, None)], DOC_SCHEMA)
    docs = docs.unionByName(again).unionByName(nameless, allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).select(*COLUMNS).collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted((expected_row(*r) for r in rows), key=key)
    assert any(r[1] and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in got)


def test_query_on_given_documents(spark):
    """Every document of the smallest table against the brute force."""
    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, folder).select(*COLUMNS).collect()}
    for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        if row["text"] is None or len(row["text"]) < 15_000:
            assert got[row["doc_id"]] == expected_row(row["doc_id"], row["text"])


def test_empty_table_and_operator_columns(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert P.periodic_runs(empty).count() == 0
    row = P.periodic_runs(documents(spark, {1: "x  a b a b\na b a b y"})).first()
    assert row["n_words"] == 10 and [tuple(r) for r in row["runs"]] == [(1, 8, 2)] and row["collapsed"] == "x a b y"
    with pytest.raises(ValueError):
        P.periodic_runs(empty, least_powers=2)
