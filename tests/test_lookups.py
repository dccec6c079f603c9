from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import text as X
from reviewmill.operators import joins as J
from reviewmill.operators import keywords as K
from reviewmill.operators import sentiment as S


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bloom_filter_misses_no_value_and_few_strangers_pass(spark):
    table = spark.range(0, 20000, 2).selectExpr("concat('w', id) as word")
    rows = spark.range(20000).selectExpr("id", "concat('w', id) as word").unionByName(spark.createDataFrame([(-1, None)], "id bigint, word string"))
    got = J.maybe_in(rows, "word", J.bloom_filter(table, "word")).filter("_maybe")
    counts = got.agg(F.count_if(F.expr("id % 2 = 0")).alias("own"), F.count_if(F.expr("id % 2 = 1")).alias("others"), F.min("id").alias("least")).first()
    assert counts["own"] == 10000 and counts["others"] < 1500 and counts["least"] == 0


def test_bloom_filter_of_nothing(spark):
    table = spark.createDataFrame([], "word string")
    rows = spark.createDataFrame([("a",), (None,)], "word string")
    assert J.maybe_in(rows, "word", J.bloom_filter(table, "word")).filter("_maybe").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [0, J.BROADCAST_BYTES])
def test_look_up_equals_a_join(spark, stage, how, limit):
    draw = random.Random(3)
    words = ["hot"] * 300 + ["cold", "none", None, "", "twice"] * 20 + [f"w{draw.randint(0, 400)}" for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(words)), "id int, word string")
    known = [("hot", 1), ("cold", 2), ("", 3), ("twice", 4), ("twice", 5), ("unused", 6)] + [(f"w{i}", i) for i in range(0, 400, 3)]
    table = stage.put(spark.createDataFrame(known, "word string, n int"), "known")
    got = J.look_up(rows, table, "word", ["id"], how, limit, stage)
    assert sorted(got.columns) == ["id", "n", "word"]
    expected = [(i, w, n) for i, w in enumerate(words) for n in ([m for k, m in known if k == w] or ([None] if how == "left" else []))]
    assert sorted(map(tuple, got.select("id", "word", "n").collect()), key=str) == sorted(expected, key=str)


def test_hot_values_are_spread_and_strangers_stay(spark, stage):
    rows = spark.range(4000).selectExpr("id", "case when id % 3 = 0 then 'good' when id % 3 = 1 then 'the' else concat('w', id) end as word")
    table = stage.put(spark.createDataFrame([("good", 1)] + [(f"x{i}", i) for i in range(500)], "word string, n int"), "terms")
    stored = {}
    put = stage.put
    stage.put = lambda df, name, **kw: stored.setdefault(name, put(df, name, **kw))
    got = J.look_up(rows, table, "word", ["id"], "inner", 0, stage)
    assert got.count() == 1334
    # What meets the exchange are the stored rows: all of "good", hardly another word.
    travelling = {r["word"]: r["n"] for r in stored["to_look_up"].groupBy("word").agg(F.count("*").alias("n")).collect()}
    assert travelling.pop("good") == 1334 and "the" not in travelling and sum(travelling.values()) < 400
    assert [r["_value"] for r in stored["hot_values"].collect()] == ["good"]


def test_scores_beyond_the_limit_equal_those_in_place(spark, stage):
    draw = random.Random(5)
    vocabulary = [t for t, _ in S.SAMPLE_LEXICON] + ["no", "not", "the", "never", "so", "VERY", "but", "GOOD", "kind", "of", "x!", "least", ""]
    texts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 15))) for _ in range(150)] + [None, "", "good " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    lexicon = spark.createDataFrame(list(S.SAMPLE_LEXICON) + [("no", -1.2), ("kind", 2.4)], "term string, valence double")
    inside = {r["id"]: r["sentiment_score"] for r in S.with_sentiment(docs.filter("t is not null"), "id", "t", lexicon).collect()}
    joined = S.with_all(docs, S.score_by_join(docs, "id", "t", lexicon, limit_bytes=0, stage=stage), "id")
    assert {r["id"]: r["sentiment_score"] for r in joined.filter("t is not null").collect()} == inside


def brute_tags(texts, keywords):
    ordered = sorted((p, c, k) for k, c, p in keywords if None not in (k, c, p))
    return {i: "none" if t is None else next((c for _, c, k in ordered if k in t), "none") for i, t in enumerate(texts)}


@pytest.mark.parametrize("limit", [0, J.BROADCAST_BYTES])
def test_many_keywords_equal_brute_force(spark, stage, limit):
    draw = random.Random(7)
    letters = "abcé😀 "
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 12))) for _ in range(250)] + [None, "", "ab", "a" * 2000 + "zzq"]
    keywords = [("".join(draw.choices(letters, k=draw.randint(1, 6))), f"c{draw.randint(0, 5)}", draw.randint(0, 9)) for _ in range(60)]
    keywords = [k for k in keywords if len(k[0]) > 1] + [("zzq", "tail", 3), ("zzq", "tail", 3), (None, "c", 1), ("b", None, 1), ("😀", "face", 20), ("never there", "n", 0)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string").selectExpr("*", "'x' as keyword", "1 as place", "'y' as category", "'g' as gram")
    table = spark.createDataFrame(keywords, "keyword string, category string, place int").withColumn("id", F.lit(1))
    got = {r["id"]: r["issue_category"] for r in K.tag_by_keywords(docs, "id", "t", table, limit_bytes=limit, stage=stage).collect()}
    assert got == brute_tags(texts, keywords)


def test_keyword_tables_of_nothing_and_of_the_empty_keyword(spark, stage):
    texts = ["crash", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for keywords in ([], [("", "any", 5)], [("", "any", 5), ("cra", "crash", 1)]):
        table = spark.createDataFrame(keywords, "keyword string, category string, place int")
        got = {r["id"]: r["issue_category"] for r in K.tag_by_keywords(docs, "id", "t", table, stage=stage).collect()}
        assert got == brute_tags(texts, keywords)
    table = K.keyword_table(spark)
    assert K.tag_by_keywords(docs.limit(0), "id", "t", table, stage=stage).count() == 0


def test_own_table_equals_the_chain(spark, stage):
    texts = ["it will crash", "cannot log in", "charged, then a crash", "new ui here", "download lags", "fine", "Ui", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    chain = {r["id"]: r["c"] for r in docs.select("id", X.issue_category(F.col("t")).alias("c")).collect()}
    got = {r["id"]: r["issue_category"] for r in K.tag_by_keywords(docs, "id", "t", K.keyword_table(spark), stage=stage).collect()}
    assert got == chain


def test_texts_do_not_travel_with_grams(spark, stage):
    docs = stage.put(spark.createDataFrame([(0, "a crash"), (1, "b")], "id int, t string"), "docs")
    tags = K.tag_by_keywords(docs, "id", "t", K.keyword_table(spark), stage=stage)
    tags.collect()
    # Behind the generator's expression, which reads the text, stand the columns that it hands on.
    handed_on = [line.rsplit("), [", 1)[1] for line in plan_of(tags).split("\n") if "Generate explode" in line]
    assert handed_on and all("_text" not in columns and "id#" in columns for columns in handed_on)


def test_a_long_text_takes_time_in_proportion(spark, stage):
    long = "".join(chr(97 + (i * i) % 26) for i in range(400_000)) + "needle"
    docs = stage.put(spark.createDataFrame([(0, long), (1, "needles"), (2, "no")], "id int, t string"), "docs")
    table = spark.createDataFrame([("needle", "hit", 0)], "keyword string, category string, place int")
    started = time.monotonic()
    got = {r["id"]: r["issue_category"] for r in K.tag_by_keywords(docs, "id", "t", table, stage=stage).collect()}
    assert got == {0: "hit", 1: "hit", 2: "none"} and time.monotonic() - started < 60
