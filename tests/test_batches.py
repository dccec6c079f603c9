"""Text steps over Arrow batches against plain Python, on rows of their own."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from reviewmill.functions import batches as B
from reviewmill.functions import text as X
from reviewmill.operators import keywords as KW
from reviewmill.operators import sentiment as S
from reviewmill.plans.clean import prepare_reviews

SPACES = "[\t-\r\x1c-\x20\x85\xa0  -     　]+"
PIECES = [" ", "  ", "\n", "\x1c", "\xa0", "　", "a", "good", "GOOD", "-", "--", "!", "?", ".", "but", "Not", "né", "ΑΣ", "İ", ":)", "\x01", "_", "great", "goodness"]


def made_texts(n=600):
    rng = random.Random(3)
    return [None, "", " "] + ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(n)]


def over(spark, texts, expression):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", expression(F.col("t")).alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["id"])]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_white_space_as_before_in_one_pass_of_arrow(spark):
    texts = made_texts()
    expected = [None if t is None else re.sub(SPACES, " ", t).strip(" ") for t in texts]
    assert over(spark, texts, X.clean_text) == expected
    assert "ArrowEvalPython" in plan_of(spark.createDataFrame([("a",)], "t string").select(X.clean_text(F.col("t"))))


def test_bytes_that_are_no_utf8_are_replaced(spark):
    df = spark.range(1).select(F.expr("cast(X'61ff20200a62' as string)").alias("t"))
    assert df.select(X.clean_text(F.col("t"))).first()[0] == "a� b"


def test_issue_by_pattern_and_by_search_agree(spark):
    many = [("x", ["never found " + "z" * 40 + str(i) for i in range(300)] + ["good"]), ("y", ["--", "."])]
    few = [("x", ["good"]), ("y", ["--", "."])]
    texts = made_texts()
    expected = ["none" if t is None else "x" if "good" in t else "y" if "--" in t or "." in t else "none" for t in texts]
    assert over(spark, texts, lambda c: X.issue_category(c, few)) == expected
    assert over(spark, texts, lambda c: X.issue_category(c, many)) == expected


def test_marked_words_are_those_of_a_look_at_every_word(spark):
    values = {"good": 1.9, "great": 3.1, "né": 1.0, "goodness": 2.0, ":)": 2.0, "(odd)": 9.0, "ας": -1.0}
    padded = values | {f"{'q' * 50}{i}": 0.5 for i in range(300)}
    texts = made_texts()
    few = over(spark, texts, B.lexicon_words(values, list(values), S.PUNCTUATION, (S.CAPS_WORD, S.PLAIN_WORD)))
    all_words = over(spark, texts, B.lexicon_words(padded, list(values), S.PUNCTUATION, (S.CAPS_WORD, S.PLAIN_WORD)))
    assert few == all_words
    for text, row in zip(texts, few):
        words = [] if text is None else text.lower().split(" ")
        long = [t for t in values if len(t.strip(S.PUNCTUATION)) > 2]
        short = [t for t in values if t not in long]
        assert [h["at"] for h in row["hits"]] == [i for i, w in enumerate(words) if w.strip(S.PUNCTUATION) in long or w in short]


def test_prepared_reviews_move_no_text(spark, reviews):
    raw = reviews({"review_text": "so slow"}, {"review_text": "fine"})
    for line in plan_of(prepare_reviews(raw)).splitlines():
        assert "Window" not in line and "hashpartitioning(review_key" not in line


def test_short_keyword_tables_are_not_joined(spark, stage):
    docs = spark.createDataFrame([(1, "abcd"), (1, "xyz"), (2, None), (None, "abcd"), (3, "bc")], "k int, t string")
    words = spark.createDataFrame([("bcd", "long", 2), ("bc", "short", 3), ("xy", "first", 1), ("qqq", "absent", 0)], "keyword string, category string, place int")
    small = KW.tag_by_keywords(docs, "k", "t", words, stage=stage)
    assert "Join" not in plan_of(small)
    large = KW.tag_by_keywords(docs, "k", "t", words, limit_bytes=0, stage=stage)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_cleaning_sends_a_text_to_python_once(spark, reviews, stage):
    from reviewmill.operators.sentiment import sample_lexicon
    from reviewmill.plans.clean import label_sentiment, prepare_reviews, score_reviews

    texts = ["  GOOD app,\tbut  bad ui ", "not :) great", "", " ", "crash", "Çok GOOD İ but (bad)!!", "butter is best, But: worst??", "\x01 good but fine", "good’ ΔΣ bad"]
    raw = reviews(*[dict(review_text=t) for t in texts], dict(review_text=None))
    scored = score_reviews(raw, sample_lexicon(spark), stage=stage)
    plan = plan_of(scored)
    assert plan.count("ArrowEvalPython") == 1 and "collapsed(" not in plan and "found(" not in plan
    steps = S.with_sentiment(prepare_reviews(raw, stage=stage), "review_key", "review_text", sample_lexicon(spark)).transform(label_sentiment)
    assert scored.columns == steps.columns
    assert sorted(map(str, scored.collect())) == sorted(map(str, steps.collect())) and scored.count() == len(texts)


def test_words_are_found_by_number_where_lower_case_is_longer(spark):
    texts = ["İİ good :) x", "good", None, "", "a :) but İ Bad", ":)good", "x:)"]
    find = B.lexicon_words({"good": 1.9, "bad": -2.5, ":)": 2.0}, ["good"], S.PUNCTUATION, (S.CAPS_WORD, S.PLAIN_WORD))
    rows = over(spark, texts, find)
    assert [[(h["at"], h["bare"], h["back1"], h["next1"]) for h in r["hits"]] for r in rows] == [
        [(1, "good", "İİ", ":)"), (2, ":)", "good", "x")], [(0, "good", "", "")], [], [],
        [(1, ":)", "a", "but"), (4, "Bad", "İ", "")], [(0, "good", "", "")], [],
    ]
    assert [r["but_at"] for r in rows] == [None, None, None, None, 2, None, None]
