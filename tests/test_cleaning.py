from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import dates as D
from reviewmill.functions import numbers as N
from reviewmill.functions import text as X
from reviewmill.operators import dedup
from reviewmill.operators.dedup import drop_unusable, keep_first, repeated_reviews
from reviewmill.operators.joins import look_up
from reviewmill.operators.sentiment import sample_lexicon
from reviewmill.plans.clean import clean_reviews, normalise_text, text_features
from reviewmill.staging import Stage


def test_first_copy_survives_and_nulls_are_equal(reviews):
    raw = reviews(
        dict(review_id="x", user_name=None, rating=5, thumbs_up=2),
        dict(review_id="x", user_name=None, rating=1, thumbs_up=1),
        dict(review_id="x", user_name="", rating=2),
    )
    kept = {(r["user_name"], r["rating"]) for r in keep_first(raw, order_by=["thumbs_up"]).collect()}
    assert kept == {(None, 1), ("", 2)}


def test_key_parts_do_not_run_together(reviews):
    raw = reviews(dict(review_id="ab", user_name="c"), dict(review_id="a", user_name="bc"))
    assert keep_first(raw).count() == 2


def test_surplus_copies_are_dropped_before_the_shuffle(reviews):
    plan = keep_first(reviews({}, {}))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_are_kept_in_place(spark, reviews):
    raw = reviews(
        dict(review_id="x", thumbs_up=2), dict(review_id="x", thumbs_up=1), dict(review_id="y", thumbs_up=5), dict(review_id=None, thumbs_up=3),
        dict(review_id=None, thumbs_up=None),
    )
    kept = keep_first(raw, stage=Stage(spark))
    assert "Sort" not in executed(kept) and "Exchange hashpartitioning" not in executed(kept)
    assert kept.columns == keep_first(raw).columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, keep_first(raw).collect()))


def test_rows_equal_in_every_column_leave_one(spark, reviews):
    raw = reviews(dict(review_id="x"), dict(review_id="y", thumbs_up=1), dict(review_id="y", thumbs_up=2))
    raw = raw.unionByName(raw.filter("review_id = 'x'")).unionByName(raw.filter("thumbs_up = 1"))
    kept = keep_first(raw, stage=Stage(spark))
    assert sorted(map(str, kept.collect())) == sorted(map(str, keep_first(raw).collect())) and kept.count() == 2


def test_places_of_copies_sort_no_text(reviews):
    plan = executed(repeated_reviews(reviews({}, {})))
    assert not any("review_text" in line for line in plan.splitlines() if "Sort" in line or "Exchange" in line)


def test_many_copies_beyond_the_broadcast_limit(spark, reviews, monkeypatch):
    raw = reviews(*[dict(review_id=f"r{i % 7 if i < 80 else i}", thumbs_up=i) for i in range(120)])
    expected = sorted(map(str, keep_first(raw).collect()))
    monkeypatch.setattr(dedup, "look_up", lambda *a, **k: look_up(*a, **k, limit_bytes=0))
    assert sorted(map(str, keep_first(raw, stage=Stage(spark)).collect())) == expected


def test_rows_without_a_copy_take_no_key(spark, reviews):
    """Their texts are read once, for the result; the key of all others is taken of rows that may have a copy only."""
    raw = reviews(dict(review_id="x"), dict(review_id="y"), dict(review_id=None))
    assert "sha2" not in executed(keep_first(raw, stage=Stage(spark)).drop("review_key"))
    twice = raw.unionByName(raw.filter("review_id = 'x'").withColumn("thumbs_up", F.lit(5)))
    plan = executed(keep_first(twice, stage=Stage(spark)).drop("review_key"))
    assert all("CASE WHEN" in line for line in plan.splitlines() if "sha2" in line)


def test_rows_that_differ_in_text_only_are_no_copies(spark, reviews):
    texts = ["a", "b", None, "a", "", "b"]
    raw = reviews(*[dict(review_id="x", review_text=t, thumbs_up=i) for i, t in enumerate(texts)], dict(review_id=None), dict(user_name=None))
    kept = keep_first(raw, stage=Stage(spark))
    assert sorted(map(str, kept.collect())) == sorted(map(str, keep_first(raw).collect())) and kept.count() == 6


def test_cleaned_reviews_store_no_key(spark, reviews, tmp_path):
    stage = Stage(spark, str(tmp_path))
    clean_reviews(reviews(dict(review_text=" a\U0001f600  b"), dict(review_text="ok")), sample_lexicon(spark), stage)
    (stored,) = tmp_path.glob("stage-*/scored_reviews-*")
    rows = spark.read.parquet(str(stored))
    assert "review_key" not in rows.columns and {r["review_length"] for r in rows.collect()} == {4, 2}


def test_no_rows_to_keep(spark, reviews):
    assert keep_first(reviews({}).limit(0), stage=Stage(spark)).isEmpty()


def test_null_rating_of_the_kept_copy_drops_the_review(reviews):
    raw = reviews(dict(review_id="x", rating=None, thumbs_up=0), dict(review_id="x", rating=4, thumbs_up=1))
    assert drop_unusable(keep_first(raw, order_by=["thumbs_up"])).count() == 0


def test_whitespace_and_empty_text(reviews):
    texts = ["  a \n b\x1c ", "   ", " x"]
    rows = normalise_text(reviews(*[dict(review_text=t) for t in texts])).transform(text_features)
    got = [(r["review_text"], r["review_length"], r["word_count"], r["issue_category"]) for r in rows.orderBy("review_id").collect()]
    assert got == [("a b", 3, 2, "none"), ("", 0, 0, "none"), ("x", 1, 1, "none")]


def test_length_counts_code_points(spark):
    assert spark.range(1).select(X.text_length(F.lit("a\U0001f600b"))).first()[0] == 3


def test_issue_order_and_quirks(spark):
    cases = {
        "needs better ui": "none", "ui is bad": "ui", "download fails": "performance",
        "crash then slow": "crash", "cannot log in": "login", "refund my money": "payment", "fine": "none",
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", X.issue_category(F.col("t")).alias("c")).collect()
    assert {r["t"]: r["c"] for r in rows} == cases


def test_label_edges(spark):
    rows = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (-0.0499,)], "s double").select(X.sentiment_label(F.col("s"))).collect()
    assert [r[0] for r in rows] == ["positive", "negative", "neutral", "neutral"]


def test_calendar_texts(spark):
    at = F.lit("2026-07-08 10:00:00").cast("timestamp_ntz")
    row = spark.range(1).select(
        D.month_key(at), D.week_label(at), D.quarter_key(at), D.quarter_name(at), D.month_name(at), D.date_key(at)
    ).first()
    assert tuple(row) == ("2026-07", "2026-07-06/2026-07-12", "2026Q3", "Q3 2026", "Jul 2026", 20260708)


def test_window_label_edges(spark):
    release = F.lit("2026-02-01 00:00:00").cast("timestamp_ntz")
    moments = {
        "2026-01-18 00:00:00": "pre_release_14d", "2026-01-17 23:59:59": None, "2026-01-31 23:59:59": "pre_release_14d",
        "2026-02-01 00:00:00": "post_release_14d", "2026-02-14 23:59:00": "post_release_14d", "2026-02-15 00:00:00": None,
    }
    frame = spark.createDataFrame([(m,) for m in moments], "m string")
    rows = frame.select("m", D.window_label(F.col("m").cast("timestamp_ntz"), release).alias("w")).collect()
    assert {r["m"]: r["w"] for r in rows} == moments


def test_rounding_and_division(spark):
    row = spark.range(1).select(
        N.round_half_away(F.lit(2.5), 0), N.round_half_away(F.lit(-2.5), 0), N.round_half_away(F.lit(0.125), 2),
        N.safe_divide(F.lit(1), F.lit(0)), N.round_half_away(F.lit(None).cast("double"), 2),
    ).first()
    assert tuple(row) == (3.0, -3.0, 0.13, None, None)


def test_release_features_and_null_version(spark, reviews, stage):
    raw = reviews(
        dict(review_date=datetime(2026, 1, 1, 18)),
        dict(review_date=datetime(2026, 1, 15, 1)),
        dict(review_date=datetime(2026, 1, 16, 0)),
        dict(app_version=None, review_date=datetime(2026, 1, 16, 0)),
        dict(review_text=None),
    )
    cleaned = clean_reviews(raw, sample_lexicon(spark), stage)
    got = {
        r["review_id"]: (r["version_release_date"], r["days_since_version_release"], r["is_post_release_window"])
        for r in cleaned.collect()
    }
    first = datetime(2026, 1, 1)
    assert got == {"r0": (first, 0, 1), "r1": (first, 14, 1), "r2": (first, 15, 0), "r3": (None, None, 0)}


def test_no_python_workers_in_the_plan(spark, reviews, stage):
    cleaned = clean_reviews(reviews({}), sample_lexicon(spark), stage)
    plan = cleaned._jdf.queryExecution().toString()
    assert "Python" not in plan


def stored_columns(folder):
    """The columns of every table below a stage's folder."""
    import pyarrow.parquet as pq

    return {f.parent.name: pq.read_schema(f).names for f in folder.glob("stage-*/*/*.parquet")}


@pytest.mark.parametrize("in_place", [True, False])
def test_reviews_cleaned_where_they_are_read_equal_stored_ones(spark, reviews, stage, tmp_path, monkeypatch, in_place):
    from reviewmill.operators import sentiment

    if not in_place:
        monkeypatch.setattr(sentiment, "IN_PLACE_TERMS", 1)
    rows = [dict(review_text=t, app_version=v) for t in (" good  app", "bad", None, "crash\n", "") for v in ("1", "2", None)]
    raw = reviews(*rows, dict(review_id="x", thumbs_up=2), dict(review_id="x", thumbs_up=1), dict(review_id="n", rating=None))
    read = clean_reviews(raw, sample_lexicon(spark), Stage(spark, str(tmp_path)), store=False)
    kept = clean_reviews(raw, sample_lexicon(spark), stage)
    assert read.dtypes == kept.dtypes and sorted(map(str, read.collect())) == sorted(map(str, kept.collect()))
    assert not any("review_text" in columns for columns in stored_columns(tmp_path).values())


def test_columns_of_no_text_take_no_python_worker(spark, reviews, stage):
    cleaned = clean_reviews(reviews({}, {}), sample_lexicon(spark), stage, store=False)
    assert "Python" in executed(cleaned) and "Python" not in executed(cleaned.select("app_name", "is_post_release_window"))


def test_rows_without_a_copy_stay_out_of_a_large_look_up(spark, reviews, tmp_path, monkeypatch):
    raw = reviews(*[dict(review_id=f"r{max(i, 4)}", thumbs_up=i) for i in range(60)], dict(review_id=None))
    expected = sorted(map(str, keep_first(raw).collect()))
    monkeypatch.setattr(dedup, "look_up", lambda *a, **k: look_up(*a, **k, limit_bytes=0))
    monkeypatch.setattr(dedup, "BROADCAST_BYTES", 0)
    kept = keep_first(raw, stage=Stage(spark, str(tmp_path)))
    assert sorted(map(str, kept.collect())) == expected
    (stored,) = tmp_path.glob("stage-*/to_look_up-*")
    assert 5 <= spark.read.parquet(str(stored)).count() < 30
