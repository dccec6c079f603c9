from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reviewmill import REPORTS, build_star, clean_reviews, run_reports
from reviewmill.operators import joins, keys, ranking
from reviewmill.operators.sentiment import sample_lexicon
from reviewmill.plans import kpi, measures
from reviewmill.plans import star as build
from reviewmill.plans.reports import worst_versions

START = datetime(2026, 1, 1)


def sample_rows():
    """Two apps, three versions and a null one, a month gap, ties in likes."""
    rows = []
    for i in range(120):
        app = "a" if i % 3 else "b"
        version = None if i % 11 == 0 else f"{i // 40}.0"
        day = START + timedelta(days=i + (40 if i > 80 else 0), hours=i % 24)
        text = ["good app", "bad and slow", "crash!", "pay bill fails", "nice ui here", "x"][i % 6]
        rows.append(dict(
            app_id=f"com.{app}", app_name=app.upper(), rating=i % 5 + 1, review_text=text, thumbs_up=i % 4,
            app_version=version, review_date=day, reply_text="hi" if i % 7 == 0 else None,
        ))
    return rows


@pytest.fixture(scope="module")
def model(spark, reviews):
    from reviewmill import Stage

    stage = Stage(spark)
    cleaned = stage.put(clean_reviews(reviews(*sample_rows()), sample_lexicon(spark), stage), "cleaned")
    return cleaned, build_star(cleaned, stage), stage


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_fact_has_one_row_per_review_and_all_keys(model):
    cleaned, star, _ = model
    fact = star.fact_reviews
    assert fact.count() == cleaned.count() == 120
    missing = fact.filter("app_key is null or version_key is null or issue_key is null or date_key is null")
    assert missing.count() == 0


def test_dimension_keys(model):
    _, star, _ = model
    assert [r["app_key"] for r in star.dim_app.orderBy("app_name").collect()] == [1, 2]
    versions = star.dim_app_version.orderBy("version_key").collect()
    assert [v["version_key"] for v in versions] == list(range(1, len(versions) + 1))
    dates = [v["version_release_date"] for v in versions]
    known = [d for d in dates if d]
    assert known == sorted(known) and dates[len(known):] == [None, None]


def test_dense_keys_over_many_ranges(spark, stage):
    table = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"))
    got = keys.dense_keys(table, "k", [F.col("v").asc()], stage, "many")
    assert got.filter("k <> v + 1").count() == 0 and got.count() == 1000


def test_shares_and_totals(model):
    _, star, stage = model
    ranking_rows = {r["app_name"]: r["review_count"] for r in rows_of(REPORTS["q1_app_ranking"](star, stage))}
    split = defaultdict(int)
    for r in rows_of(REPORTS["q7_reply_split"](star, stage)):
        split[r["app_name"]] += r["review_count"]
    assert split == ranking_rows
    for r in rows_of(REPORTS["q3_issue_frequency"](star, stage)):
        assert r["issue_review_count"] <= r["total_reviews"] == ranking_rows[r["app_name"]]


def test_null_version_comes_first_and_is_the_previous_one(model):
    _, star, stage = model
    health = rows_of(REPORTS["q2_version_health"](star, stage))
    first, second = health[0], health[1]
    assert first["app_version"] is None and first["rating_change_vs_prev"] is None
    assert second["rating_change_vs_prev"] == pytest.approx(second["avg_rating"] - first["avg_rating"], abs=1e-9)


def test_rolling_mean_counts_rows_not_months(model):
    _, star, stage = model
    trend = [r for r in rows_of(REPORTS["q4_monthly_trend"](star, stage)) if r["app_name"] == "A"]
    means = [r["avg_rating"] for r in trend]
    for i, r in enumerate(trend):
        window = means[max(0, i - 2): i + 1]
        assert r["rolling_3mo_avg_rating"] == pytest.approx(sum(window) / len(window), abs=0.0051)


def test_release_impact_against_brute_force(model):
    cleaned, star, stage = model
    rows = rows_of(cleaned)
    releases = {(r["app_name"], r["app_version"]): r["version_release_date"] for r in rows if r["version_release_date"]}
    want = {}
    for (app, version), release in releases.items():
        span = timedelta(days=14)
        pre = [r["rating"] for r in rows if r["app_name"] == app and release - span <= r["review_date"] < release]
        post = [r["rating"] for r in rows if r["app_name"] == app and release <= r["review_date"] < release + span]
        if pre and post:
            want[(app, version)] = (len(pre), len(post))
    got = {
        (r["app_name"], r["app_version"]): (r["pre_review_count"], r["post_review_count"])
        for r in rows_of(REPORTS["q5_release_impact"](star, stage))
    }
    assert got == want and want


def test_ties_at_the_cutoff_are_all_kept(spark, stage):
    rows = [("a", 9)] * 6 + [("a", 8)] * 3 + [("b", 5), ("b", 4), ("b", 4), ("b", 3), ("b", 2), ("b", 2), ("b", 1)] + [("c", None)]
    frame = spark.createDataFrame(rows, "g string, s int")
    got = sorted((r["g"], r["s"] or -1) for r in ranking.top_ranked(frame, ["g"], "s", 5, stage, "ties").collect())
    assert got == [("a", 9)] * 6 + [("b", 2), ("b", 2), ("b", 3), ("b", 4), ("b", 4), ("b", 5), ("c", -1)]


def test_small_groups_are_left_out_of_worst_versions(model):
    cleaned, star, stage = model
    sizes = {(r["app_name"], r["app_version"]): r["count"] for r in cleaned.groupBy("app_name", "app_version").count().collect()}
    for minimum in (1, 10, 12):
        got = {(r["app_name"], r["app_version"]) for r in rows_of(worst_versions(star, stage, min_reviews=minimum))}
        assert got == {k for k, n in sizes.items() if n >= minimum}


def test_slicing_the_star_equals_slicing_the_reviews(model):
    cleaned, star, _ = model
    chosen = dict(apps=["A"], issues=["none", "ui"], labels=["positive", "neutral"], start="2026-01-05", end="2026-03-03")
    assert measures.slice_star(star, **chosen).fact_reviews.count() == measures.slice_reviews(cleaned, **chosen).count() > 0


def test_kpis(model):
    cleaned, _, stage = model
    table = {r["metric"]: r["value"] for r in rows_of(kpi.kpi_table(cleaned, stage))}
    assert table["Total Reviews"] == "120" and table["Apps Compared"] == "2"
    assert table["Most Common Issue"] == kpi.most_common_issue(cleaned).first()["top_issue"]
    none = cleaned.filter("issue_category = 'none'")
    assert kpi.most_common_issue(none).first()["top_issue"] == "none"


def test_previous_release_spans_all_apps(model):
    _, star, _ = model
    rows = rows_of(measures.rating_vs_previous_release(star))
    assert len(rows) == star.dim_app_version.count()
    blank = [r for r in rows if r["version_release_date"] is None]
    assert all(r["rating_change_vs_prev_version"] in (0.0, r["avg_rating"]) for r in blank)


def test_large_tables_are_not_broadcast(spark, stage):
    stored = stage.put(spark.range(1000), "ids")
    assert "broadcast" in joins.broadcast_if_small(stored)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in joins.broadcast_if_small(stored, 100)._jdf.queryExecution().logical().toString().lower()


def test_a_failing_report_does_not_stop_the_rest(model, tmp_path, monkeypatch):
    _, star, stage = model

    def broken(star, stage):
        raise ValueError("no")

    monkeypatch.setitem(REPORTS, "q1_app_ranking", broken)
    outcome = run_reports(star, str(tmp_path), stage, ["q1_app_ranking", "q7_reply_split"])
    assert outcome == {"q1_app_ranking": "ValueError: no", "q7_reply_split": None}
    assert (tmp_path / "q7_reply_split").exists()


def test_undated_reviews_stop_the_build(spark, reviews, stage):
    cleaned = clean_reviews(reviews(dict(review_date=None)), sample_lexicon(spark), stage)
    with pytest.raises(ValueError):
        build_star(cleaned, stage)


def test_apps_with_one_name_stay_apart(spark, reviews, stage):
    rows = [dict(app_id=f"com.{a}", app_name="Same", reply_text="x" if i % 2 else None, review_text=f"crash {i}") for a in "xy" for i in range(6)]
    cleaned = clean_reviews(reviews(*rows), sample_lexicon(spark), stage)
    star = build_star(cleaned, stage)
    for name, counts in {"q1_app_ranking": [6, 6], "q2_version_health": [6, 6], "q7_reply_split": [3, 3, 3, 3]}.items():
        assert [r["review_count"] for r in rows_of(REPORTS[name](star, stage))] == counts
    assert [(r["issue_review_count"], r["total_reviews"]) for r in rows_of(REPORTS["q3_issue_frequency"](star, stage))] == [(6, 6), (6, 6)]


def test_own_categories_have_keys_and_unknown_ones_stop_the_build(spark, reviews, stage):
    own = (("ads", ("advert",)), ("crash", ("crash",)))
    rows = [dict(review_text=t) for t in ("too many adverts", "crash", "fine")]
    cleaned = clean_reviews(reviews(*rows), sample_lexicon(spark), stage, keywords=own)
    star = build_star(cleaned, stage, own)
    assert {r["issue_category"]: r["total_reviews"] for r in rows_of(REPORTS["q3_issue_frequency"](star, stage))} == {"ads": 3, "crash": 3}
    assert set(measures.issue_matrix(star).columns) == {"app_name", "ads", "crash", "none"}
    with pytest.raises(ValueError, match="ads"):
        build_star(cleaned, stage)


def test_audit_moves_no_text(model, reviews):
    from reviewmill.plans.audit import cleaning_counts

    cleaned, _, _ = model
    raw = reviews(*sample_rows(), dict(review_text=None), dict(rating=None), sample_rows()[0] | {"review_id": "r0"})
    plan = cleaning_counts(raw, cleaned)._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert aggregates and not any("review_text#" in line for line in aggregates)
    counts = {r["detail"]: r["row_count"] for r in rows_of(cleaning_counts(raw, cleaned)) if r["step"] == "clean"}
    assert counts == {"rows_in": 123, "after_dedup": 122, "after_null_drop": 120, "final": 120}


def test_every_date_and_issue_attribute_slices(model):
    _, star, _ = model
    for by in ("year", "month", "week_start", "issue_description", "quarter", "month_name"):
        assert sum(r["total_reviews"] for r in rows_of(measures.measures(star, [by]))) == 120


def test_cutoff_reaches_the_scan(spark, model):
    _, star, stage = model
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = REPORTS["q6_liked_complaints"](star, stage)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    assert "GreaterThanOrEqual(thumbs_up," in plan


def test_rows_without_a_score_stay_where_a_group_needs_them(spark, model):
    stage = model[2]
    frame = spark.createDataFrame([("a", 5), ("a", 4), ("b", None), ("b", 1), ("c", None)], "g string, s int")
    got = sorted((r["g"], r["s"] or -1) for r in ranking.top_ranked(frame, ["g"], "s", 2, stage, "few").collect())
    assert got == [("a", 4), ("a", 5), ("b", -1), ("b", 1), ("c", -1)]
    assert ranking.top_ranked(frame.limit(0), ["g"], "s", 2, stage, "none").isEmpty()


def test_dimensions_from_facets_equal_those_from_reviews(spark, model):
    cleaned, star, stage = model
    assert rows_of(star.dim_app.orderBy("app_key")) == rows_of(build.dim_app(cleaned, stage).orderBy("app_key"))
    assert rows_of(star.dim_app_version.orderBy("version_key")) == rows_of(build.dim_app_version(cleaned, stage).orderBy("version_key"))
    assert rows_of(star.dim_date.orderBy("date")) == rows_of(build.dim_date(cleaned).orderBy("date"))
    assert build.review_facets(cleaned.unionByName(cleaned)).count() == build.review_facets(cleaned).count()


def test_audit_counts_rows_without_a_copy_where_they_are_read(spark, reviews):
    from reviewmill.operators.dedup import drop_unusable, keep_first
    from reviewmill.plans.audit import dedup_counts

    def sha(frame):
        return "sha2" in frame._jdf.queryExecution().optimizedPlan().toString()

    def counted(raw):
        first = keep_first(raw)
        return raw.count(), first.count(), drop_unusable(first).count()

    copies = dict(review_id="x", user_name=None)
    alone = reviews(dict(), dict(review_text=None), dict(rating=None), dict(review_id=None))
    assert tuple(dedup_counts(alone).first()) == counted(alone) == (4, 4, 2) and not sha(dedup_counts(alone))
    raw = alone.unionByName(reviews(
        dict(copies, rating=None, thumbs_up=0), dict(copies, rating=4, thumbs_up=1), dict(copies, review_text=None), dict(copies, review_text="other"),
        dict(copies, review_text="other"), dict(review_id=None),
    ))
    assert tuple(dedup_counts(raw).first()) == counted(raw)
    assert tuple(dedup_counts(raw.limit(0)).first()) == (0, 0, 0)


def test_a_failed_report_is_no_result(model, monkeypatch):
    from checks import registry
    from checks.workspace import Workspace

    cleaned, star, stage = model
    workspace = Workspace(stage, cleaned)
    workspace.__dict__["star"] = star

    def broken(star, stage):
        raise ValueError("no")

    monkeypatch.setitem(REPORTS, "q7_reply_split", broken)
    with pytest.raises(RuntimeError, match="q7_reply_split: ValueError: no"):
        registry._report_files(workspace)
    monkeypatch.undo()
    assert {r["report"] for r in rows_of(registry._report_files(workspace))} == set(REPORTS)


def test_the_star_stores_no_text(spark, model, reviews, tmp_path):
    from reviewmill import Stage
    from tests.test_cleaning import stored_columns

    cleaned, star, _ = model
    again = build_star(cleaned, Stage(spark, str(tmp_path)))
    assert not any("review_text" in columns for columns in stored_columns(tmp_path).values())
    assert again.fact_reviews.columns[:4] == ["review_id", "user_name", "rating", "review_text"]
    without = again.fact_reviews.drop("review_text")
    assert sorted(map(str, without.collect())) == sorted(map(str, again.facts.select(*without.columns).collect()))
    assert rows_of(again.fact_reviews.select("review_id", "review_text").orderBy("review_id")) == rows_of(cleaned.select("review_id", "review_text").orderBy("review_id"))
    assert list(tmp_path.glob("stage-*/fact_reviews-*/review_month=2026-01"))


def test_queries_of_no_text_store_none(spark, reviews, tmp_path):
    from checks.workspace import Workspace
    from reviewmill import Stage
    from tests.test_cleaning import stored_columns

    workspace = Workspace(Stage(spark, str(tmp_path)), reviews(*sample_rows()))
    assert workspace.cleaned.groupBy("issue_category").count().count() == workspace.star.facts.select("issue_key").distinct().count()
    assert not any("review_text" in columns for columns in stored_columns(tmp_path).values())
