from __future__ import annotations

import pytest

from reviewmill.operators.dedup import keep_first
from reviewmill.sources import readers, writers


def test_csv_round_trip_keeps_quotes_lines_and_blanks(spark, reviews, tmp_path):
    texts = ['say "hi"', "two\nlines", "  padded ", "a,b", "back\\slash", None]
    raw = reviews(*[dict(review_text=t) for t in texts])
    writers.write_table(raw.coalesce(1), str(tmp_path / "raw"), "csv")
    back = readers.read_raw_reviews(spark, str(tmp_path / "raw"), keep_order=False)
    assert sorted(back.collect(), key=lambda r: r["review_id"]) == sorted(raw.collect(), key=lambda r: r["review_id"])


def test_missing_marks_become_null(spark, tmp_path):
    head = "app_id,app_name,review_id,user_name,rating,review_text,thumbs_up,app_version,review_date,reply_text\n"
    path = tmp_path / "raw.csv"
    path.write_text(head + "a,A,1,u,4.0,NA,3,nan,2026-01-02 03:04:05,\n" + "a,A,2,u,,fine,3,1.0,2026-01-02 03:04:05,None\n")
    rows = {r["review_id"]: r for r in readers.read_raw_reviews(spark, str(path)).collect()}
    assert rows["1"]["review_text"] is None and rows["1"]["rating"] == 4 and rows["1"]["app_version"] is None
    assert rows["2"]["rating"] is None and rows["2"]["reply_text"] is None


def test_first_copy_in_file_order(spark, tmp_path):
    head = "app_id,app_name,review_id,user_name,rating,review_text,thumbs_up,app_version,review_date,reply_text\n"
    line = "a,A,1,u,{r},text,{t},1.0,2026-01-02 03:04:05,\n"
    path = tmp_path / "raw.csv"
    path.write_text(head + line.format(r=5, t=9) + line.format(r=1, t=0))
    assert keep_first(readers.read_raw_reviews(spark, str(path))).first()["rating"] == 5


def test_missing_app_stops_the_run(spark, reviews):
    expected = spark.createDataFrame([("com.a",), ("com.z",)], "app_id string")
    with pytest.raises(RuntimeError, match="com.z"):
        readers.require_all_apps(expected, reviews({}))


def test_shape_batch(spark):
    rows = spark.createDataFrame([("x", 5, "hi", "2026-01-02 03:04:05")], "reviewId string, score int, content string, at string")
    fields = {"review_id": "reviewId", "rating": "score", "review_text": "content", "review_date": "at"}
    row = readers.shape_batch(rows, fields, "com.a", "A").first()
    assert (row["app_id"], row["review_id"], row["rating"], row["reply_text"]) == ("com.a", "x", 5, None)


def test_empty_text_and_null_differ_in_csv(spark, tmp_path):
    table = spark.createDataFrame([(1, "", None), (2, None, 0.5), (3, "x", -0.0), (4, '""', 1.0)], "id int, t string, d double")
    writers.write_table(table, str(tmp_path / "t"), "csv")
    back = readers.read_csv(spark, str(tmp_path / "t"), table.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_app_folders_are_one_scan(spark, reviews, tmp_path):
    raw = reviews(dict(app_name="A b"), dict(app_name="C"), dict(app_name="C"))
    raw.write.partitionBy("app_name").parquet(str(tmp_path / "batches"))
    back = readers.read_app_folders(spark, str(tmp_path / "batches"))
    assert back.exceptAll(raw).count() == raw.exceptAll(back).count() == 0


def test_no_negative_zero(spark):
    from pyspark.sql import functions as F

    from reviewmill.functions.numbers import round_half_away

    got = spark.range(1).select(round_half_away(F.lit(-0.001), 2).cast("string")).first()[0]
    assert got == "0.0"
