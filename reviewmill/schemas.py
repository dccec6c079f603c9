"""Table contracts: raw reviews, cleaned reviews and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T


RAW_REVIEWS = T.StructType(
    [
        T.StructField("app_id", T.StringType()),
        T.StructField("app_name", T.StringType()),
        T.StructField("review_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("rating", T.IntegerType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("thumbs_up", T.LongType()),
        T.StructField("app_version", T.StringType()),
        T.StructField("review_date", T.TimestampNTZType()),
        T.StructField("reply_text", T.StringType()),
    ]
)

# Where a row came from; sorts like the order of rows in the files.
INGEST_ORDER = ("_file", "_block", "_row")

# Null in CSV files, so that it differs from empty text.
NULL_MARK = "\\N"

# Two rows with equal values here (null = null) are the same review.
DEDUP_KEYS = ("app_id", "review_id", "user_name", "review_text", "review_date")

# Identity columns that are long: read only where the others meet again.
LONG_KEYS = ("review_text",)

# How tables of texts are written: a quarter less than the default.
TEXT_COMPRESSION = "zstd"

FEATURE_COLUMNS = (
    "has_developer_reply",
    "review_year",
    "review_month",
    "review_week",
    "review_quarter",
    "review_length",
    "word_count",
    "sentiment_score",
    "sentiment_label",
    "issue_category",
)
RELEASE_COLUMNS = (
    "version_release_date",
    "days_since_version_release",
    "is_post_release_window",
)
CLEANED_COLUMNS = tuple(RAW_REVIEWS.names) + FEATURE_COLUMNS + RELEASE_COLUMNS

# Columns of the fact and of the detail sheet.
FACT_COLUMNS = (
    "review_id",
    "user_name",
    "rating",
    "review_text",
    "review_length",
    "word_count",
    "sentiment_score",
    "sentiment_label",
    "thumbs_up",
    "has_developer_reply",
    "is_post_release_window",
    "days_since_version_release",
    "app_key",
    "version_key",
    "issue_key",
    "date_key",
    "review_date",
)

DETAIL_COLUMNS = (
    "app_id",
    "app_name",
    "review_id",
    "user_name",
    "rating",
    "review_text",
    "app_version",
    "review_date",
    "review_month",
    "sentiment_score",
    "sentiment_label",
    "issue_category",
    "thumbs_up",
    "has_developer_reply",
    "is_post_release_window",
)

STAR_TABLES = ("fact_reviews", "dim_app", "dim_app_version", "dim_date", "dim_issue_category")

# Issue dimension, in key order (fixed values).
ISSUE_DIMENSION = (
    (1, "crash", "App crashes, freezes, or force closes"),
    (2, "login", "Login, authentication, OTP, or session issues"),
    (3, "payment", "Payment, transfer, or transaction failures"),
    (4, "ui", "UI/redesign/navigation complaints"),
    (5, "performance", "Speed, lag, loading, or battery complaints"),
    (6, "none", "No specific product issue mentioned"),
)
