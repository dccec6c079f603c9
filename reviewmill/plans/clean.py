"""Raw reviews to cleaned, feature-rich reviews."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import dates as D
from reviewmill.functions.batches import text_facts
from reviewmill.functions import text as X
from reviewmill.operators.dedup import REVIEW_KEY, drop_unusable, keep_first
from reviewmill.operators.release import first_seen, with_release
from reviewmill.operators.sentiment import RULES, looked_up, modifiers_in, score_seen, short_lexicon, with_sentiment
from reviewmill.schemas import CLEANED_COLUMNS, TEXT_COMPRESSION
from reviewmill.staging import Stage


def reply_flag(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("has_developer_reply", F.col("reply_text").isNotNull().cast("int"))


def normalise_text(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("review_text", X.clean_text(F.col("review_text")))


def calendar_features(reviews: DataFrame) -> DataFrame:
    moment = F.col("review_date")
    return reviews.withColumns(
        {
            "review_year": F.year(D.day_of(moment)),
            "review_month": D.month_key(moment),
            "review_week": D.week_label(moment),
            "review_quarter": D.quarter_key(moment),
        }
    )


def text_features(reviews: DataFrame, keywords=X.ISSUE_KEYWORDS) -> DataFrame:
    """Length, word count and issue tag; the lower-case copy lives only inside this step."""
    text = F.col("review_text")
    return (
        reviews.withColumn("_facts", X.words_and_issue(text, keywords))
        .withColumns(
            {
                "review_length": X.text_length(text),
                "word_count": F.col("_facts.words"),
                "issue_category": F.col("_facts.category"),
            }
        )
        .drop("_facts")
    )


def label_sentiment(reviews: DataFrame, positive_from: float = 0.05, negative_to: float = -0.05) -> DataFrame:
    label = X.sentiment_label(F.col("sentiment_score"), positive_from, negative_to)
    return reviews.withColumn("sentiment_label", label)


def usable_reviews(raw: DataFrame, order_by: Sequence[str] | None = None, stage: Stage | None = None) -> DataFrame:
    """The first copies that have a text and a rating, with the features that do not come from the text."""
    first = keep_first(raw, order_by=order_by, stage=stage or Stage(raw.sparkSession))
    return first.transform(drop_unusable).transform(reply_flag)


def prepare_reviews(
    raw: DataFrame, order_by: Sequence[str] | None = None, keywords=X.ISSUE_KEYWORDS, stage: Stage | None = None
) -> DataFrame:
    """Dedup, null handling and row features. Without a ``stage`` of the caller's the step opens one of its own."""
    return (
        usable_reviews(raw, order_by, stage)
        .transform(normalise_text)
        .transform(calendar_features)
        .transform(text_features, keywords)
    )


def score_reviews(
    raw: DataFrame,
    lexicon: DataFrame,
    order_by: Sequence[str] | None = None,
    keywords=X.ISSUE_KEYWORDS,
    rules: Sequence[str] = RULES,
    stage: Stage | None = None,
) -> DataFrame:
    """Prepared reviews with sentiment. With a ``stage`` both are narrow steps over the raw rows.

    A lexicon that is looked up inside the row is looked up where the text is normalised, counted and tagged, so that a text goes
    to Python once.
    """
    terms = short_lexicon(lexicon)
    if terms is None:
        prepared = prepare_reviews(raw, order_by, keywords, stage)
        return with_sentiment(prepared, REVIEW_KEY, "review_text", lexicon, rules).transform(label_sentiment)
    inert = modifiers_in(lexicon)
    return (
        usable_reviews(raw, order_by, stage)
        .transform(calendar_features)
        .transform(read_texts, text_facts(X.least_keywords(keywords), *looked_up(terms, inert)))
        .transform(score_seen, rules, inert)
        .drop("_seen")
        .transform(label_sentiment)
    )


def read_texts(reviews: DataFrame, facts: Callable[[Column], Column]) -> DataFrame:
    """``normalise_text`` and ``text_features`` from ``text_facts``; what it saw of the lexicon stays in ``_seen``."""
    return (
        reviews.withColumn("_seen", facts(F.col("review_text")))
        .withColumn("review_text", F.coalesce("_seen.text", "review_text"))
        .withColumns(
            {
                "review_length": F.col("_seen.length"),
                "word_count": F.col("_seen.words"),
                "issue_category": F.col("_seen.category"),
            }
        )
    )


def clean_reviews(
    raw: DataFrame,
    lexicon: DataFrame,
    stage: Stage | None = None,
    order_by: Sequence[str] | None = None,
    keywords=X.ISSUE_KEYWORDS,
    rules: Sequence[str] = RULES,
    store: bool = True,
) -> DataFrame:
    """``reviews_cleaned``: one row per usable review.

    The release date of a version is its first review, so the reviews are needed twice. They
    are stored once in between; the result reads that table and attaches the three release columns,
    so there is no need to store it again.

    Without ``store`` no review is written, only where first copies stand and the release dates: the result cleans ``raw`` where it is
    read, each time, and works out no column that a reader does not ask for. That suits tables whose texts do not
    fit the disk a second time, and readers that ask for few columns once; a lexicon beyond ``short_lexicon`` is then joined on each reading.
    """
    stage = stage or Stage(raw.sparkSession)
    # The key of a review is not kept: it is taken of no row that does not need it.
    scored = score_reviews(raw, lexicon, order_by, keywords, rules, stage).drop(REVIEW_KEY)
    if store:
        scored = stage.put(scored, "scored_reviews", compression=TEXT_COMPRESSION)
    releases = stage.put(first_seen(scored), "releases")
    return with_release(scored, releases).select(*CLEANED_COLUMNS)
