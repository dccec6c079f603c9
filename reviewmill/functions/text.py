"""Text normalisation and text-derived features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.functions.batches import collapse_blanks, first_category, words_and_category

# Issue categories in order of precedence, with their substrings.
# "ui " ends in a space and "load" also hits "download"; both are intended.
ISSUE_KEYWORDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("crash", ("crash", "force clos", "freeze", "froze", "not responding")),
    (
        "login",
        ("log in", "login", "log-in", "sign in", "otp", "password", "authentic", "face id",
         "fingerprint", "logged out"),
    ),
    (
        "payment",
        ("payment", "transfer", "transaction", "charged", "refund", "deduct", "pay bill", "money"),
    ),
    ("ui", ("interface", "redesign", "layout", "ui ", "navigat", "button", "design")),
    ("performance", ("slow", "lag", "battery", "load", "loading", "performance")),
)

# Cell texts that a CSV source treats as missing.
NA_VALUES: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def clean_text(text: Column) -> Column:
    """Collapse runs of Unicode white space to one blank and trim both ends."""
    return collapse_blanks()(text)


def text_length(text: Column) -> Column:
    """Length in code points."""
    return F.length(text)


def word_count(cleaned: Column) -> Column:
    """Number of blank-separated words of a cleaned text; 0 for an empty one."""
    blanks = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", F.lit(0)).otherwise(blanks + 1).cast("int")


def issue_category(
    lowered: Column,
    keywords: Sequence[tuple[str, Sequence[str]]] = ISSUE_KEYWORDS,
) -> Column:
    """First category, in the given order, with a keyword inside the lower-case text."""
    return first_category(least_keywords(keywords))(lowered)


def words_and_issue(cleaned: Column, keywords: Sequence[tuple[str, Sequence[str]]] = ISSUE_KEYWORDS) -> Column:
    """(words, category): ``word_count`` of a cleaned text and ``issue_category`` of its lower-case form, in one step."""
    return words_and_category(least_keywords(keywords))(cleaned)


def least_keywords(keywords: Sequence[tuple[str, Sequence[str]]]) -> list[tuple[str, list[str]]]:
    """``keywords`` without those that contain another one of their category and so can add nothing."""
    return [(category, [w for w in words if not any(o != w and o in w for o in words)]) for category, words in keywords]


def sentiment_label(score: Column, positive_from: float = 0.05, negative_to: float = -0.05) -> Column:
    return (
        F.when(score >= F.lit(positive_from), "positive")
        .when(score <= F.lit(negative_to), "negative")
        .otherwise("neutral")
    )


def missing_to_null(value: Column, na_values: Sequence[str] = NA_VALUES) -> Column:
    return F.when(~value.isin(*na_values), value)
