"""Tagging of texts from a table of keywords, of any number.

A CASE chain (``functions.text.issue_category``) looks for every keyword in every text, which serves dozens of
them. Here a keyword is filed under one of its q-grams, the one that the fewest texts hold, and a
text is compared only with the keywords whose gram it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.batches import PATTERN_CHARS, distinct_grams, first_filed, first_listed
from reviewmill.functions.text import ISSUE_KEYWORDS
from reviewmill.operators.joins import BROADCAST_BYTES, look_up, payload_bytes
from reviewmill.staging import Stage

GRAM = 3

# Up to this measured size a keyword table is given to every task.
IN_TASK_BYTES = 16 * 1024 * 1024

# Up to so many categories a table of few keywords is looked for by a pattern per category, beyond by grams.
PATTERN_LISTS = 16


def keyword_table(spark: SparkSession, keywords: Sequence[tuple[str, Sequence[str]]] = ISSUE_KEYWORDS) -> DataFrame:
    """(keyword, category, place) of a keyword list; ``place`` is the order of precedence."""
    rows = [(word, category, place) for place, (category, words) in enumerate(keywords) for word in words]
    return spark.createDataFrame(rows, "keyword string, category string, place int")


def grams_of(text: Column, sizes: Sequence[int]) -> Column:
    """The distinct grams of the given sizes. Time and memory in proportion to the text."""
    return distinct_grams(sizes)(text)


def filed_keywords(texts_grams: DataFrame, keywords: DataFrame, limit_bytes: int, stage: Stage) -> DataFrame:
    """(gram, keyword, category, place): every keyword under the gram that the fewest texts hold.

    ``texts_grams`` has a row per text and distinct gram. A keyword with a gram that no text holds is in no text
    and left out.
    """
    by_size = F.when(F.length("keyword") >= GRAM, grams_of(F.col("keyword"), [GRAM])).otherwise(F.array("keyword"))
    parts = stage.put(keywords.select("keyword", "category", "place", F.explode(by_size).alias("gram")), "keyword_grams")
    wanted = stage.put(parts.select("gram").distinct(), "wanted_grams")
    held = look_up(texts_grams, wanted, "gram", [c for c in texts_grams.columns if c != "gram"], "inner", limit_bytes, stage)
    counts = stage.put(held.groupBy("gram").agg(F.count(F.lit(1)).alias("texts")), "gram_counts")
    return (
        parts.join(counts, "gram", "left")
        .groupBy("keyword", "category", "place")
        .agg(F.min_by("gram", F.struct("texts", "gram")).alias("gram"), F.count_if(F.col("texts").isNull()).alias("absent"))
        .filter("absent = 0")
        .drop("absent")
    )


def filed_in_task(texts: DataFrame, text: str, keywords: DataFrame) -> dict[str, list[tuple[int, str, str]]]:
    """(place, category, keyword) under the gram that the fewest texts hold; for a table that was measured and found short.

    One pass over the texts counts the grams of keywords, and nothing else. A keyword with a gram that no text holds is left out.
    """
    rows = [(r["place"], r["category"], r["keyword"]) for r in keywords.collect()]
    grams = {word: [word] if len(word) < GRAM else [word[i : i + GRAM] for i in range(len(word) - GRAM + 1)] for _, _, word in rows}
    wanted = {gram for of_word in grams.values() for gram in of_word}
    held = texts.select(F.explode(distinct_grams([len(g) for g in wanted], wanted)(F.col(text))).alias("gram"))
    counts = {r["gram"]: r["texts"] for r in held.groupBy("gram").agg(F.count(F.lit(1)).alias("texts")).collect()}
    filed: dict[str, list[tuple[int, str, str]]] = {}
    for row in rows:
        if all(gram in counts for gram in grams[row[2]]):
            filed.setdefault(min(grams[row[2]], key=lambda g: (counts[g], g)), []).append(row)
    return filed


def listed_in_task(keywords: DataFrame) -> list[tuple[int, str, list[str]]] | None:
    """(place, category, keywords) in order, None for more than a pattern per category is good for. Reads a little more than that at most."""
    if keywords.select("place", "category").distinct().limit(PATTERN_LISTS + 1).count() > PATTERN_LISTS:
        return None
    if keywords.agg(F.sum(F.length("keyword")).alias("n")).first()["n"] > PATTERN_CHARS:
        return None
    lists: dict[tuple[int, str], list[str]] = {}
    for row in keywords.collect():
        lists.setdefault((row["place"], row["category"]), []).append(row["keyword"])
    return [(*first, sorted(lists[first])) for first in sorted(lists)]


def tag_by_keywords(
    docs: DataFrame,
    key: str,
    text: str,
    keywords: DataFrame,
    default: str = "none",
    limit_bytes: int = BROADCAST_BYTES,
    stage: Stage | None = None,
) -> DataFrame:
    """(key, issue_category): the first category, by ``place`` and then name, with a keyword inside the text.

    ``key`` must be unique and not null; ``keywords`` has keyword, category and place, and a null in any of them
    drops the row. An empty keyword is inside every text, a null text holds none and gets ``default``. Keywords are
    compared as they are, so lower-case both sides for a search that ignores case. A table within ``limit_bytes`` and
    ``IN_TASK_BYTES`` is given to every task, and no text is exchanged; a table of few short keywords reads the texts once. Beyond, texts are exchanged once, grams only
    where a keyword is filed under them.
    """
    stage = stage or Stage(docs.sparkSession)
    texts = docs.select(key, F.col(text).alias("_text"))
    keywords = stage.put(keywords.select("keyword", "category", "place").dropna().distinct(), "keywords")
    lengths = keywords.filter("keyword <> ''").select(F.least(F.length("keyword"), F.lit(GRAM)).alias("n")).distinct()
    sizes = sorted(r["n"] for r in lengths.collect())  # GRAM numbers at most
    always = keywords.filter("keyword = ''").agg(F.min(F.struct("place", "category")).alias("first")).first()["first"]
    first = F.lit(None).cast("struct<place:int,category:string>")
    if always:
        first = F.when(F.col("_text").isNotNull(), F.struct(F.lit(always["place"]).alias("place"), F.lit(always["category"]).alias("category")))
    if not sizes:
        return texts.select(key, F.coalesce(first["category"], F.lit(default)).alias("issue_category"))

    if payload_bytes(keywords) <= min(limit_bytes, IN_TASK_BYTES):
        given = keywords.filter("keyword <> ''")
        lists = listed_in_task(given)
        find = first_filed(filed_in_task(texts, "_text", given)) if lists is None else first_listed(lists)
        found = find(F.col("_text"))
        # As in a join, a null key finds nothing and rows of one key share what they find.
        return (
            texts.select(key, F.least(F.when(F.col(key).isNotNull(), found), first).alias("_first"))
            .groupBy(key)
            .agg(F.min("_first").alias("first"))
            .select(key, F.coalesce(F.col("first.category"), F.lit(default)).alias("issue_category"))
        )

    # The outer form: the plain one adds a filter on the size, which would build the grams a second time.
    grams = texts.select(key, F.explode_outer(grams_of(F.col("_text"), sizes)).alias("gram"))
    filed = stage.put(filed_keywords(grams, keywords.filter("keyword <> ''"), limit_bytes, stage), "filed_keywords")
    candidates = look_up(grams, filed, "gram", [key], "inner", limit_bytes, stage).drop("gram")
    found = F.when(F.contains("_text", "keyword"), F.struct("place", "category"))
    return (
        texts.join(candidates, key, "left")
        .groupBy(key)
        .agg(F.min(F.least(found, first)).alias("first"))
        .select(key, F.coalesce(F.col("first.category"), F.lit(default)).alias("issue_category"))
    )
