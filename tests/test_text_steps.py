"""Text steps over Arrow batches against plain Python."""

from __future__ import annotations

import random

import pytest

from reviewmill.functions import batches as B
from reviewmill.operators import keywords as KW
from reviewmill.operators import sentiment as S

ODD = ["good", "GOOD", "bad!", "(great)", "but", "BUT,", "butter", "a", "", "not", ":)", "good:)", "İ", "\x01", "worst", "it's", "ΑΣ", "kind", "of"]
TEXTS = [None, "", " "] + [" ".join(random.Random(i).choices(ODD, k=i % 13)) for i in range(400)]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")


def test_only_terms_leave_a_text_for_a_short_lexicon(spark, docs, monkeypatch):
    asked = []
    monkeypatch.setattr(S, "word_places", lambda marks, wanted: asked.append(wanted) or B.word_places(marks, wanted))
    terms = {t: v for t, v in S.SAMPLE_LEXICON}
    lexicon = spark.createDataFrame(list(terms.items()), "term string, valence double")
    joined = {r["id"]: r["sentiment_score"] for r in S.with_all(docs, S.score_by_join(docs, "id", "t", lexicon), "id").collect()}
    inside = {r["id"]: r["sentiment_score"] for r in S.with_sentiment(docs, "id", "t", lexicon).collect()}
    assert asked == [{t for t in terms if t not in S.STRENGTHENERS + S.WEAKENERS}]
    assert joined == inside and len({*joined.values()}) > 20
    beyond = S.with_all(docs, S.score_by_join(docs, "id", "t", lexicon, limit_bytes=0), "id")
    assert asked[-1] is None and {r["id"]: r["sentiment_score"] for r in beyond.collect()} == joined


def test_words_have_their_places(docs):
    rows = docs.select("t", B.word_places(S.PUNCTUATION)("t").alias("words")).collect()
    for r in rows:
        words = [] if r["t"] is None else r["t"].split(" ")
        bare = [w if len(w.strip(S.PUNCTUATION)) <= 2 else w.strip(S.PUNCTUATION) for w in words]
        assert [(w["at"], w["term"]) for w in r["words"] or []] == [(i, w.lower()) for i, w in enumerate(bare)]


def test_a_short_keyword_table_needs_no_grams(spark, docs, stage, monkeypatch):
    def refused(*_):
        raise AssertionError("grams of every text")

    monkeypatch.setattr(KW, "filed_in_task", refused)
    rows = [("good", "b", 1), ("ba", "a", 1), ("kind of", "c", 0), (".", "d", 2), ("it's", "d", 2), ("worst", "a", 3)]
    found = KW.tag_by_keywords(docs, "id", "t", spark.createDataFrame(rows, "keyword string, category string, place int"), stage=stage)
    for id_, category in found.collect():
        fits = [(place, name) for word, name, place in rows if TEXTS[id_] is not None and word in TEXTS[id_]]
        assert category == (min(fits)[1] if fits else "none")


def test_lower_case_as_in_python(docs):
    import pyarrow as pa

    texts = ["İSTANBUL", "ΑΣ ΣΑ", "ÄÖÜ “X”", "ẞ", "Ω K", None, "漢字 A", "ДА", "Ⅷ Ⓐ"]
    assert B.in_lower_case(pa.array(texts)).to_pylist() == [t and t.lower() for t in texts]


def test_texts_without_keywords_are_read_once(monkeypatch):
    import pyarrow as pa

    read = []
    match = B.pc.match_substring_regex
    monkeypatch.setattr(B.pc, "match_substring_regex", lambda texts, *a, **k: read.append(len(texts)) or match(texts, *a, **k))
    tagged = B._categories(pa.array(["x"] * 99 + ["slow", None]), [("a", ("crash",)), ("b", ("login",)), ("c", ("slow",))])
    assert tagged.to_pylist() == ["none"] * 99 + ["c", "none"]
    assert sum(read) == 101 + 3


def test_written_tables_are_compared_without_moving_texts(spark):
    from checks.registry import _compared

    kind = "review_text string, n int, x double"
    back = spark.createDataFrame([("a", 1, 0.0), ("a", 1, -0.0), (None, None, None), ("b", 2, 1.5), ("12:", 1, None)], kind)
    source = spark.createDataFrame([("a", 1, 0.0), (None, None, None), ("b", 2, 1.25), ("c", None, 2.0)], kind)
    compared = _compared("t", "name", back, source)
    differing = back.exceptAll(source).count() + source.exceptAll(back).count()
    assert [tuple(r) for r in compared.collect()] == [("t", 5, differing)]
    plan = compared._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert moved and not any("review_text" in line for line in moved)
