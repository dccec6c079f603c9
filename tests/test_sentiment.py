from __future__ import annotations

import random
import string

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import sentiment as S


def scores(spark, texts, rules=S.RULES):
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = S.with_sentiment(docs, "id", "t", S.sample_lexicon(spark), rules).orderBy("id").collect()
    return [r["sentiment_score"] for r in rows]


def expected(text, rules=S.RULES, lexicon=None):
    """Brute force over one text, written as plain loops."""
    lexicon = lexicon or dict(S.SAMPLE_LEXICON)

    def bare(w):
        stripped = w.strip(string.punctuation)
        return w if len(stripped) <= 2 else stripped

    words = [bare(w) for w in text.split(" ")]
    def upper(w):
        return w.upper() == w and w.lower() != w
    mixed = 0 < sum(upper(w) for w in words) < len(words)
    low = [w.lower() for w in words]
    but = low.index("but") if "but" in low else None
    total = 0
    for i, word in enumerate(low):
        if word not in lexicon or word in S.STRENGTHENERS + S.WEAKENERS:
            continue
        v = lexicon[word]
        if "no" in rules:
            if word == "no" and low[i + 1 : i + 2] and low[i + 1] in lexicon:
                v = 0.0
            if "no" in low[max(0, i - 2) : i] or (i > 2 and low[i - 3] == "no" and low[i - 1] in ("or", "nor")):
                v = lexicon[word] * -0.74
        if "capitals" in rules and upper(words[i]) and mixed:
            v += 0.733 if v > 0 else -0.733
        for d, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < d or low[i - d] in lexicon:
                continue
            near = low[i - d]
            if "degree" in rules and near in S.STRENGTHENERS + S.WEAKENERS:
                push = 0.293 if near in S.STRENGTHENERS else -0.293
                push = -push if v < 0 else push
                if upper(words[i - d]) and mixed:
                    push += 0.733 if v > 0 else -0.733
                v += push * damping
            so = [w in ("so", "this") for w in low[i - d + 1 : i]]  # words between the neighbour and the hit
            if "never_so" in rules and d == 2 and near == "never" and so[0]:
                v *= 1.25
            elif "never_so" in rules and d == 3 and (near == "never" and so[0] or so[1]):
                v *= 1.25
            elif "without_doubt" in rules and d > 1 and near == "without" and "doubt" in low[i - d + 1 : i]:
                pass
            elif "negation" in rules and (near in S.NEGATIONS or "n't" in near):
                v *= -0.74
            if "phrases" in rules and d == 3:
                idioms = dict(S.IDIOMS)
                windows = [(1, 0), (2, 0), (2, 1), (3, 1), (3, 2)]
                joined = [" ".join(low[i - a : i - b + 1]) for a, b in windows]
                v = next((idioms[j] for j in joined if j in idioms), v)
                for n in (2, 3):
                    v = idioms.get(" ".join(low[i : i + n]), v) if i + n <= len(low) else v
                v -= 0.293 * sum(" ".join(low[i - a : i - b + 1]) in ("just enough", "kind of", "sort of") for a, b in ((3, 1), (3, 2), (2, 1)))
        if "phrases" in rules and word == "kind" and low[i + 1 : i + 2] == ["of"]:
            v = 0.0
        if "least" in rules and i and low[i - 1] == "least" and "least" not in lexicon and not (i > 1 and low[i - 2] in ("at", "very")):
            v *= -0.74
        if "but" in rules and but is not None:
            v *= 0.5 if i < but else 1.5 if i > but else 1
        total += v
    if "punctuation" in rules:
        asks = text.count("?")
        extra = min(text.count("!"), 4) * 0.292 + (0 if asks < 2 else asks * 0.18 if asks <= 3 else 0.96)
        total += extra if total > 1e-12 else -extra if total < -1e-12 else 0
    return total / (total * total + 15) ** 0.5


def test_known_values(spark):
    got = scores(spark, ["good", "not good", "very good", "good!", "nothing here", ""])
    assert got == [0.4404, -0.3412, 0.4927, 0.4926, 0.0, 0.0]


def test_emoticons_and_short_words(spark):
    got = scores(spark, ["fine :)", "(good)", ":(", "app(:)"])
    assert got[0] > scores(spark, ["fine"])[0]
    assert got[1] == 0.4404 and got[2] < 0 and got[3] == 0.0


def random_texts(n, seed=7):
    pick = random.Random(seed)
    words = ["good", "bad", "GREAT", "slow", "love", "not", "Never", "very", "VERY", "hardly", "but", "But,", "isn't", "no",
             "app", "update", "the", "I", "wow!", "why??", ":)", ":(", "--", "don't", "(nice)", "so", "pretty", "fine.", "été"]
    return [" ".join(pick.choice(words) for _ in range(pick.randint(1, 14))) for _ in range(n)]


MORE_TERMS = dict(S.SAMPLE_LEXICON) | {"no": -1.2, "kind": 2.4, "heart": 3.2, "death": -2.9, "die": -2.9, "shit": -2.6, "doubt": -1.5, "ass": -2.5, "so": 0.1}
PHRASE_WORDS = (
    "good bad great GREAT love no No nor or never Never so this without doubt least Least at very kind of sort just enough "
    "the shit bomb bad ass bus stop yeah right kiss of death to die for beating broken heart app the it, isn't"
).split()


@pytest.mark.parametrize("rules", [S.RULES, ("no",), ("least",), ("never_so",), ("without_doubt",), ("without_doubt", "negation"), ("never_so", "negation", "degree"), ("phrases",)])
@pytest.mark.parametrize("terms", [dict(S.SAMPLE_LEXICON), MORE_TERMS])
def test_phrase_rules_against_brute_force(spark, rules, terms):
    pick = random.Random(len(rules))
    texts = [" ".join(pick.choice(PHRASE_WORDS) for _ in range(pick.randint(1, 12))) for _ in range(250)]
    texts += ["it is to die for", "a broken heart", "what a kind of good app", "so very good", "app was never so good", "without doubt the best", "at least good", "no good", "x y z the bomb good"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    lexicon = spark.createDataFrame(list(terms.items()), "term string, valence double")
    inside = {r["id"]: r["sentiment_score"] for r in S.with_sentiment(docs, "id", "t", lexicon, rules).collect()}
    joined = {r["id"]: r["sentiment_score"] for r in S.with_all(docs, S.score_by_join(docs, "id", "t", lexicon, rules), "id").collect()}
    assert inside == joined
    for i, text in enumerate(texts):
        assert inside[i] == pytest.approx(expected(text, rules, terms), abs=1e-4), text


@pytest.mark.parametrize("rules", [S.RULES, (), ("capitals",), ("degree", "negation"), ("but",), ("punctuation",)])
def test_against_brute_force(spark, rules):
    texts = random_texts(150)
    for text, got in zip(texts, scores(spark, texts, rules)):
        assert got == pytest.approx(expected(text, rules), abs=1e-4), text


def test_both_plans_agree(spark):
    docs = spark.createDataFrame(list(enumerate(random_texts(200, seed=11))), "id int, t string")
    lexicon = S.sample_lexicon(spark)
    inside = S.score_in_place(docs, "t", S.short_lexicon(lexicon), inert=S.modifiers_in(lexicon)).select("id", "sentiment_score")
    joined = docs.join(S.score_by_join(docs, "id", "t", lexicon), "id", "left").select(
        "id", F.coalesce("sentiment_score", F.lit(0.0)).alias("sentiment_score")
    )
    assert inside.exceptAll(joined).count() == 0 and joined.exceptAll(inside).count() == 0


def test_long_lexicon_uses_the_join(spark, monkeypatch):
    monkeypatch.setattr(S, "IN_PLACE_TERMS", 3)
    docs = spark.createDataFrame([(1, "not good"), (2, "plain")], "id int, t string")
    rows = S.with_sentiment(docs, "id", "t", S.sample_lexicon(spark)).orderBy("id").collect()
    assert [r["sentiment_score"] for r in rows] == [-0.3412, 0.0]


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("good\t1.9\t0.9\t[2, 2]\nbad\t-2.5\t0.6\t[-3]\n\n")
    assert {tuple(r)[:2] for r in S.read_lexicon(spark, str(path)).collect()} == {("good", 1.9), ("bad", -2.5)}


def test_the_last_line_of_a_repeated_term_counts(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("good\t1.9\nbad\t-2.5\ngood\t1.5\n")
    assert {tuple(r) for r in S.settled(S.read_lexicon(spark, str(path))).collect()} == {("good", 1.5), ("bad", -2.5)}


def test_repeated_terms_score_alike_in_both_plans(spark):
    lexicon = spark.createDataFrame([("good", 1.9), ("good", 1.5), ("bad", -2.5), ("bad", -2.5)], "term string, valence double")
    docs = spark.createDataFrame([(1, "good"), (2, "bad")], "id int, t string")
    inside = {r["id"]: r["sentiment_score"] for r in S.with_sentiment(docs, "id", "t", lexicon).collect()}
    joined = {r["id"]: r["sentiment_score"] for r in S.score_by_join(docs, "id", "t", lexicon).collect()}
    assert inside == joined == {1: 0.4404, 2: -0.5423}


def test_one_long_word_in_capitals_takes_no_time(spark):
    import time

    text = "A" * 100_000 + "b good"
    scores(spark, ["warm up GOOD day"])
    start = time.perf_counter()
    assert scores(spark, [text]) == [0.4404]
    assert time.perf_counter() - start < 5  # quadratic matching took minutes


def test_a_large_lexicon_is_planned_quickly(spark):
    import time

    terms = {float(v): [f"it's\\{v}w{i}" for i in range(107)] for v in range(70)}
    docs = spark.createDataFrame([(1, "it's\\3w5"), (2, "none")], "id int, t string")
    start = time.perf_counter()
    scored = S.score_in_place(docs, "t", terms)
    assert time.perf_counter() - start < 2
    assert {r["id"]: r["sentiment_score"] > 0 for r in scored.collect()} == {1: True, 2: False}
