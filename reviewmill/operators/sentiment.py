"""Lexicon sentiment over a whole corpus.

Two exact plans give the same scores:

* ``score_in_place`` - the lexicon is measured, found short and folded into the expression.
  Words are matched inside their row, only hits are looked at again, nothing is shuffled.
* ``score_by_join`` - for a lexicon of any size: explode the words, join, add up per document.

``with_sentiment`` picks by the measured size. The rules follow Hutto & Gilbert, "VADER: A Parsimonious Rule-based Model for Sentiment
Analysis of Social Media Text", ICWSM 2014. The lexicon is a table supplied by the user.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.batches import HIT, NEAR, lexicon_words, marks_of, word_places
from reviewmill.functions.numbers import round_half_away
from reviewmill.operators.joins import BROADCAST_BYTES, look_up, payload_bytes
from reviewmill.staging import Stage

# Fixed values of the published model.
NEGATION_FACTOR = -0.74
BOOST = 0.293
CAPS_BOOST = 0.733
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_LIMIT = 0.292, 4
QUESTION_STEP, QUESTION_MANY = 0.18, 0.96
NORMALISER = 15.0

# Words that negate what follows; any word holding "n't" negates as well.
NEGATIONS: tuple[str, ...] = (
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont", "hadnt",
    "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "neednt", "never", "none", "nope",
    "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "uhuh", "wasnt", "werent",
    "without", "wont", "wouldnt", "rarely", "seldom", "despite",
)

# Degree words that strengthen or weaken what follows.
STRENGTHENERS: tuple[str, ...] = (
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably",
    "decidedly", "deeply", "effing", "enormous", "enormously", "entirely", "especially",
    "exceptional", "exceptionally", "extreme", "extremely", "fabulously", "flipping", "flippin",
    "frackin", "fracking", "fricking", "frickin", "frigging", "friggin", "fully", "fuckin",
    "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely", "incredible",
    "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally",
    "tremendous", "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
)
WEAKENERS: tuple[str, ...] = (
    "almost", "barely", "hardly", "kinda", "kindof", "kind-of", "less", "little", "marginal",
    "marginally", "occasional", "occasionally", "partly", "scarce", "scarcely", "slight",
    "slightly", "somewhat", "sorta", "sortof", "sort-of",
)

# Phrases with a valence of their own, once a word of theirs is a lexicon term.
IDIOMS: tuple[tuple[str, float], ...] = (
    ("the shit", 3.0), ("the bomb", 3.0), ("bad ass", 1.5), ("bus stop", 0.0), ("yeah right", -2.0),
    ("kiss of death", -1.5), ("to die for", 3.0), ("beating heart", 3.1), ("broken heart", -2.9),
)

# Weakening phrases; "never" before one of EMPHATIC strengthens by NEVER_SO.
WEAK_PHRASES: tuple[str, ...] = ("just enough", "kind of", "sort of")
EMPHATIC: tuple[str, ...] = ("so", "this")
NEVER_SO = 1.25

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# A word is in capitals when it has an upper-case and no lower-case letter. The first pattern
# finds such a word in a blank-separated text, the second one any other word.
CAPS_WORD = r"(^| )[^\p{Ll}\p{Lu} ]*\p{Lu}[^\p{Ll} ]*( |$)"
PLAIN_WORD = r"\p{Ll}|(^| )[^\p{Lu} ]+( |$)"

# Splitting a text padded with blanks on a blank and the punctuation around it gives an empty
# part, then one part per word without its outer punctuation, then another empty part.
LOOSE_BLANK = r"\p{Punct}* \p{Punct}*"

LOOK_BACK = 3
Hit = Callable[[str], Column]
UNITS = 1e9

# Up to these sizes the lexicon is folded into the expression; beyond them it is joined.
IN_PLACE_TERMS = 50_000
IN_PLACE_VALENCES = 500

# Up to this measured size the terms of a lexicon are given to every task, and only words that are terms meet the lexicon.
IN_TASK_BYTES = 16 * 1024 * 1024


# A small lexicon for tests and demonstrations: everyday terms with the valences of the public
# VADER lexicon (MIT licence). Fixed values.
SAMPLE_LEXICON: tuple[tuple[str, float], ...] = (
    ("amazing", 2.8), ("annoying", -1.7), ("awesome", 3.1), ("awful", -2.0), ("bad", -2.5),
    ("best", 3.2), ("boring", -1.3), ("broken", -2.1), ("bug", -1.2), ("confusing", -0.9),
    ("crash", -1.7), ("crashes", -1.6), ("disappointing", -2.2), ("easy", 1.9), ("enjoy", 2.2),
    ("error", -1.7), ("excellent", 2.7), ("fail", -2.5), ("fails", -1.8), ("fantastic", 2.6),
    ("fine", 0.8), ("fraud", -2.8), ("free", 2.3), ("frustrating", -1.9), ("fun", 2.3),
    ("glitchy", -1.4), ("good", 1.9), ("great", 3.1), ("happy", 2.7), ("hate", -2.7),
    ("help", 1.7), ("helpful", 1.8), ("horrible", -2.5), ("issue", -0.8), ("like", 1.5),
    ("love", 3.2), ("lovely", 2.8), ("nice", 1.8), ("perfect", 2.7), ("poor", -2.1),
    ("pretty", 2.2), ("problem", -1.7), ("recommend", 1.5), ("refund", -0.6), ("sad", -2.1),
    ("scam", -2.7), ("slow", -1.1), ("smooth", 0.9), ("stupid", -2.4), ("terrible", -2.1),
    ("thanks", 1.9), ("useless", -1.8), ("waste", -1.8), ("wonderful", 2.7), ("worse", -2.1),
    ("worst", -3.1), ("wow", 2.8), ("wrong", -2.1), (":)", 2.0), (":(", -1.9),
)


def sample_lexicon(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(v).alias("valence")) for t, v in SAMPLE_LEXICON])
    return spark.range(1).select(F.inline(rows))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated lexicon file: term, mean valence, then columns that are ignored.

    ``line`` is the place in the file; of repeated terms the last line counts.
    """
    lines = spark.read.schema("line string").text(path)
    parts = F.split("line", "\t")
    terms = lines.select(
        F.get(parts, 0).alias("term"), F.get(parts, 1).try_cast("double").alias("valence"), F.monotonically_increasing_id().alias("line")
    )
    return terms.filter("term is not null and valence is not null")


def settled(lexicon: DataFrame) -> DataFrame:
    """(term, valence), one row per term: the last ``line``, or the largest valence where there are none."""
    place = F.struct("line", "valence") if "line" in lexicon.columns else F.col("valence")
    return lexicon.groupBy("term").agg(F.max_by("valence", place).alias("valence"))


def bare_word(token: Column) -> Column:
    """Token without surrounding punctuation, unless at most two characters would be left.

    So emoticons stay. For single words; ``bare_words`` handles a whole text faster.
    """
    stripped = F.btrim(token, F.lit(PUNCTUATION))
    return F.when(F.length(stripped) <= 2, token).otherwise(stripped)


def bare_words(text: Column) -> Column:
    """Words without any outer punctuation; word i is element i + 1 of the array."""
    return F.split(F.concat(F.lit(" "), text, F.lit(" ")), LOOSE_BLANK)


def is_capitals(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def mixes_capitals(text: Column) -> Column:
    """Some but not all words of the text are in capitals."""
    return text.rlike(CAPS_WORD) & text.rlike(PLAIN_WORD)


def says_capitals(hit: Hit) -> Column:
    """A hit or a word before it is in capitals; only then it matters whether the text mixes them."""
    return reduce(Column.__or__, [is_capitals(hit(word)) for word in ("bare", "back1", "back2", "back3")])


def punctuation_emphasis(text: Column) -> Column:
    def occurrences(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    return emphasis_of(occurrences("!"), occurrences("?"))


def emphasis_of(bangs: Column, marks: Column) -> Column:
    """What so many exclamation and question marks add to a text."""
    asks = (
        F.when(marks <= 1, F.lit(0.0))
        .when(marks <= 3, marks * F.lit(QUESTION_STEP))
        .otherwise(F.lit(QUESTION_MANY))
    )
    return F.least(bangs, F.lit(EXCLAMATION_LIMIT)) * F.lit(EXCLAMATION_STEP) + asks


def but_position(lower_bare_words: Column) -> Column:
    """Zero-based index of the first word "but"; null when there is none."""
    place = F.array_position(lower_bare_words, "but")
    return F.when(place > 0, (place - 2).cast("int"))


# --- rules -------------------------------------------------------------------------------------

RULES = ("capitals", "degree", "negation", "but", "punctuation", "no", "least", "never_so", "without_doubt", "phrases")


def _words_before(hit: Hit) -> list[Column]:
    """The three words before a hit in lower case, the nearest first."""
    return [hit(f"low_back{d}") for d in range(1, LOOK_BACK + 1)]


def in_lower_case(hit: Hit) -> dict[str, Column]:
    """The words of a hit in lower case, built once, as the rules ask for each of them many times."""
    return {f"low_{name}": F.lower(hit(name)) for name in NEAR}


def _factor(hit: Hit, distance: int, negating: Column, rules: Sequence[str], inert: Sequence[str]) -> Column:
    """What the word ``distance`` words before a hit multiplies its value by.

    "never so good" and "never this good" strengthen and "without doubt" is no negation. The published
    model tests the words next to a hit for "so" and "this" without asking for "never" when it looks three
    words back; scores are to agree with it, so this is kept.
    """
    back = _words_before(hit)
    factor = F.when(negating, NEGATION_FACTOR) if "negation" in rules else F.when(F.lit(False), 1.0)
    if "without_doubt" in rules and distance > 1 and "without" not in inert:
        doubt = back[0] == "doubt" if distance == 2 else (back[0] == "doubt") | (back[1] == "doubt")
        factor = F.when((back[distance - 1] == "without") & doubt, 1.0).otherwise(factor.otherwise(1.0))
    else:
        factor = factor.otherwise(1.0)
    if "never_so" in rules:
        never = F.lit("never" not in inert) & (back[distance - 1] == "never")
        if distance == 2:
            factor = F.when(never & back[0].isin(*EMPHATIC), NEVER_SO).otherwise(factor)
        if distance == 3:
            so = (never & back[1].isin(*EMPHATIC)) | (_far_enough(hit) & back[0].isin(*EMPHATIC))
            factor = F.when(so, NEVER_SO).otherwise(factor)
    return factor


def _far_enough(hit: Hit) -> Column:
    """The word three words before a hit exists and is no lexicon term."""
    return (hit("at") >= LOOK_BACK) & ~hit("known3")


def _neighbour(hit: Hit, distance: int, rules: Sequence[str], inert: Sequence[str]) -> Column:
    """What the word ``distance`` words before a hit does to it: push, loudness, damping, factor."""
    near, word = hit(f"back{distance}"), hit(f"low_back{distance}")
    strong = word.isin(*[w for w in STRENGTHENERS if w not in inert])
    weak = word.isin(*[w for w in WEAKENERS if w not in inert])
    negating = word.isin(*[w for w in NEGATIONS if w not in inert]) | F.contains(word, F.lit("n't"))
    push = F.when(strong, BOOST).when(weak, -BOOST).otherwise(0.0)
    loud = F.when((strong | weak) & is_capitals(near) & hit("mixed"), CAPS_BOOST).otherwise(0.0)
    return F.struct(
        (push if "degree" in rules else F.lit(0.0)).alias("push"),
        (loud if "degree" in rules else F.lit(0.0)).alias("loud"),
        F.lit(DISTANCE_DAMPING[distance - 1]).alias("damping"),
        _factor(hit, distance, negating, rules, inert).alias("factor"),
    )


def _pushed(value: Column, near: Column) -> Column:
    """A degree word works in the direction of the value so far; a negation turns and shrinks it."""
    push = F.when(value < 0, -near["push"]).otherwise(near["push"])
    loud = F.when(value > 0, near["loud"]).otherwise(-near["loud"])
    return (value + (push + loud) * near["damping"]) * near["factor"]


def _idiom(words: Sequence[Column]) -> Column:
    """Value of the idiom that ``words`` are, null if they are none."""
    listed = {phrase: worth for phrase, worth in IDIOMS if len(phrase.split()) == len(words)}
    table = ", ".join(f"{_quoted([phrase])}, {worth!r}D" for phrase, worth in listed.items())
    return F.element_at(F.expr(f"map({table})"), F.concat_ws(" ", *words))


def _with_phrases(hit: Hit, value: Column) -> Column:
    """Idioms around a hit replace its value, weakening phrases before it lower it.

    The first idiom in the order below counts: those that go on behind the hit, then those up to and before it. Looked for when the word three words before is no lexicon term.
    """
    b1, b2, b3 = _words_before(hit)
    word, n1, n2 = (hit(f"low_{name}") for name in ("bare", "next1", "next2"))
    windows = ((word, n1, n2), (word, n1), (b1, word), (b2, b1, word), (b2, b1), (b3, b2, b1), (b3, b2))
    idiom = F.coalesce(*[_idiom(words) for words in windows])
    weak = sum((F.when(F.concat_ws(" ", *words).isin(*WEAK_PHRASES), BOOST).otherwise(0.0) for words in ((b3, b2), (b2, b1))), F.lit(0.0))
    # ``value`` is a long expression, so it stands in the result once.
    changed = F.coalesce(F.when(_far_enough(hit), idiom), value) - F.when(_far_enough(hit), weak).otherwise(0.0)
    # "kind of" is a phrase and no kindness.
    return F.when((word == "kind") & (n1 == "of"), 0.0).otherwise(changed)


def hit_value(hit: Hit, rules: Sequence[str] = RULES, inert: Sequence[str] = ()) -> Column:
    """Valence of one lexicon hit in its context.

    ``hit`` gives the fields of a hit: at (word index), bare (the word), back1..back3 (the words
    before it), next1 and next2, all of these in lower case (``in_lower_case``), known3 (back3 is a lexicon term), next_known, value (lexicon valence), mixed
    and but_at (of its text). ``inert`` are modifier words that are lexicon terms too; those do not modify.
    """
    value = hit("value")
    back = _words_before(hit)
    if "no" in rules:
        no = (back[0] == "no") | (back[1] == "no") | ((back[2] == "no") & back[0].isin("or", "nor"))
        own = (hit("low_bare") == "no") & hit("next_known")
        value = value * F.when(no, NEGATION_FACTOR).when(own, 0.0).otherwise(1.0)
    if "capitals" in rules:
        loud = F.when(value > 0, value + CAPS_BOOST).otherwise(value - CAPS_BOOST)
        value = F.when(is_capitals(hit("bare")) & hit("mixed"), loud).otherwise(value)
    before = F.array(*[_neighbour(hit, d, rules, inert) for d in range(1, LOOK_BACK + 1)])
    value = F.aggregate(before, value, _pushed)
    if "phrases" in rules:
        value = _with_phrases(hit, value)
    if "least" in rules and "least" not in inert:
        least = (back[0] == "least") & ~back[1].isin("at", "very")
        value = value * F.when(least, NEGATION_FACTOR).otherwise(1.0)
    if "but" in rules:
        weight = F.when(hit("at") < hit("but_at"), BEFORE_BUT).when(hit("at") > hit("but_at"), AFTER_BUT)
        value = value * F.coalesce(weight, F.lit(1.0))
    return value


def _whole_units(value: Column) -> Column:
    """Whole billionths: they add up to the same total in any order."""
    return F.floor(value * F.lit(UNITS) + F.lit(0.5))


def compound(units: Column, emphasis: Column, rules: Sequence[str]) -> Column:
    """Total valence in billionths and punctuation emphasis to a score in [-1, 1]."""
    total = units / F.lit(UNITS)
    if "punctuation" in rules:
        total = F.when(total > 0, total + emphasis).when(total < 0, total - emphasis).otherwise(total)
    return round_half_away(total / F.sqrt(total * total + F.lit(NORMALISER)), 4)


def _neighbourhood(words: Column) -> Callable[[Column], Column]:
    """Word at a position with the words around it; empty strings beyond the first and the last word."""
    def look(at: Column) -> Column:
        def word(place: Column) -> Column:
            return F.coalesce(bare_word(F.get(words, place)), F.lit(""))

        backs = [word(at - d).alias(f"back{d}") for d in range(1, LOOK_BACK + 1)]
        nexts = [word(at + d).alias(f"next{d}") for d in (1, 2)]
        return F.struct(at.alias("at"), bare_word(F.get(words, at)).alias("bare"), *backs, *nexts)

    return look


def scoring_terms(lexicon: DataFrame) -> DataFrame:
    """Lexicon without degree words: those carry no valence of their own."""
    return lexicon.filter(~F.col("term").isin(*STRENGTHENERS, *WEAKENERS))


def modifiers_in(lexicon: DataFrame) -> list[str]:
    """Modifier words that are lexicon terms too. Bounded by the number of modifiers."""
    words = STRENGTHENERS + WEAKENERS + NEGATIONS + ("least",)
    found = lexicon.filter(F.col("term").isin(*words)).select("term").distinct()
    return sorted(r["term"] for r in found.collect())


def _quoted(words: Sequence[str]) -> str:
    """A list of texts as SQL literals."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


# --- plan 1: short lexicon, inside the row --------------------------------------------------------

def short_lexicon(lexicon: DataFrame) -> dict[float, list[str]] | None:
    """Terms by valence when the settled lexicon is within the in-place limits, else None."""
    lexicon = settled(lexicon)
    size = lexicon.agg(F.count("term").alias("terms"), F.countDistinct("valence").alias("valences")).first()
    if size["terms"] > IN_PLACE_TERMS or size["valences"] > IN_PLACE_VALENCES:
        return None
    grouped: dict[float, list[str]] = {}
    for row in scoring_terms(lexicon).orderBy("valence", "term").collect():
        grouped.setdefault(row["valence"], []).append(row["term"])
    return grouped


def score_in_place(
    docs: DataFrame,
    text: str,
    terms: dict[float, list[str]],
    rules: Sequence[str] = RULES,
    inert: Sequence[str] = (),
) -> DataFrame:
    """``docs`` plus ``sentiment_score``: hash look-ups per word, no shuffle, no second pass.

    The words of a text are looked up over Arrow batches; the rules are expressions on the few hits.
    """
    find = lexicon_words(*looked_up(terms, inert))
    return score_seen(docs.withColumn("_seen", find(F.col(text))), rules, inert).drop("_seen")


def looked_up(terms: dict[float, list[str]], inert: Sequence[str] = ()) -> tuple[dict[str, float], list[str], str, tuple[str, str]]:
    """What the words of a text are looked up with: the arguments of ``lexicon_words``."""
    values: dict[str, float] = {}
    for worth, names in terms.items():
        for term in names:
            values.setdefault(term, worth)
    # A lexicon term is known as such also when it is a degree word, which has no value of its own.
    return values, [*values, *inert], PUNCTUATION, (CAPS_WORD, PLAIN_WORD)


def score_seen(docs: DataFrame, rules: Sequence[str] = RULES, inert: Sequence[str] = ()) -> DataFrame:
    """``docs`` plus ``sentiment_score`` from ``_seen``, which has the fields of ``lexicon_words``."""
    def lowered(seen: Column) -> Column:
        words = [word.alias(name) for name, word in in_lower_case(lambda field: seen[field]).items()]
        return F.struct(*[seen[field.name].alias(field.name) for field in HIT], *words)

    def contribution(total: Column, seen: Column) -> Column:
        def hit(field: str) -> Column:
            return F.col(f"_seen.{field}") if field in ("mixed", "but_at") else seen[field]

        return total + _whole_units(hit_value(hit, rules, inert))

    return (
        docs.withColumn("_units", F.aggregate(F.transform("_seen.hits", lowered), F.lit(0).cast("bigint"), contribution))
        .withColumn("sentiment_score", compound(F.col("_units"), emphasis_of(F.col("_seen.bangs"), F.col("_seen.marks")), rules))
        .drop("_units")
    )


# --- plan 2: any lexicon, by join -----------------------------------------------------------------

def lexicon_hits(
    docs: DataFrame, key: str, text: str, lexicon: DataFrame, limit_bytes: int = BROADCAST_BYTES, stage: Stage | None = None
) -> DataFrame:
    """One row per word found in the lexicon, with the words around it and what the lexicon knows of them.

    Words travel through the look-up without their text; only words that may be terms are given their neighbours, so a
    long text costs time and memory in proportion to its length. What concerns a whole text is found once per text. The
    words of a short lexicon (``IN_TASK_BYTES``) are known where texts are split, and no other word is
    exploded. A lexicon of more than ``limit_bytes`` is
    not broadcast: words that it surely lacks stay where they are, frequent ones are spread.
    """
    stage = stage or Stage(docs.sparkSession)
    terms = stage.put(settled(lexicon), "lexicon")
    valued = scoring_terms(terms)
    in_task = payload_bytes(valued) <= min(limit_bytes, IN_TASK_BYTES)
    wanted = {r["term"] for r in valued.filter("term is not null").collect()} if in_task else None
    places, marks = word_places(PUNCTUATION, wanted), marks_of(PUNCTUATION, (CAPS_WORD, PLAIN_WORD))
    # Words of a short lexicon come with their neighbours, so their text stays behind.
    carried = [key, "_marks"] if in_task else [key, "_marks", "_text"]
    words = (
        docs.select(key, F.col(text).alias("_text"))
        .withColumns({"_places": places(F.col("_text")), "_marks": marks(F.col("_text"))})
        .select(*carried, F.explode("_places").alias("_place"))
        .select(*carried, "_place.*")
    )

    def with_neighbours(found: DataFrame) -> DataFrame:
        if not in_task:
            near = _neighbourhood(F.split("_text", " "))(F.col("at"))
            found = found.withColumn("_near", near).select(*[c for c in found.columns if c not in ("_text", "at")], "_near.*")
        marks = F.col("_marks")
        return found.withColumns(
            {"emphasis": emphasis_of(marks["bangs"], marks["marks"]), "mixed": marks["mixed"], "but_at": marks["but_at"]}
        ).drop("_marks")

    hits = look_up(words, valued, "term", [key, "at"], "inner", limit_bytes, stage, with_neighbours).withColumnRenamed("valence", "value")
    for field, word in (("known3", "back3"), ("next_known", "next1")):
        others = terms.select(F.col("term").alias("_word"), F.lit(True).alias(field))
        hits = look_up(hits.withColumn("_word", F.lower(word)), others, "_word", [key, "at"], "left", limit_bytes, stage).drop("_word")
    return hits.fillna(False, ["known3", "next_known"])


def score_by_join(
    docs: DataFrame,
    key: str,
    text: str,
    lexicon: DataFrame,
    rules: Sequence[str] = RULES,
    limit_bytes: int = BROADCAST_BYTES,
    stage: Stage | None = None,
) -> DataFrame:
    """(key, sentiment_score) for documents with hits; ``key`` must be unique per document."""
    hits = lexicon_hits(docs, key, text, lexicon, limit_bytes, stage)
    valued = hits.withColumns(in_lower_case(F.col)).select(
        key, "emphasis", _whole_units(hit_value(F.col, rules, modifiers_in(lexicon))).alias("units")
    )
    totals = valued.groupBy(key).agg(F.sum("units").alias("units"), F.max("emphasis").alias("emphasis"))
    score = compound(F.col("units"), F.col("emphasis"), rules)
    return totals.select(key, score.alias("sentiment_score"))


def with_all(docs: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """``docs`` with their scores, 0 where there is none."""
    return docs.join(scores, key, "left").withColumn("sentiment_score", F.coalesce(F.col("sentiment_score"), F.lit(0.0)))


def with_sentiment(
    docs: DataFrame, key: str, text: str, lexicon: DataFrame, rules: Sequence[str] = RULES
) -> DataFrame:
    """``docs`` plus ``sentiment_score``; documents without a hit score 0."""
    terms = short_lexicon(lexicon)
    if terms is not None:
        return score_in_place(docs, text, terms, rules, modifiers_in(lexicon))
    return with_all(docs, score_by_join(docs, key, text, lexicon, rules), key)
