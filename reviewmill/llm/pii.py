"""Personal data: base spans by pattern, further spans by what terms disclose about them.

After Sanchez & Batet, "C-sanitized: a privacy model for document redaction and sanitization", JASIST 2016:
a term discloses a protected entity as far as both occur together, measured as pointwise mutual
information; the entity's own information content is the most there is to disclose. Terms that
disclose more than a share of it are generalised or removed.

Everything is built-in functions. Patterns are written without nested repetition and tried only where
a match can begin, so a text costs time in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import WORD, once
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"

# What takes the place of a span.
MARKS = {"email": "<email>", "ip": "<ip>", "card": "<card>", "phone": "<phone>"}
NUMBER_MARK, NAME_MARK = "<number>", "<name>"


# --- base spans ---------------------------------------------------------------------------------------

def _email_text(text: Column) -> Column:
    """Dots that no domain label follows become underscores, which a local part may hold as well.

    Every dot left is followed by a label, so a domain is one run of letters, digits, - and dots.
    """
    return F.regexp_replace(text, r"\.(?![A-Za-z0-9-])", "_")


def _card_text(text: Column) -> Column:
    """Blanks and hyphens that are not between two digits become underscores.

    So a card number is one whole run of digits, blanks and hyphens.
    """
    return F.regexp_replace(text, r"[\x20-](?![0-9])|(?<![0-9])[\x20-]", "_")


# After a match, the next one may begin at once (\G), otherwise only where a run begins.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
VIEWS = {"email": _email_text, "ip": lambda t: t, "card": _card_text, "phone": lambda t: t}
# A text that does not match this has no span of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][0-9\x20-]{15}", "phone": r"\+[0-9]"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string is a multiple of ten."""
    marks = F.split(F.reverse(digits), "")
    twice = F.array(*[F.lit(2 * d - 9 if d > 4 else 2 * d) for d in range(10)])
    doubled = F.transform(
        marks, lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(F.element_at(twice, d.try_cast("int") + 1))
    )
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return ~F.exists(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) > 3) | (F.right(p, F.lit(3)).try_cast("int") > 255))
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _placed(text: Column, view: Column, pattern: str, kind: Column | str, keep) -> Column:
    """Spans of the matches that ``keep`` accepts, in order; positions are code points.

    The stretches between matches and the matches alternate, so their lengths add up to the
    positions. Only accepted matches are collected.
    """
    found = F.regexp_extract_all(view, F.lit(pattern), F.lit(0))
    gaps = F.split(view, pattern, -1)
    label = F.lit(kind) if isinstance(kind, str) else kind
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        value = F.substring(text, begin + 1, F.length(pair["hit"]))
        span = F.struct(label.alias("kind"), begin.alias("start"), end.alias("end"), value.alias("value"))
        spans = F.when(keep(pair["hit"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.when(F.size(found) > 0, F.aggregate(pairs, start, step)["spans"]).otherwise(F.array().cast(SPANS))


def base_spans(text: Column, kind: str) -> Column:
    view = VIEWS[kind](text)
    spans = _placed(text, view, PATTERNS[kind], kind, lambda hit: is_valid(kind, hit))
    return F.when(text.rlike(HINTS[kind]), spans).otherwise(F.array().cast(SPANS))


def all_base_spans(text: Column) -> Column:
    """Base spans of all kinds, by kind; looked for once per text, however often they are used."""
    return once(F.concat(*[base_spans(text, kind) for kind in KINDS]))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def body_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def base_table(docs: DataFrame) -> DataFrame:
    """(doc_id, copy, email, ip, card, phone, words): the base spans of every row of ``docs``.

    ``copy`` is a hash of the text; ``words`` are the words outside the spans of a text that has any; null
    texts are empty.
    """
    body = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body_of(docs).alias("body"))
    found = body.select("doc_id", "body", all_base_spans(F.col("body")).alias("base"))
    apart = filled(F.col("body"), F.transform("base", lambda s: F.struct(s["start"], s["end"], F.lit(" ").alias("mark"))))
    words = F.when(F.size("base") > 0, F.array_intersect(plain_words(apart), plain_words(F.col("body"))))
    by_kind = [_of_kind(F.col("base"), kind).alias(kind) for kind in KINDS]
    return found.select("doc_id", F.xxhash64("body").alias("copy"), *by_kind, words.alias("words"))


# --- disclosure -----------------------------------------------------------------------------------------

def plain_words(text: Column) -> Column:
    """Distinct lower-case words without outer punctuation; a word begins at a letter or digit, so runs of marks are passed once."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}](?:[^\x20\x09-\x0D]*[\p{L}\p{N}])?"), F.lit(0)))


def _bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[^\p{L}\p{N}]++|(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")


def _entity(span: Column) -> Column:
    """Kind and value of a span; numbers are the same however they are grouped."""
    value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat_ws(":", span["kind"], value)


def _levels(span: Column) -> Column:
    """The entity of a span and the wider ones it belongs to, which recur where the value itself does not.

    An email's domain, an ip's first two parts, the first six digits of a card, the first four of a phone, and
    last the kind alone.
    """
    value, digits = F.lower(span["value"]), _digits(span["value"])
    part = (
        F.when(span["kind"] == "email", F.regexp_extract(value, "@(.*)$", 1))
        .when(span["kind"] == "ip", F.substring_index(value, ".", 2))
        .when(span["kind"] == "card", F.left(digits, F.lit(6)))
        .otherwise(F.left(digits, F.lit(4)))
    )
    return F.array(_entity(span), F.concat_ws(":", span["kind"], F.lit("part"), part), span["kind"])


def _evidence(words: Column) -> Column:
    """Least hash of three neighbouring words: the same for texts that differ outside their spans in nothing, and mostly for near copies."""
    neighbours = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.coalesce(F.array_min(neighbours), F.lit(0).cast("bigint"))


def entity_terms(bases: DataFrame) -> DataFrame:
    """(doc_id, evidence, entities, words): per row that holds base spans, its entities at all levels and its words."""
    spans = F.concat(*[F.col(k) for k in KINDS])
    held = bases.filter("doc_id is not null and words is not null")
    return held.select("doc_id", _evidence(F.col("words")).alias("evidence"), F.array_distinct(F.flatten(F.transform(spans, _levels))).alias("entities"), "words")


def disclosing_terms(docs: DataFrame, bases: DataFrame, stage: Stage, least: int = 3, share: float = 0.9) -> DataFrame:
    """(doc_id, terms): per document, the terms that disclose an entity the document holds.

    An entity is a value with its kind or, as most values stand in one document only, a wider level of it: a
    mail domain, a network, the first digits, the kind. With N rows, of which n_e hold the entity, n_t
    the term and n_et both, a term discloses log(N n_et / (n_e n_t)) of the log(N / n_e) there is to
    disclose; it counts from ``share`` of that on. Every entity is looked at. An estimate needs ``least``
    rows with both that are no copies of each other, so a copied text proves as much as one. The counts cover all
    rows. Words
    count where they stand outside base spans, whether or not they are part of an entity's value.
    """
    told = entity_terms(bases)
    rows = told.select("evidence", "words", F.explode("entities").alias("entity"))
    holding = stage.put(rows.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).filter(F.col("n_e") >= least), "entities")
    pairs = (
        rows.join(broadcast_if_small(holding.select("entity")), "entity").select("entity", "evidence", F.explode("words").alias("term"))
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_et"), F.count_distinct("evidence").alias("apart"))
        .filter(F.col("apart") >= least)
    )
    pairs = stage.put(pairs.join(broadcast_if_small(holding), "entity").select("entity", "n_e", "term", "n_et"), "pairs")
    wanted = broadcast_if_small(stage.put(pairs.select("term").distinct(), "terms"))
    words = docs.select(F.explode(plain_words(body_of(docs))).alias("term"))
    spread = words.join(wanted, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = F.lit(float(max(bases.count(), 1)))
    most = F.log(total / F.col("n_e"))
    disclosed = F.log(total * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    known = stage.put(pairs.join(spread, "term").filter((most > 0) & (disclosed >= share * most)).select("entity", "term"), "disclosing")
    useful = broadcast_if_small(stage.put(known.select("entity").distinct(), "disclosed"))
    by_entity = told.select("doc_id", "words", F.explode("entities").alias("entity")).join(useful, "entity")
    by_term = by_entity.select("doc_id", "entity", F.explode("words").alias("term")).join(broadcast_if_small(known), ["entity", "term"])
    return stage.put(by_term.groupBy("doc_id").agg(F.collect_set("term").alias("terms")), "document_terms")


def term_spans(text: Column, terms: Column, base: Column) -> Column:
    """Words of ``text`` whose bare form is in ``terms`` and that touch no base span."""
    found = _placed(text, text, WORD, "term", lambda hit: F.array_contains(terms, _bare(hit)))
    apart = F.filter(found, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.when(F.size(F.coalesce(terms, F.array().cast("array<string>"))) > 0, apart).otherwise(F.array().cast(SPANS))


def personal_spans(docs: DataFrame, stage: Stage, least: int = 3, share: float = 0.9) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms), a row per row of ``docs``.

    Base spans come by kind, then start; the spans of disclosing terms follow as kind "term". Null
    texts are empty. Entities and terms are counted by row; a doc_id that repeats has the terms of all its
    rows, and rows with a null doc_id have base spans only. Other columns are ignored.
    """
    bases = stage.put(base_table(docs), "base_spans")
    terms = disclosing_terms(docs, bases, stage, least, share)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body_of(docs).alias("body"))
    marked = texts.join(broadcast_if_small(terms), "doc_id").select("doc_id", "body", "terms", all_base_spans(F.col("body")).alias("base"))
    extra = marked.select("doc_id", F.xxhash64("body").alias("copy"), term_spans(F.col("body"), F.col("terms"), F.col("base")).alias("extra"))
    extra = stage.put(extra.filter(F.size("extra") > 0).dropDuplicates(["doc_id", "copy"]), "term_spans")
    every = bases.join(broadcast_if_small(extra), ["doc_id", "copy"], "left")
    base, more = F.concat(*[F.col(k) for k in KINDS]), F.coalesce("extra", F.array().cast(SPANS))
    return every.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat(base, more)).alias("spans"),
        F.size(more).cast("bigint").alias("n_terms"),
    )


# --- sanitising -------------------------------------------------------------------------------------------

def filled(text: Column, marked: Column) -> Column:
    """``text`` with the stretches of ``marked`` (start, end, mark) replaced by their marks; of overlapping ones the first counts."""
    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], before, span["mark"])).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        F.array_sort(marked), start, step,
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text) - state["at"])),
    )


def mask(text: Column, spans: Column) -> Column:
    """``text`` with every span generalised to its class or, for a plain term, removed."""
    def mark(span: Column) -> Column:
        general = F.when(span["value"].rlike("[0-9]"), NUMBER_MARK).when(span["value"].rlike(r"^[^\p{L}]*\p{Lu}"), NAME_MARK).otherwise("")
        for kind in KINDS:
            general = F.when(span["kind"] == kind, MARKS[kind]).otherwise(general)
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), general.alias("mark"))

    return F.when(F.size(spans) > 0, filled(text, F.transform(spans, mark))).otherwise(text)


def sanitise(docs: DataFrame, stage: Stage, least: int = 3, share: float = 0.9) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` set to the new length.

    Null texts stay null. Columns keep their names and order; ``n_chars`` is only set where it is there.
    """
    bases = stage.put(base_table(docs), "base_spans")
    terms = disclosing_terms(docs, bases, stage, least, share).select(F.col("doc_id").alias("_doc"), F.col("terms").alias("_terms"))
    joined_docs = docs.join(broadcast_if_small(terms), docs["doc_id"].cast("bigint") == F.col("_doc"), "left")
    found = joined_docs.withColumn("_base", all_base_spans(F.col("text")))
    every = F.concat("_base", term_spans(F.col("text"), F.col("_terms"), F.col("_base")))
    spanned = found.withColumn("_spans", once(every))
    masked = spanned.withColumn("text", F.when(F.col("text").isNotNull(), mask(F.col("text"), F.col("_spans"))))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)
