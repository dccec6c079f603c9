"""Every query with its DuckDB counterpart, grouped as in the survey's inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle as O
from checks.workspace import Workspace, workspace
from reviewmill.functions import dates as D
from reviewmill.functions import numbers as N
from reviewmill.functions import text as X
from reviewmill.operators import keywords as KW
from reviewmill.operators import sentiment as S
from reviewmill.operators.dedup import drop_unusable, keep_first, review_key
from reviewmill.operators.joins import BROADCAST_BYTES
from reviewmill.operators.ranking import top_ranked
from reviewmill.operators.release import first_seen, with_release
from reviewmill.operators.windows import change_vs_previous, rolling_rows_mean
from reviewmill.plans import audit as A
from reviewmill.plans import kpi as K
from reviewmill.plans import measures as M
from reviewmill.plans import reports as R
from reviewmill.plans import star as ST
from reviewmill.plans.clean import normalise_text, prepare_reviews, reply_flag, text_features
from reviewmill.schemas import CLEANED_COLUMNS, DETAIL_COLUMNS, FACT_COLUMNS, RAW_REVIEWS, STAR_TABLES
from reviewmill.sources import readers, writers
from reviewmill.sources.sample import raw_reviews, table
from reviewmill.staging import Stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RAW = ", ".join(RAW_REVIEWS.names)
# A row of the raw view is known by these two columns (copies differ in thumbs_up).
ROW_ID = ("review_id", "thumbs_up")


def count_rows():
    return F.count(F.lit(1))


def _add(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None, extra=None) -> None:
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = O.compose(sql, extra)


def on_raw(name: str, build: Callable[[DataFrame], DataFrame], sql: str | None) -> None:
    _add(name, lambda spark, folder: build(raw_reviews(spark, folder)), sql)


def on_workspace(name: str, build: Callable[[Workspace], DataFrame], sql: str | None, extra=None) -> None:
    _add(name, lambda spark, folder: build(workspace(spark, folder)), sql, extra)


def on_cleaned(name: str, build: Callable[[DataFrame], DataFrame], sql: str | None) -> None:
    on_workspace(name, lambda w: build(w.cleaned), sql)


def on_star(name: str, build: Callable[[ST.Star], DataFrame], sql: str | None) -> None:
    on_workspace(name, lambda w: build(w.star), sql)


def feature(name: str, column: str, source: str, value, sql: str) -> None:
    """A scalar feature over every raw review."""
    on_raw(
        name,
        lambda raw: raw.select(*ROW_ID, value(F.col(source)).alias(column)),
        f"select review_id, thumbs_up, {sql} as {column} from raw",
    )


# --- sources and sinks ----------------------------------------------------------------------------

def _fresh(w: Workspace, name: str) -> str:
    return w.stage.path(name)


# Some 500 MB of text: one task writes such a file, and its byte ranges begin inside texts.
ROWS_A_FILE = 200_000


def _csv_round_trip(w: Workspace) -> DataFrame:
    path = _fresh(w, "raw_csv")
    writers.write_table(w.raw.repartition(1 + w.raw.count() // ROWS_A_FILE), path, "csv")
    raw = readers.read_raw_reviews(w.raw.sparkSession, path, na_values=("NA",) + X.NA_VALUES)
    return raw.select(*RAW_REVIEWS.names).withColumn("review_text", F.md5("review_text"))


def _app_batches(w: Workspace) -> DataFrame:
    folder = _fresh(w, "app_batches")
    w.raw.write.partitionBy("app_name").parquet(folder)
    return readers.read_app_folders(w.raw.sparkSession, folder)


def _shaped(spark: SparkSession, folder: str) -> DataFrame:
    fields = {"review_id": "reviewId", "rating": "score", "review_text": "content", "review_date": "at"}
    rows = table(spark, folder, "orders").selectExpr(
        "concat('r', o_orderkey) as reviewId", "substring(o_orderpriority, 1, 1) as score",
        "o_orderstatus as content", "cast(o_orderdate as timestamp_ntz) as at",
    )
    return readers.shape_batch(rows, fields, "com.example", "Example")


def _missing_apps(spark: SparkSession, folder: str) -> DataFrame:
    expected = table(spark, folder, "nation").selectExpr("concat('com.', lower(n_name)) as app_id").unionByName(
        table(spark, folder, "region").selectExpr("concat('com.', lower(r_name)) as app_id")
    )
    return readers.empty_apps(expected, raw_reviews(spark, folder))


def _cleaned_round_trip(w: Workspace, fmt: str) -> DataFrame:
    path = _fresh(w, f"cleaned_{fmt}")
    writers.write_cleaned(w.cleaned, path, fmt)
    back = readers.read_cleaned(w.raw.sparkSession, path, w.cleaned.schema, fmt, stored=False)
    return back.withColumn("review_text", F.md5("review_text"))


def _digested(rows: DataFrame) -> DataFrame:
    """The SHA-256 of each row; both zeros are one value, as in a comparison of rows."""
    numbers = [f.name for f in rows.schema.fields if f.dataType.simpleString() in ("double", "float")]
    return rows.withColumns({n: F.col(n) + F.lit(0.0) for n in numbers}).select(review_key(rows.columns).alias("row"))


def _compared(name: str, label: str, back: DataFrame, source: DataFrame) -> DataFrame:
    """(label, row_count, differing): rows of the stored table, and rows that only one side has.

    Rows meet as digests, once, so no text travels.
    """
    sides = [_digested(back.select(*source.columns)).withColumn("side", F.lit(1)), _digested(source).withColumn("side", F.lit(-1))]
    met = readers.combine_batches(sides).groupBy("row").agg(F.count_if(F.col("side") > 0).alias("row_count"), F.abs(F.sum("side")).alias("differing"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("row_count", "differing")]
    return met.agg(*sums).select(F.lit(name).alias(label), "row_count", "differing")


def _exported(w: Workspace, fmt: str) -> DataFrame:
    folder = _fresh(w, f"star_{fmt}")
    names = writers.export_star(w.star, folder, fmt)
    spark = w.raw.sparkSession
    tables = w.star.tables()
    parts = [
        _compared(n, "table_name", readers.read_cleaned(spark, f"{folder}/{n}", tables[n].schema, fmt, stored=False), tables[n]) for n in names
    ]
    return readers.combine_batches(parts)


def _report_files(w: Workspace) -> DataFrame:
    folder = _fresh(w, "reports")
    names = R.require_all_reports(R.run_reports(w.star, folder, w.stage))
    spark = w.raw.sparkSession
    made = {n: R.REPORTS[n](w.star, w.stage) for n in names}
    parts = [_compared(n, "report", readers.read_csv(spark, f"{folder}/{n}", df.schema), df) for n, df in made.items()]
    return readers.combine_batches(parts)


def _sizes(names_to_sql: dict[str, str], label: str) -> str:
    return " union all ".join(
        f"select '{n}' as {label}, count(*) as row_count, 0::bigint as differing from ({sql}) t{i}" for i, (n, sql) in enumerate(names_to_sql.items())
    )


STAR_SQL = {n: f"select * from {'fact' if n == 'fact_reviews' else n}" for n in STAR_TABLES}
RAW_MD5 = "select * replace (md5(review_text) as review_text) from raw"
CLEANED_LIST = ", ".join(CLEANED_COLUMNS)
CLEANED_MD5 = f"select {CLEANED_LIST.replace('review_text,', 'md5(review_text) as review_text,')} from cleaned"

on_workspace("io1_read_raw_csv", _csv_round_trip, RAW_MD5)
on_workspace("io2_combine_app_batches", lambda w: _app_batches(w).withColumn("review_text", F.md5("review_text")), RAW_MD5)
_add(
    "io3_shape_batch", _shaped,
    "select 'com.example' as app_id, 'Example' as app_name, 'r' || o_orderkey::varchar as review_id, null::varchar as user_name, "
    "cast(substring(o_orderpriority, 1, 1) as integer) as rating, o_orderstatus as review_text, null::bigint as thumbs_up, "
    "null::varchar as app_version, o_orderdate::timestamp as review_date, null::varchar as reply_text from orders",
)
_add(
    "io4_empty_apps", _missing_apps,
    "select app_id from (select 'com.' || lower(n_name) as app_id from nation union all select 'com.' || lower(r_name) from region) "
    "where app_id not in (select app_id from raw)",
)
on_workspace("io5_write_cleaned", lambda w: _cleaned_round_trip(w, "parquet"), CLEANED_MD5)
on_workspace("io6_read_cleaned_csv", lambda w: _cleaned_round_trip(w, "csv"), CLEANED_MD5)
on_workspace("io7_write_star", lambda w: _exported(w, "parquet"), _sizes(STAR_SQL, "table_name"))
on_workspace("io8_export_star_csv", lambda w: _exported(w, "csv"), _sizes(STAR_SQL, "table_name"))

# --- cleaning -------------------------------------------------------------------------------------

on_raw("c1_dedup_keep_first", lambda raw: keep_first(raw, stage=Stage(raw.sparkSession)).drop("review_key"), f"select {RAW} from deduped")
on_raw(
    "c2_drop_null_text", lambda raw: raw.dropna(subset=["review_text"]).select(*ROW_ID, "rating"),
    "select review_id, thumbs_up, rating from raw where review_text is not null",
)
on_raw(
    "c3_drop_null_rating",
    lambda raw: drop_unusable(raw.withColumn("rating", F.col("rating") + F.lit(0.5))).select(*ROW_ID, "rating"),
    "select review_id, thumbs_up, rating from raw where review_text is not null and rating is not null",
)
on_raw(
    "c4_reply_flag", lambda raw: reply_flag(raw).select(*ROW_ID, "has_developer_reply"),
    "select review_id, thumbs_up, cast(reply_text is not null as integer) as has_developer_reply from raw",
)
on_raw(
    "c5_trim_collapse", lambda raw: normalise_text(raw).select(*ROW_ID, "review_text"),
    f"select review_id, thumbs_up, trim(regexp_replace(review_text, {O.quoted(O.SPACES)}, ' ', 'g')) as review_text from raw",
)
on_raw(
    "c6_lower_case", lambda raw: raw.select(*ROW_ID, F.md5(F.lower("review_text")).alias("lower_md5")),
    "select review_id, thumbs_up, md5(lower(review_text)) as lower_md5 from raw",
)
on_cleaned(
    "c7_distinct_projection", lambda c: c.select("app_id", "app_version", "version_release_date").distinct(),
    "select distinct app_id, app_version, version_release_date from tagged",
)
on_workspace(
    "c8_fact_columns", lambda w: w.star.fact_reviews.select(*FACT_COLUMNS).withColumn("review_text", F.md5("review_text")),
    "select " + ", ".join(FACT_COLUMNS).replace("review_text,", "md5(review_text) as review_text,") + " from fact",
)
on_cleaned(
    "c9_with_issue", lambda c: c.filter(F.col("issue_category") != "none").select("review_id", "issue_category"),
    "select review_id, issue_category from tagged where issue_category <> 'none'",
)
on_cleaned(
    "c10_low_rating", lambda c: c.filter(F.col("rating") <= 2).select("review_id", "rating"),
    "select review_id, rating from tagged where rating <= 2",
)

WINDOW_CASE = (
    "case when {d} < {r} and {d} >= {r} - interval 14 day then 'pre_release_14d' "
    "when {d} >= {r} and {d} < {r} + interval 14 day then 'post_release_14d' end"
)


def _own_window(c: DataFrame) -> DataFrame:
    label = D.window_label(F.col("review_date"), F.col("version_release_date"))
    return c.select("review_id", label.alias("window_label"))


OWN_WINDOW = "select review_id, " + WINDOW_CASE.format(d="review_date", r="version_release_date") + " as window_label from tagged"
on_cleaned("c11_drop_unlabelled", lambda c: _own_window(c).filter(F.col("window_label").isNotNull()),
           f"select * from ({OWN_WINDOW}) where window_label is not null")
on_cleaned(
    "c12_slicers",
    lambda c: M.slice_reviews(
        c, apps=["ASIA", "EUROPE"], issues=["ui", "login", "none"], labels=["negative", "neutral"], start="1996-03-01", end="1999-10-31"
    ).select("review_id", "app_name", "issue_category"),
    "select review_id, app_name, issue_category from cleaned where app_name in ('ASIA', 'EUROPE') and issue_category in ('ui', 'login', 'none') "
    "and sentiment_label in ('negative', 'neutral') and review_date >= timestamp '1996-03-01' and review_date < timestamp '1999-11-01'",
)
on_star(
    "c12_slicers_on_star",
    lambda s: M.measures(M.slice_star(s, apps=["ASIA"], versions=["1996.2", "1997.1"], start="1996-05-01", end="1997-02-15"), ["app_version"])
    .select("app_version", "total_reviews", "avg_rating"),
    "select app_version, count(*) as total_reviews, round(avg(rating), 4) as avg_rating from tagged where app_name = 'ASIA' "
    "and app_version in ('1996.2', '1997.1') and review_date >= timestamp '1996-05-01' and review_date < timestamp '1997-02-16' group by app_version",
)

# --- scalar features ------------------------------------------------------------------------------

feature("f1_parse_timestamp", "parsed", "review_date", lambda c: D.parse_timestamp(c.cast("string")), "review_date")
feature("f2_year", "review_year", "review_date", lambda c: F.year(c), "cast(year(review_date) as integer)")
feature("f3_month_key", "review_month", "review_date", lambda c: D.month_key(c), "strftime(review_date, '%Y-%m')")
_monday = "date_trunc('week', review_date)"
feature("f4_week_label", "review_week", "review_date", lambda c: D.week_label(c),
        f"strftime({_monday}, '%Y-%m-%d') || '/' || strftime({_monday} + interval 6 day, '%Y-%m-%d')")
feature("f5_quarter_key", "review_quarter", "review_date", lambda c: D.quarter_key(c), "year(review_date)::varchar || 'Q' || quarter(review_date)::varchar")
feature("f6_text_length", "review_length", "review_text", lambda c: X.text_length(c), "cast(length(review_text) as integer)")
on_raw(
    "f7_word_count", lambda raw: normalise_text(raw).select(*ROW_ID, X.word_count(F.col("review_text")).alias("word_count")),
    "select review_id, thumbs_up, cast(case when t = '' then 0 else len(string_split(t, ' ')) end as integer) as word_count from "
    f"(select *, trim(regexp_replace(review_text, {O.quoted(O.SPACES)}, ' ', 'g')) as t from raw)",
)
feature("f8_sentiment_label", "label", "thumbs_up", lambda c: X.sentiment_label((c % 41 - 20) / F.lit(200.0)), O.label("((thumbs_up % 41 - 20) / 200.0::double)"))
feature("f9_issue_tag", "issue_category", "review_text", lambda c: X.issue_category(F.lower(c)), O.issue_case("lower(review_text)"))
feature("f10_date_key", "date_key", "review_date", lambda c: D.date_key(c), "cast(strftime(review_date, '%Y%m%d') as integer)")
feature("f11_month_name", "month_name", "review_date", lambda c: D.month_name(c), "strftime(review_date, '%b %Y')")
feature("f12_quarter_name", "quarter", "review_date", lambda c: D.quarter_name(c), "'Q' || quarter(review_date)::varchar || ' ' || year(review_date)::varchar")
feature("f13_week_start", "week_start", "review_date", lambda c: D.midnight(D.week_start(c)), f"{_monday}::timestamp")
feature("f14_month_number", "month", "review_date", lambda c: F.month(c), "cast(month(review_date) as integer)")
on_cleaned(
    "f15_days_since_release", lambda c: c.select("review_id", D.days_since(F.col("review_date"), F.col("version_release_date")).alias("days")),
    "select review_id, cast(date_diff('day', version_release_date, review_date) as integer) as days from tagged",
)
on_cleaned(
    "f16_post_release_flag", lambda c: c.select("review_id", D.in_post_release_window(F.col("days_since_version_release")).alias("flag")),
    "select review_id, case when date_diff('day', version_release_date, review_date) <= 14 then 1 else 0 end as flag from tagged",
)
on_star(
    "f17_shift_days",
    lambda s: s.dim_app_version.select(
        "version_key", *[D.shift_days(F.col("version_release_date"), n).alias(a) for n, a in ((-14, "window_start"), (14, "window_end"))]
    ),
    "select version_key, (version_release_date - interval 14 day)::timestamp as window_start, (version_release_date + interval 14 day)::timestamp as window_end from dim_app_version",
)
on_cleaned("f18_window_label", _own_window, OWN_WINDOW)
on_raw(
    "f19_rounding",
    lambda raw: raw.select(*ROW_ID, *[N.round_half_away(F.col("thumbs_up") / F.lit(7.0), n).alias(f"r{n}") for n in (1, 2, 3, 4)]),
    "select review_id, thumbs_up, " + ", ".join(f"round(thumbs_up / 7.0::double, {n}) as r{n}" for n in (1, 2, 3, 4)) + " from raw",
)
feature("f20_safe_divide", "quotient", "rating", lambda c: N.safe_divide(c, F.col("thumbs_up") % 3),
        "case when thumbs_up % 3 = 0 then null else rating::double / (thumbs_up % 3) end")

# --- sentiment ------------------------------------------------------------------------------------

def _scored(rules) -> Callable[[Workspace], DataFrame]:
    def build(w: Workspace) -> DataFrame:
        docs = w.cleaned.select("review_id", "review_text")
        return S.with_sentiment(docs, "review_id", "review_text", S.sample_lexicon(docs.sparkSession), rules).drop("review_text")

    return build


def _scored_by_join(w: Workspace) -> DataFrame:
    docs = w.cleaned.select("review_id", "review_text")
    scores = S.score_by_join(docs, "review_id", "review_text", S.sample_lexicon(docs.sparkSession))
    return S.with_all(docs.select("review_id"), scores, "review_id")


# Repeated terms: the line further down wins, here the one with the larger valence.
REPEATED = (("good", 1.5), ("good", 1.9), ("bad", -3.0), ("bad", -2.5), ("great", 3.1), ("worst", -3.1), ("slow", -1.1))


def _repeated_terms(w: Workspace) -> DataFrame:
    docs = w.cleaned.select("review_id", "review_text")
    lexicon = docs.sparkSession.createDataFrame(list(REPEATED), "term string, valence double")
    inside = S.with_sentiment(docs, "review_id", "review_text", lexicon).select("review_id", F.col("sentiment_score").alias("in_place"))
    joined = S.with_all(docs.select("review_id"), S.score_by_join(docs, "review_id", "review_text", lexicon), "review_id")
    return inside.join(joined.withColumnRenamed("sentiment_score", "by_join"), "review_id")


on_workspace("n1_sentiment", _scored(S.RULES), "select review_id, sentiment_score from s_score")
on_workspace("n1_sentiment_by_join", _scored_by_join, "select review_id, sentiment_score from s_score")
on_workspace(
    "n1_repeated_terms", _repeated_terms, "select review_id, sentiment_score as in_place, sentiment_score as by_join from repeated_score",
    O.sentiment_ctes("trimmed", S.RULES, "repeated_", dict(REPEATED)),
)
for _rule in ((), ("capitals",), ("degree",), ("negation",), ("but",), ("punctuation",)):
    _name = _rule[0] if _rule else "plain"
    on_workspace(
        f"n1_{_name}_only", _scored(_rule), f"select review_id, sentiment_score from {_name}_score",
        O.sentiment_ctes("trimmed", _rule, f"{_name}_"),
    )


# Reviews rarely hold a phrase of the scorer, so one is put before each text; terms that phrases need are added.
PHRASES = (
    "the app was never so good", "it is without doubt great", "no good and no great help", "the least helpful update", "at least it is fun",
    "this is really kind of slow", "the update is to die for", "such a broken heart", "so this one so nice", "neither no bug or problem", "plain words",
)
PHRASE_TERMS = dict(S.SAMPLE_LEXICON) | {"no": -1.2, "kind": 2.4, "heart": 3.2, "die": -2.9}
_PHRASED = "'' || case cast(substr(review_id, 2) as bigint) % {n} {whens} end || ' ' || review_text".format(
    n=len(PHRASES), whens=" ".join(f"when {i} then '{p}'" for i, p in enumerate(PHRASES))
)


def _phrased(rules, join: bool = False) -> Callable[[Workspace], DataFrame]:
    def build(w: Workspace) -> DataFrame:
        docs = w.cleaned.select("review_id", F.expr(_PHRASED).alias("review_text"))
        lexicon = docs.sparkSession.createDataFrame(list(PHRASE_TERMS.items()), "term string, valence double")
        if join:
            return S.with_all(docs.select("review_id"), S.score_by_join(docs, "review_id", "review_text", lexicon, rules), "review_id")
        return S.with_sentiment(docs, "review_id", "review_text", lexicon, rules).drop("review_text")

    return build


for _name, _rules, _join in (
    ("phrases", S.RULES, False), ("phrases_by_join", S.RULES, True), ("no_only", ("no",), False), ("least_only", ("least",), False),
    ("never_so_only", ("never_so",), False), ("without_doubt_only", ("without_doubt", "negation"), False), ("phrases_only", ("phrases",), False),
):
    on_workspace(
        f"n1_{_name}", _phrased(_rules, _join), "select review_id, sentiment_score from p_score",
        {"phrased": f"select review_id, {_PHRASED} as review_text from trimmed"} | O.sentiment_ctes("phrased", _rules, "p_", PHRASE_TERMS),
    )


def _beyond_broadcast(w: Workspace) -> DataFrame:
    docs = w.cleaned.select("review_id", "review_text")
    scores = S.score_by_join(docs, "review_id", "review_text", S.sample_lexicon(docs.sparkSession), limit_bytes=0, stage=w.stage)
    return S.with_all(docs.select("review_id"), scores, "review_id")


on_workspace("n1_beyond_broadcast", _beyond_broadcast, "select review_id, sentiment_score from s_score")

# --- issue tags from a keyword table ----------------------------------------------------------------

# Beginnings of documents, the longest first, before the library's own keywords.
OPENINGS = "select distinct lower(substr(text, 1, 4 + cast(doc_id % 12 as int))) as keyword, 'opening ' || cast(4 + doc_id % 12 as {string}) as category, cast(15 - doc_id % 12 as int) as place from {documents} where text is not null"


def _many_keywords(limit_bytes: int):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        w = workspace(spark, folder)
        openings = spark.sql(OPENINGS.format(string="string", documents="{documents}"), documents=table(spark, folder, "documents"))
        own = KW.keyword_table(spark).withColumn("place", F.col("place") + 100)
        docs = w.cleaned.select("review_id", F.lower("review_text").alias("review_text"))
        return KW.tag_by_keywords(docs, "review_id", "review_text", openings.unionByName(own), limit_bytes=limit_bytes, stage=w.stage)

    return build


def _many_keywords_ctes() -> dict[str, str]:
    own = ", ".join(f"({O.quoted(word)}, {O.quoted(category)}, {100 + place})" for place, (category, words) in enumerate(X.ISSUE_KEYWORDS) for word in words)
    return {
        "kw": f"{OPENINGS.format(string='varchar', documents='documents')} union all select * from (values {own}) t(keyword, category, place)",
        "low": "select review_id, lower(review_text) as review_text from trimmed",
        "hit": "select review_id, min({'place': place, 'category': category}) as first from low join kw on contains(review_text, keyword) group by review_id",
    }


MANY_KEYWORDS = "select low.review_id, coalesce(first.category, 'none') as issue_category from low left join hit on low.review_id = hit.review_id"
_add("f9_issue_tag_many", _many_keywords(BROADCAST_BYTES), MANY_KEYWORDS, _many_keywords_ctes())
_add("f9_issue_tag_beyond_broadcast", _many_keywords(0), MANY_KEYWORDS, _many_keywords_ctes())
on_workspace(
    "f9_issue_tag_by_table",
    lambda w: KW.tag_by_keywords(
        w.cleaned.select("review_id", F.lower("review_text").alias("t")), "review_id", "t", KW.keyword_table(w.raw.sparkSession), stage=w.stage
    ),
    f"select review_id, {O.issue_case('lower(review_text)')} as issue_category from trimmed",
)

# --- joins ----------------------------------------------------------------------------------------

on_workspace("j1_app_key", lambda w: ST.attach_app(w.cleaned, w.star.dim_app).select("review_id", "app_key"), "select review_id, app_key from fact")
on_workspace("j2_version_key", lambda w: ST.attach_version(w.cleaned, w.star.dim_app_version).select("review_id", "version_key"), "select review_id, version_key from fact")
on_workspace("j3_issue_key", lambda w: ST.attach_issue(w.cleaned, w.star.dim_issue_category).select("review_id", "issue_key"), "select review_id, issue_key from fact")
on_star(
    "j4_star_join", lambda s: M.sums_by(s, ["app_name", "app_version", "issue_category"]).select("app_name", "app_version", "issue_category", F.col("n").alias("review_count")),
    "select app_name, app_version, issue_category, count(*) as review_count from tagged group by all",
)
on_star(
    "j5_issue_with_total",
    lambda s: R.issue_frequency(s, None).select("app_name", "issue_category", "issue_review_count", "total_reviews"),
    "select i.app_name, issue_category, n as issue_review_count, t.total_reviews from (select app_id, app_name, issue_category, count(*) as n from tagged group by all) i "
    "join (select app_id, count(*) as total_reviews from tagged group by all) t on i.app_id = t.app_id where issue_category <> 'none'",
)
WINDOWED = (
    "select a.app_name, v.version_key, v.app_version, v.version_release_date, f.rating, f.sentiment_score, "
    + WINDOW_CASE.format(d="f.review_date", r="v.version_release_date")
    + " as window_label from dim_app_version v join dim_app a on v.app_id = a.app_id join fact f on f.app_key = a.app_key"
)
on_star(
    "j6_release_interval_join",
    lambda s: R.release_windows(s).select(
        "app_name", "app_version", *[F.coalesce(f"{x}_n", F.lit(0)).alias(f"{x}_n") for x in ("pre", "post")],
        *[F.coalesce(f"{x}_rating_sum", F.lit(0)).alias(f"{x}_rating_sum") for x in ("pre", "post")],
    ),
    "select app_name, app_version, " + ", ".join(
        f"count(*) filter (window_label = '{x}_release_14d') as {x}_n, cast(coalesce(sum(rating) filter (window_label = '{x}_release_14d'), 0) as bigint) as {x}_rating_sum"
        for x in ("pre", "post")
    ) + f" from ({WINDOWED}) where window_label is not null group by app_name, version_key, app_version",
)
IMPACT = (
    f"with g as (select app_name, version_key, app_version, version_release_date, window_label, count(*) as n, {O.RATING} as r, {O.SENTIMENT} as s "
    f"from ({WINDOWED}) where window_label is not null group by all) "
)
on_star(
    "j7_pre_post_pairs",
    lambda s: R.release_impact(s, None).select("app_name", "app_version", "pre_review_count", "post_review_count"),
    "select pre.app_name, pre.app_version, pre.n as pre_review_count, post.n as post_review_count from (select * from ("
    + IMPACT + "select * from g)) pre join (select * from (" + IMPACT
    + "select * from g)) post on pre.version_key = post.version_key and pre.window_label = 'pre_release_14d' and post.window_label = 'post_release_14d'",
)
on_workspace(
    "j8_first_release",
    lambda w: with_release(
        w.cleaned.drop("version_release_date", "days_since_version_release", "is_post_release_window"),
        w.stage.put(first_seen(w.cleaned), "first_seen"),
    ).select("review_id", "version_release_date", "days_since_version_release", "is_post_release_window"),
    "select review_id, version_release_date, days_since_version_release, is_post_release_window from tagged",
)

# --- aggregates -----------------------------------------------------------------------------------

on_cleaned("a1_count", lambda c: c.groupBy("app_name").agg(count_rows().alias("n")), "select app_name, count(*) as n from tagged group by all")
on_star(
    "a2_averages", lambda s: M.sums_by(s, ["app_version"]).select("app_version", M.avg_rating().alias("avg_rating"), M.avg_sentiment().alias("avg_sentiment")),
    f"select app_version, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment from cleaned group by all",
)
on_star(
    "a3_percentages", lambda s: R.app_ranking(s, None).select("app_name", "pct_positive", "pct_negative", "developer_reply_rate"),
    "select a.app_name, " + ", ".join(
        f"round(100.0::double * count(*) filter ({c}) / count(*), 1) as {a}"
        for c, a in (("sentiment_label = 'positive'", "pct_positive"), ("sentiment_label = 'negative'", "pct_negative"), ("has_developer_reply = 1", "developer_reply_rate"))
    ) + " from fact f join dim_app a on f.app_key = a.app_key group by a.app_key, a.app_name",
)
on_cleaned("a4_conditional_count", lambda c: c.groupBy("app_name").agg(F.count_if(F.col("issue_category") != "none").alias("n")),
           "select app_name, count(*) filter (issue_category <> 'none') as n from tagged group by all")
on_cleaned("a5_min_in_group", lambda c: c.groupBy("app_name", "review_month").agg(F.min("review_date").alias("first_review")),
           "select app_name, review_month, min(review_date) as first_review from tagged group by all")
on_star("a6_group_by_key_and_name", lambda s: s.facts.groupBy("app_key").agg(count_rows().alias("n")).join(s.dim_app, "app_key").select("app_key", "app_name", "n"),
        "select app_key, app_name, count(*) as n from fact group by all")
on_cleaned("a7_having", lambda c: c.groupBy("app_name", "app_version").agg(count_rows().alias("n")).filter(F.col("n") >= 110),
           "select app_name, app_version, count(*) as n from tagged group by all having count(*) >= 110")
on_star("a8_share_of_total", lambda s: R.issue_frequency(s, None).select("app_name", "issue_category", "pct_of_app_reviews"),
        "select app_name, issue_category, round(100.0::double * n / sum(n) over (partition by app_id), 1) as pct_of_app_reviews from "
        "(select app_id, app_name, issue_category, count(*) as n from tagged group by all) qualify issue_category <> 'none'")
on_cleaned("a9_distinct_count", lambda c: c.agg(F.countDistinct("app_name").alias("apps"), F.countDistinct("app_version").alias("versions")),
           "select count(distinct app_name) as apps, count(distinct app_version) as versions from tagged")
on_star("a10_global_averages", lambda s: M.sums_by(s, []).select(F.col("n").alias("total"), M.avg_rating().alias("avg_rating"), M.avg_sentiment().alias("avg_sentiment")),
        f"select count(*) as total, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment from cleaned")
MEANS = "(select app_name, avg(rating) as m from tagged group by all)"
on_cleaned("a11_best_and_worst", K.best_and_worst,
           f"select (select app_name from {MEANS} order by m desc, app_name limit 1) as best_app, (select app_name from {MEANS} order by m, app_name limit 1) as worst_app")
TOP_ISSUE = "(select issue_category from tagged where issue_category <> 'none' group by 1 order by count(*) desc, 1 limit 1)"
on_cleaned("a12_most_common_issue", K.most_common_issue, f"select coalesce({TOP_ISSUE}, 'none') as top_issue")
on_cleaned("a13_value_counts", lambda c: A.value_counts(c, "sentiment_label"), "select sentiment_label, count(*) as row_count from cleaned group by all")
PIVOT = ", ".join(f"count(*) filter (issue_category = '{i}') as {i}" for i in (*K.ISSUES, "none"))
PIVOT5 = ", ".join(f"count(*) filter (issue_category = '{i}') as {i}" for i in K.ISSUES)
on_cleaned("a14_pivot_counts", lambda c: c.groupBy("app_name").pivot("issue_category", list(K.ISSUES)).count().na.fill(0),
           f"select app_name, {PIVOT5} from tagged group by all")
on_cleaned("a15_group_fraction", lambda c: K.app_summary(c).select("app_name", "negative_share"),
           "select app_name, round(count(*) filter (sentiment_label = 'negative') / count(*)::double, 4) as negative_share from cleaned group by all")

# --- windows --------------------------------------------------------------------------------------

VERSION_STATS = (
    f"select app_name, app_version, version_release_date, count(*) as review_count, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment "
    "from cleaned group by all"
)
LAG = "lag({c}) over (partition by app_name order by version_release_date nulls first, app_version nulls first)"
HEALTH = (
    f"select *, round(avg_rating - {LAG.format(c='avg_rating')}, 2) as rating_change_vs_prev, "
    f"round(avg_sentiment - {LAG.format(c='avg_sentiment')}, 3) as sentiment_change_vs_prev from ({VERSION_STATS})"
)


def _lag_delta(c: DataFrame) -> DataFrame:
    by = ["app_name", "app_version", "version_release_date"]
    stats = c.groupBy(*by).agg(N.round_half_away(F.avg("rating"), 2).alias("avg_rating"))
    order = [F.col("version_release_date").asc_nulls_first(), F.col("app_version").asc_nulls_first()]
    return stats.select("app_name", "app_version", change_vs_previous("avg_rating", ["app_name"], order, 2).alias("change"))


on_cleaned("w1_lag_delta", _lag_delta, f"select app_name, app_version, rating_change_vs_prev as change from ({HEALTH})")
MONTHLY = (
    f"select app_name, review_month, min(review_date) as first_day, count(*) as review_count, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment, "
    "min(strftime(review_date, '%b %Y')) as month_name from cleaned group by app_name, review_month"
)
ROLLING = "round(avg(avg_rating) over (partition by app_name order by review_month rows between 2 preceding and current row), 2)"
on_cleaned(
    "w2_rolling_mean",
    lambda c: c.groupBy("app_name", "review_month").agg(N.round_half_away(F.avg("rating"), 2).alias("avg_rating")).select(
        "app_name", "review_month", rolling_rows_mean("avg_rating", ["app_name"], [F.col("review_month")], 3, 2).alias("rolling")
    ),
    f"select app_name, review_month, {ROLLING} as rolling from ({MONTHLY})",
)
on_workspace(
    "w3_top_ranked",
    lambda w: top_ranked(w.cleaned, ["app_id"], "thumbs_up", 5, w.stage, "cutoffs").select("app_id", "review_id", "thumbs_up"),
    "select app_id, review_id, thumbs_up from tagged qualify rank() over (partition by app_id order by thumbs_up desc) <= 5",
)
on_star("w4_app_keys", lambda s: s.dim_app, "select app_key, app_id, app_name from dim_app")
on_star("w4_version_keys", lambda s: s.dim_app_version, "select version_key, app_id, app_version, version_release_date from dim_app_version")
TRAILING = (
    "select d.app_name, e.month_name, round(round(avg(d.m), 7), 4) as rolling_avg from "
    "(select app_name, date_trunc('day', review_date)::timestamp as day, avg(rating) as m from tagged group by all) d join "
    "(select month_name, max(date) as e from dim_date group by all) e on d.day <= e.e and d.day > e.e - interval 3 month group by d.app_name, e.month_name"
)
on_star("w5_trailing_months", lambda s: M.trailing_rating(s).select("app_name", "month_name", "rolling_avg"), TRAILING)
PREVIOUS_DATE = (
    "(select version_release_date as d, lag(version_release_date) over (order by version_release_date nulls first) as prev "
    "from (select distinct version_release_date from dim_app_version))"
)
PREVIOUS = (
    "select c.app_name, c.app_version, c.version_release_date, round(c.a, 4) as avg_rating, round(p.a, 4) as prev_version_avg_rating, "
    "round(c.a - coalesce(p.a, 0), 4) as rating_change_vs_prev_version from "
    "(select app_name, app_version, version_release_date, avg(rating) as a from tagged group by all) c "
    f"join {PREVIOUS_DATE} x on c.version_release_date is not distinct from x.d left join "
    "(select app_name, version_release_date, avg(rating) as a from tagged group by all) p "
    "on c.app_name = p.app_name and x.prev is not distinct from p.version_release_date"
)
on_star("w6_previous_release", M.rating_vs_previous_release, PREVIOUS)

# --- sort, limit, sets ----------------------------------------------------------------------------

on_cleaned("s1_order_by", lambda c: c.groupBy("app_name").agg(count_rows().alias("n")).orderBy(F.desc("n"), "app_name"),
           "select app_name, count(*) as n from tagged group by all order by n desc, app_name")
on_cleaned(
    "s2_top_twenty",
    lambda c: c.groupBy("app_name", "app_version").agg(count_rows().alias("n")).orderBy(F.desc("n"), "app_name", F.col("app_version").asc_nulls_first()).limit(20),
    "select app_name, app_version, count(*) as n from tagged group by all order by n desc, app_name, app_version nulls first limit 20",
)
on_cleaned("s3_sorted_by_date", lambda c: c.select("review_id", "review_date").sortWithinPartitions("review_date"), "select review_id, review_date from tagged")
on_workspace("s4_union_all", lambda w: w.star.dim_app.select("app_name").unionByName(w.cleaned.select("app_name")),
             "select app_name from dim_app union all select app_name from tagged")
on_cleaned("s5_distinct_sorted", lambda c: c.select("app_name").distinct().orderBy("app_name"), "select distinct app_name from tagged order by 1")

# --- reports --------------------------------------------------------------------------------------

KEYED_HEALTH = (
    "select app_name, app_version, version_release_date, review_count, avg_rating, avg_sentiment, "
    f"round(avg_rating - {LAG.format(c='avg_rating')}, 2) as rating_change_vs_prev, round(avg_sentiment - {LAG.format(c='avg_sentiment')}, 3) as sentiment_change_vs_prev "
    f"from (select a.app_name, v.app_version, v.version_release_date, count(*) as review_count, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment "
    "from fact f join dim_app a on f.app_key = a.app_key join dim_app_version v on f.version_key = v.version_key "
    "group by a.app_key, a.app_name, v.version_key, v.app_version, v.version_release_date)"
)
REPORT_SQL = {
    "q1_app_ranking": f"select a.app_name, count(*) as review_count, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment, "
    "round(100.0::double * count(*) filter (sentiment_label = 'positive') / count(*), 1) as pct_positive, "
    "round(100.0::double * count(*) filter (sentiment_label = 'negative') / count(*), 1) as pct_negative, "
    "round(100.0::double * count(*) filter (has_developer_reply = 1) / count(*), 1) as developer_reply_rate from fact f join dim_app a on f.app_key = a.app_key group by a.app_key, a.app_name",
    "q2_version_health": KEYED_HEALTH,
    "q3_issue_frequency": "select app_name, issue_category, n as issue_review_count, cast(t as bigint) as total_reviews, round(100.0::double * n / t, 1) as pct_of_app_reviews "
    "from (select *, sum(n) over (partition by app_key) as t from (select a.app_key, a.app_name, i.issue_category, count(*) as n from fact f join dim_app a on f.app_key = a.app_key "
    "join dim_issue_category i on f.issue_key = i.issue_key group by a.app_key, a.app_name, i.issue_category)) where issue_category <> 'none'",
    "q4_monthly_trend": f"select app_name, month_name, review_count, avg_rating, avg_sentiment, {ROLLING} as rolling_3mo_avg_rating from ({MONTHLY})",
    "q5_release_impact": IMPACT + "select pre.app_name, pre.app_version, pre.version_release_date, pre.n as pre_review_count, pre.r as pre_avg_rating, pre.s as pre_avg_sentiment, "
    "post.n as post_review_count, post.r as post_avg_rating, post.s as post_avg_sentiment, round(post.r - pre.r, 2) as rating_delta, round(post.s - pre.s, 3) as sentiment_delta "
    "from g pre join g post on pre.version_key = post.version_key and pre.window_label = 'pre_release_14d' and post.window_label = 'post_release_14d'",
    "q6_liked_complaints": "select app_name, review_text, rating, thumbs_up, issue_category, review_date from tagged where rating <= 2 "
    "qualify rank() over (partition by app_id order by thumbs_up desc) <= 5",
    "q7_reply_split": f"select a.app_name, has_developer_reply, count(*) as review_count, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment "
    "from fact f join dim_app a on f.app_key = a.app_key group by a.app_key, a.app_name, has_developer_reply",
    "q8_worst_versions": f"select app_name, app_version, version_release_date, count(*) as review_count, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment, "
    "round(100.0::double * count(*) filter (sentiment_label = 'negative') / count(*), 1) as pct_negative, count(*) filter (issue_category <> 'none') as issue_review_count "
    "from cleaned group by all having count(*) >= 10 order by avg_rating, pct_negative desc, app_name, app_version nulls first limit 20",
}
for _name, _sql in REPORT_SQL.items():
    _sql = f"select * from ({_sql})" if _sql.startswith("with ") else _sql
    on_workspace(_name, lambda w, build=R.REPORTS[_name]: build(w.star, w.stage), _sql)

on_workspace(
    "k1_app_summary", lambda w: K.app_summary(w.cleaned),
    f"select app_name, count(*) as reviews, {O.RATING} as avg_rating, {O.SENTIMENT} as avg_sentiment, "
    "round(count(*) filter (sentiment_label = 'negative') / count(*)::double, 4) as negative_share, "
    f"round(count(*) filter (sentiment_label = 'positive') / count(*)::double, 4) as positive_share, {PIVOT5} from cleaned group by all",
)
on_workspace(
    "k2_kpi_table", lambda w: K.kpi_table(w.cleaned, w.stage),
    "select 'Total Reviews' as metric, count(*)::varchar as value from tagged union all "
    "select 'Apps Compared', count(distinct app_name)::varchar from tagged union all "
    f"select 'Overall Avg Rating', ({O.RATING})::varchar from tagged union all "
    f"select 'Overall Avg Sentiment', ({O.SENTIMENT})::varchar from cleaned union all "
    f"select 'Highest Avg Rating App', (select app_name from {MEANS} order by m desc, app_name limit 1) union all "
    f"select 'Lowest Avg Rating App', (select app_name from {MEANS} order by m, app_name limit 1) union all "
    f"select 'Most Common Issue', coalesce({TOP_ISSUE}, 'none')",
)

AVG4 = "round(avg(rating), 4)"
SENT4 = "round(cast(sum(cast(sentiment_score as decimal(8,4))) as double) / count(*), 4)"
MEASURES = (
    f"count(*) as total_reviews, {AVG4} as avg_rating, {SENT4} as avg_sentiment, "
    "round(count(*) filter (sentiment_label = 'negative') / count(*)::double, 4) as pct_negative, "
    "round(count(*) filter (sentiment_label = 'positive') / count(*)::double, 4) as pct_positive, "
    "round(avg(rating) filter (is_post_release_window = 1), 4) as post_release_avg_rating, "
    "round(count(*) filter (has_developer_reply = 1) / count(*)::double, 4) as developer_reply_rate"
)
on_star("b1_measures", lambda s: M.measures(s, ["app_name", "issue_category"]), f"select app_name, issue_category, {MEASURES} from cleaned group by all")
on_star("b1_measures_by_year", lambda s: M.measures(s, ["year", "issue_description"]),
        f"select d.year, i.issue_description, {MEASURES} from fact f join dim_date d on f.date_key = d.date_key "
        "join dim_issue_category i on f.issue_key = i.issue_key group by all")
on_star("b1_measures_by_week", lambda s: M.measures(s, ["app_name", "week_start", "month"]),
        f"select a.app_name, d.week_start, d.month, {MEASURES} from fact f join dim_date d on f.date_key = d.date_key "
        "join dim_app a on f.app_key = a.app_key group by all")
on_star("b1_measures_total", lambda s: M.measures(s), f"select {MEASURES} from cleaned")
on_star(
    "b2_rating_trend", M.rating_trend,
    f"select r.app_name, r.month_name, m.avg_rating, r.rolling_avg as rolling_3_month_avg_rating from ({TRAILING}) r left join "
    f"(select app_name, strftime(review_date, '%b %Y') as month_name, {AVG4} as avg_rating from tagged group by all) m on r.app_name = m.app_name and r.month_name = m.month_name",
)
on_star("b3_sentiment_by_month", M.sentiment_by_month,
        "select app_name, strftime(review_date, '%b %Y') as month_name, sentiment_label, count(*) as review_count from cleaned group by all")
on_star("b4_version_averages", M.version_averages, f"select app_version, {AVG4} as avg_rating, {SENT4} as avg_sentiment from cleaned group by all")
on_star("b5_issue_matrix", M.issue_matrix, f"select app_name, {PIVOT} from tagged group by all")
on_star("b6_vs_previous_release", M.rating_vs_previous_release, PREVIOUS)
on_star("b7_issue_share", M.issue_share,
        "select issue_category, count(*) as review_count, round(count(*) / (sum(count(*)) over ())::double, 4) as share_of_reviews from tagged group by all")
on_star("b8_release_window_matrix", M.release_window_matrix,
        f"select app_name, app_version, is_post_release_window, count(*) as review_count, {AVG4} as avg_rating, {SENT4} as avg_sentiment from cleaned group by all")
on_star("b9_top_complaints", M.top_complaints, "select review_id, review_text, rating, thumbs_up from tagged where rating <= 2")
on_cleaned("b10_review_detail", M.review_detail, "select " + ", ".join(DETAIL_COLUMNS) + " from cleaned")

# --- jobs -----------------------------------------------------------------------------------------

on_raw(
    "p1_prepare_reviews", lambda raw: prepare_reviews(raw).drop("review_key", "review_text"),
    "select " + ", ".join(c for c in CLEANED_COLUMNS if c not in (
        "review_text", "sentiment_score", "sentiment_label", "version_release_date", "days_since_version_release", "is_post_release_window"
    )) + " from tagged",
)
on_workspace("p1_clean_reviews", lambda w: w.cleaned.withColumn("review_text", F.md5("review_text")), CLEANED_MD5)
on_star("p2_dim_date", lambda s: s.dim_date, "select * from dim_date")
on_star(
    "p2_dim_issue_category",
    lambda s: s.facts.groupBy("issue_key").agg(count_rows().alias("review_count")).join(s.dim_issue_category, "issue_key", "right")
    .select("issue_key", "issue_category", "issue_description", F.coalesce("review_count", F.lit(0)).alias("review_count")),
    "select issue_key, i.issue_category, issue_description, count(t.review_id) as review_count from dim_issue_category i "
    "left join tagged t on i.issue_category = t.issue_category group by all",
)
OWN_KEYWORDS = (("love", ("love", "enjoy")), *X.ISSUE_KEYWORDS)


def _own_categories(w: Workspace) -> DataFrame:
    """Reports over a star with a category of the user's own: no review gets lost."""
    retagged = w.cleaned.withColumn("issue_category", X.issue_category(F.lower("review_text"), OWN_KEYWORDS))
    star = ST.build_star(retagged, w.stage, OWN_KEYWORDS)
    return R.issue_frequency(star, w.stage)


OWN_CASE = O.issue_case("lower(review_text)", OWN_KEYWORDS)
on_workspace(
    "p2_own_issue_categories", _own_categories,
    "select app_name, issue_category, n as issue_review_count, cast(t as bigint) as total_reviews, round(100.0::double * n / t, 1) as pct_of_app_reviews "
    f"from (select *, sum(n) over (partition by app_id) as t from (select app_id, app_name, {OWN_CASE} as issue_category, count(*) as n from tagged group by all)) "
    "where issue_category <> 'none'",
)
on_star(
    "p2_fact_reviews", lambda s: s.fact_reviews.select(*FACT_COLUMNS).withColumn("review_text", F.md5("review_text")),
    "select " + ", ".join(FACT_COLUMNS).replace("review_text,", "md5(review_text) as review_text,") + " from fact",
)
REPORT_SIZES = {n: (f"select * from ({q})" if q.startswith("with ") else q) for n, q in REPORT_SQL.items()}
on_workspace("p3_run_reports", _report_files, _sizes(REPORT_SIZES, "report"))
on_workspace("p4_export_star", lambda w: _exported(w, "parquet"), _sizes(STAR_SQL, "table_name"))
on_workspace(
    "io9_export_reports", _report_files, _sizes(REPORT_SIZES, "report"),
)
on_workspace(
    "io10_audit", lambda w: A.audit(w.raw, w.cleaned, w.star),
    "select 'clean' as step, 'rows_in' as detail, count(*) as row_count from raw union all "
    "select 'clean', 'after_dedup', count(*) from deduped union all select 'clean', 'after_null_drop', count(*) from usable union all "
    "select 'clean', 'final', count(*) from tagged union all "
    "select 'issue_category', issue_category, count(*) from tagged group by all union all "
    "select 'sentiment_label', sentiment_label, count(*) from cleaned group by all union all "
    + " union all ".join(f"select 'star', '{n}', count(*) from ({q}) t" for n, q in STAR_SQL.items()),
)
