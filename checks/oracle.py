"""The same results in plain SQL for DuckDB: common table expressions and a small composer."""

from __future__ import annotations

import re

from reviewmill.functions.text import ISSUE_KEYWORDS
from reviewmill.operators import sentiment as S
from reviewmill.schemas import ISSUE_DIMENSION
from reviewmill.sources.sample import RAW_REVIEWS_SQL, TABLES

DUCKDB_WORDS = {
    "string": "varchar",
    "naive": "timestamp",
    "timestamp": "o_orderdate + to_seconds(o_orderkey % 86400)",
    "explode": "unnest",
    "one": "[0]",
    "two": "[0, 1]",
} | {name: name for name in TABLES}

# RE2 has no Unicode-aware \s, so the class is spelled out.
SPACES = (
    r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(quoted(w) for w in words) + ")"


def issue_case(lowered: str, keywords=ISSUE_KEYWORDS) -> str:
    branches = " ".join(
        "when " + " or ".join(f"contains({lowered}, {quoted(w)})" for w in words) + f" then {quoted(category)}"
        for category, words in keywords
    )
    return f"case {branches} else 'none' end"


def bare(token: str) -> str:
    stripped = f"trim({token}, {quoted(S.PUNCTUATION)})"
    return f"case when length({stripped}) <= 2 then {token} else {stripped} end"


def caps(word: str) -> str:
    return f"(upper({word}) = {word} and lower({word}) <> {word})"


def half_away(x: str, digits: int) -> str:
    scale = f"{10**digits}::double"
    return f"(case when {x} < 0 then -(floor(abs({x}) * {scale} + 0.5::double) / {scale}) else floor(abs({x}) * {scale} + 0.5::double) / {scale} end)"


def label(score: str) -> str:
    return f"case when {score} >= 0.05::double then 'positive' when {score} <= -0.05::double then 'negative' else 'neutral' end"


# Lower-case words without outer punctuation: strip it after and before each blank, then split.
PUNCT = r"[!-/:-@\[-`{-~]+"
STRIPPED_WORDS = (
    "list_slice(string_split(regexp_replace(regexp_replace(' ' || lower(t) || ' ', "
    f"{quoted(' ' + PUNCT)}, ' ', 'g'), {quoted(PUNCT + ' ')}, ' ', 'g'), ' '), 2, len(w) + 1)"
)


def sentiment_ctes(source: str, rules=S.RULES, prefix: str = "s_", terms=dict(S.SAMPLE_LEXICON)) -> dict[str, str]:
    """CTEs ending in ``<prefix>score (review_id, sentiment_score)`` over ``source``."""
    p = prefix
    known = set(terms)
    strong, weak = ([w for w in ws if w not in known] for ws in (S.STRENGTHENERS, S.WEAKENERS))
    negations = [w for w in S.NEGATIONS if w not in known]
    listed = in_list(known)
    lexicon = [(t, v) for t, v in terms.items() if t not in S.STRENGTHENERS + S.WEAKENERS]
    ctes = {
        f"{p}lexicon": "select term, valence from (values "
        + ", ".join(f"({quoted(t)}, {v}::double)" for t, v in lexicon)
        + ") as l(term, valence)",
        f"{p}docs": f"select review_id, review_text as t, string_split(review_text, ' ') as w from {source}",
        f"{p}tokens": "select review_id, pos, tok, case when length(loose) <= 2 then lower(tok) else loose end as term from ("
        f"select review_id, unnest(w) as tok, unnest({STRIPPED_WORDS}) as loose, generate_subscripts(w, 1) - 1 as pos from {p}docs)",
        f"{p}but": f"select review_id, min(pos) as but_at from {p}tokens where term = 'but' group by review_id",
        f"{p}found": f"select k.*, {bare('k.tok')} as bare, l.valence from {p}tokens k join {p}lexicon l on k.term = l.term",
        f"{p}hits": "select f.review_id, f.pos, f.bare, f.valence, b.but_at, "
        f"regexp_matches(d.t, {quoted(S.CAPS_WORD)}) and regexp_matches(d.t, {quoted(S.PLAIN_WORD)}) as mixed, "
        + ", ".join(
            f"case when f.pos >= {n} then {bare(f'd.w[f.pos + 1 - {n}]')} else '' end as back{n}" for n in (1, 2, 3)
        )
        + "".join(f", lower(coalesce({bare(f'd.w[f.pos + 1 + {n}]')}, '')) as next{n}" for n in (1, 2))
        + f" from {p}found f join {p}docs d on f.review_id = d.review_id left join {p}but b on f.review_id = b.review_id",
    }
    value = "valence"
    if "no" in rules:
        value = (
            f"case when b1 = 'no' or b2 = 'no' or (b3 = 'no' and b1 in ('or', 'nor')) then valence * (-0.74)::double "
            f"when lower(bare) = 'no' and next1 in {listed} then 0::double else valence end"
        )
    lowered = ", ".join(f"lower(back{n}) as b{n}" for n in (1, 2, 3))
    step = f"select *, {value} as v from (select *, {lowered} from {p}hits)"
    if "capitals" in rules:
        step = (
            f"select * replace (case when {caps('bare')} and mixed then v + (case when v > 0 then 0.733 else -0.733 end)::double else v end as v) from ({step})"
        )
    far = f"pos >= 3 and b3 not in {listed}"
    for n, damping in ((1, "1.0"), (2, "0.95"), (3, "0.9")):
        word = f"lower(back{n})"
        if "degree" in rules:
            is_strong, is_weak = f"{word} in {in_list(strong)}", f"{word} in {in_list(weak)}"
            push = f"(case when {is_strong} then 0.293 when {is_weak} then -0.293 else 0 end)::double"
            loud = f"(case when ({is_strong} or {is_weak}) and {caps(f'back{n}')} and mixed then 0.733 else 0 end)::double"
            step = (
                f"select * replace (v + (case when v < 0 then -{push} else {push} end + "
                f"case when v > 0 then {loud} else -{loud} end) * {damping}::double as v) from ({step})"
            )
        near = f"b{n}"
        between = [f"b{k}" for k in range(1, n)]
        cases = []
        if "never_so" in rules and n > 1:
            never = f"{near} = 'never'" if "never" not in known else "false"
            cases.append(f"when {never} and {between[-1]} in ('so', 'this')" + (f" or {far} and b1 in ('so', 'this')" if n == 3 else "") + " then v * 1.25::double")
        if "without_doubt" in rules and n > 1 and "without" not in known:
            cases.append(f"when {near} = 'without' and 'doubt' in ({', '.join(between)}) then v")
        if "negation" in rules:
            cases.append(f"when {word} in {in_list(negations)} or contains({word}, 'n''t') then v * (-0.74)::double")
        if cases:
            step = f"select * replace (case {' '.join(cases)} else v end as v) from ({step})"
    if "phrases" in rules:
        idioms = "case {} " + " ".join(f"when {quoted(i)} then {v}::double" for i, v in S.IDIOMS) + " end"
        word = "lower(bare)"
        before = ["b1 || ' ' || {w}", "b2 || ' ' || b1 || ' ' || {w}", "b2 || ' ' || b1", "b3 || ' ' || b2 || ' ' || b1", "b3 || ' ' || b2"]
        found = ", ".join(idioms.format(x.format(w=word)) for x in before)
        behind = ", ".join(idioms.format(x) for x in (f"{word} || ' ' || next1 || ' ' || next2", f"{word} || ' ' || next1"))
        weak = " + ".join(f"(case when {x} in {in_list(S.WEAK_PHRASES)} then 0.293 else 0 end)::double" for x in ("b3 || ' ' || b2",))
        weaker = "(case when b2 || ' ' || b1 in " + in_list(S.WEAK_PHRASES) + " then 0.293 else 0 end)::double"
        step = (
            f"select * replace (case when {word} = 'kind' and next1 = 'of' then 0::double when {far} "
            f"then coalesce({behind}, {found}, v) - {weak} - {weaker} else v end as v) from ({step})"
        )
    if "least" in rules and "least" not in known:
        step = f"select * replace (case when b1 = 'least' and b2 not in ('at', 'very') then v * (-0.74)::double else v end as v) from ({step})"
    if "but" in rules:
        step = (
            "select * replace (v * (case when pos < but_at then 0.5 when pos > but_at then 1.5 else 1 end)::double as v) "
            f"from ({step})"
        )
    ctes[f"{p}valued"] = step
    ctes[f"{p}total"] = (
        f"select review_id, cast(sum(cast(floor(v * 1e9::double + 0.5::double) as bigint)) as bigint) / 1e9::double as x from {p}valued group by review_id"
    )
    bangs = "length(t) - length(replace(t, '!', ''))"
    asks = "length(t) - length(replace(t, '?', ''))"
    emphasis = (
        f"least({bangs}, 4) * 0.292::double + (case when {asks} <= 1 then 0::double when {asks} <= 3 "
        f"then ({asks}) * 0.18::double else 0.96::double end)"
    )
    x = "coalesce(x, 0)"
    if "punctuation" in rules:
        x = f"case when x > 0 then x + ({emphasis}) when x < 0 then x - ({emphasis}) else coalesce(x, 0) end"
    ctes[f"{p}score"] = (
        f"select review_id, {half_away('(y / sqrt(y * y + 15::double))', 4)} as sentiment_score from "
        f"(select d.review_id, {x} as y from {p}docs d left join {p}total t on d.review_id = t.review_id)"
    )
    return ctes


CTES: dict[str, str] = {
    "raw": RAW_REVIEWS_SQL.format(**DUCKDB_WORDS),
    "deduped": "select * exclude (copy) from (select *, row_number() over (partition by app_id, review_id, "
    "user_name, review_text, review_date order by app_name nulls first, rating nulls first, thumbs_up nulls first, "
    "app_version nulls first, reply_text nulls first) as copy from raw) where copy = 1",
    "usable": "select * from deduped where review_text is not null and rating is not null",
    "trimmed": f"select * replace (trim(regexp_replace(review_text, {quoted(SPACES)}, ' ', 'g')) as review_text) from usable",
    **sentiment_ctes("trimmed"),
    "releases": "select app_id, app_version, date_trunc('day', min(review_date))::timestamp as version_release_date "
    "from usable where app_version is not null group by app_id, app_version",
    "featured": "select t.*, cast(reply_text is not null as integer) as has_developer_reply, "
    "cast(year(review_date) as integer) as review_year, strftime(review_date, '%Y-%m') as review_month, "
    "strftime(date_trunc('week', review_date), '%Y-%m-%d') || '/' || strftime(date_trunc('week', review_date) + interval 6 day, '%Y-%m-%d') as review_week, "
    "year(review_date)::varchar || 'Q' || quarter(review_date)::varchar as review_quarter, "
    "cast(length(review_text) as integer) as review_length, "
    "cast(case when review_text = '' then 0 else len(string_split(review_text, ' ')) end as integer) as word_count, "
    f"{issue_case('lower(review_text)')} as issue_category, r.version_release_date, "
    "cast(greatest(0, date_diff('day', r.version_release_date, review_date)) as integer) as days0 "
    "from trimmed t left join releases r on t.app_id = r.app_id and t.app_version = r.app_version",
    # Cleaned reviews without sentiment, for the many queries that do not look at it.
    "tagged": "select * exclude (days0), case when version_release_date is null then null else days0 end as days_since_version_release, "
    "case when version_release_date is not null and days0 <= 14 then 1 else 0 end as is_post_release_window from featured",
    "cleaned": f"select t.*, s.sentiment_score, {label('s.sentiment_score')} as sentiment_label from tagged t join s_score s on t.review_id = s.review_id",
    "dim_app": "select cast(row_number() over (order by app_name, app_id) as integer) as app_key, app_id, app_name from "
    "(select distinct app_id, app_name from tagged)",
    "dim_app_version": "select cast(row_number() over (order by version_release_date nulls last, app_id, app_version nulls last) as integer) as version_key, * from "
    "(select distinct app_id, app_version, version_release_date from tagged)",
    "dim_date": "select date, cast(strftime(date, '%Y%m%d') as integer) as date_key, cast(year(date) as integer) as year, "
    "cast(month(date) as integer) as month, strftime(date, '%b %Y') as month_name, "
    "'Q' || quarter(date)::varchar || ' ' || year(date)::varchar as quarter, date_trunc('week', date)::timestamp as week_start "
    "from (select distinct date_trunc('day', review_date)::timestamp as date from tagged)",
    "dim_issue_category": "select * from (values "
    + ", ".join(f"({k}, {quoted(c)}, {quoted(d)})" for k, c, d in ISSUE_DIMENSION)
    + ") as i(issue_key, issue_category, issue_description)",
    "fact": "select c.*, a.app_key, v.version_key, i.issue_key, cast(strftime(review_date, '%Y%m%d') as integer) as date_key "
    "from cleaned c left join dim_app a on c.app_id = a.app_id "
    "left join dim_app_version v on c.app_id = v.app_id and c.app_version is not distinct from v.app_version "
    "left join dim_issue_category i on c.issue_category = i.issue_category",
}

RATING = "round(avg(rating), 2)"
SENTIMENT = "round(cast(sum(cast(sentiment_score as decimal(8,4))) as double) / count(*), 3)"


def compose(select: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with the CTEs it needs, directly or through others."""
    available = CTES | (extra or {})
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\b[a-z_0-9]+\b", text)) & available.keys():
            if name not in needed:
                needed.add(name)
                visit(available[name])

    visit(select)
    if not needed:
        return select
    body = ",\n".join(f"{name} as materialized ({sql})" for name, sql in available.items() if name in needed)
    return f"with {body}\n{select}"
