"""One query per operator over its whole table, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm.blob_ledger import Ledger, scan_versions, secret_report
from reviewmill.llm.common import read_table
from reviewmill.llm.decontaminate import benchmark_overlaps
from reviewmill.llm.divergence import LOWER, UPPER, source_divergence
from reviewmill.llm.html_text import extract_pages
from reviewmill.llm.mixing import cube_mix
from reviewmill.llm.periodicity import periodic_runs, run_report, with_planted_runs
from reviewmill.llm.pii import personal_spans
from reviewmill.llm.quality import score_quality
from reviewmill.llm.simhash import simhash_classes
from reviewmill.llm.topk import top_products
from reviewmill.llm.toxicity import score_toxicity
from reviewmill.llm.urls import judge_urls, rule_table
from reviewmill.llm.warc import round_trip
from reviewmill.staging import Stage

# The rules of the contract (action, host, path).
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_cube_mix(spark: SparkSession, folder: str) -> DataFrame:
    return cube_mix(read_table(spark, folder, "documents"), Stage(spark))


@query
def op2_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_classes(read_table(spark, folder, "documents"), Stage(spark), shingle_words=4, radius=4)


@query
def op3_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(read_table(spark, folder, "pages"), rule_table(spark, URL_RULES), Stage(spark))


@query
def op4_pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return personal_spans(read_table(spark, folder, "documents"), Stage(spark))


@query
def op5_spaced_seeds(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark_overlaps(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"), Stage(spark))


@query
def op6_norm_sorted_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(read_table(spark, folder, "embeddings"), Stage(spark), every=50, k=5, factor=256)


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), Stage(spark))


@query
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(read_table(spark, folder, "pages"), Stage(spark))


@query
def op9_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(read_table(spark, folder, "pages"))


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), Stage(spark))


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(read_table(spark, folder, "documents"), Stage(spark))


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_report(periodic_runs(with_planted_runs(read_table(spark, folder, "documents"))))


@query
def op13_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    stage = Stage(spark)
    return secret_report(scan_versions(read_table(spark, folder, "documents"), Ledger(spark, stage.path("ledger")), stage))


ORACLES["op6_norm_sorted_topk"] = """
with usable as (
  select vec_id, [cast(floor(256 * x::double) as bigint) for x in embedding] as v from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.v::double[], c.v::double[]) as bigint) as score
  from usable q join usable c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

_RULE_ROWS = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)
_FITTING = (
    "select {t}.{k} as k, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule, "
    "arg_max(action, length(rule_host || rule_path)) as action from {t} join rules "
    "on ({t}.host = rule_host or ends_with({t}.host, '.' || rule_host)) and starts_with({t}.path, rule_path) group by 1"
)
ORACLES["op3_url_verdicts"] = f"""
with recursive rules(action, rule_host, rule_path) as (values {_RULE_ROWS}),
named as (
  select page_id, html, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), parsed as (
  select page_id, html, lower(regexp_extract(rest, '^[^/?#]*')) as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
    lower(regexp_extract(rest, '^[^/?#]*')) || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as key from named
), tags as (
  select key, host, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?i)<(?:link|meta)\\s[^<>]*>')) as tag from parsed
), links as (
  select key, host, replace(case
    when regexp_matches(tag, '(?i)^<link.*\\srel\\s*=\\s*[''"]?canonical') then regexp_extract(tag, '(?i)\\shref\\s*=\\s*[''"]?([^''"\\s>]+)', 1)
    when regexp_matches(tag, '(?i)^<meta.*\\shttp-equiv\\s*=\\s*[''"]?refresh') then regexp_extract(tag, '(?i)url\\s*=\\s*[''"]?([^''"\\s>]+)', 1)
    end, '&amp;', '&') as href from tags
), edges as (
  select key as a, case when contains(href, '://') then lower(regexp_extract(substr(href, strpos(href, '://') + 3), '^[^/?#]*'))
    || regexp_extract(substr(href, strpos(href, '://') + 3), '^[^/?#]*([^#]*)', 1)
    when starts_with(href, '/') then host || regexp_extract(href, '^[^#]*') end as b from links where href <> ''
), pairs as (
  select a, b from edges where b is not null and a <> b union select b, a from edges where b is not null and a <> b
), reach(node, other) as (
  select a, a from pairs union select r.node, e.b from reach r join pairs e on r.other = e.a
), nodes as (
  select distinct node, regexp_extract(node, '^[^/?#]*') as host, regexp_extract(node, '^[^/?#]*([^?#]*)', 1) as path from reach
), node_rules as ({_FITTING.format(t="nodes", k="node")}
), carried as (
  select node, min(other) as alias_of, case when bool_or(action = 'allow') then 'allow' when bool_or(action = 'block') then 'block' end as verdict
  from reach left join node_rules on other = k group by node
), page_keys as (select distinct host || chr(0) || path as id, host, path from parsed
), page_rules as ({_FITTING.format(t="page_keys", k="id")})
select page_id, host, path, rule, coalesce(action, c.verdict, 'allow') as verdict, alias_of
from parsed left join page_rules on host || chr(0) || path = k left join carried c on c.node = key
"""

ORACLES["op8_warc"] = """
with payloads as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), digests as (
  select page_id, cast(octet_length(payload) as bigint) as payload_bytes, sha256(payload) as payload_digest from payloads
), firsts as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from digests
)
select page_id, payload_bytes, payload_digest,
  case when first <> page_id then 'revisit' else 'response' end as record_type,
  case when first <> page_id then first end as refers_to
from firsts
"""

ORACLES["op11_source_divergence"] = f"""
with docs as (
  select row_number() over () as doc, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents
), found as (
  select doc, lang, source,
    translate(unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), '{UPPER}', '{LOWER}') as term from docs
), kept as (
  select lang, term, count(*) as total from found group by lang, term having count(distinct doc) >= 10
), counts as (
  select lang, source, term, count(*) as n from found join kept using (lang, term) group by lang, source, term
), langs as (
  select lang, count(*) as v, sum(total) as used from kept group by lang
), groups as (
  select g.lang, g.source, coalesce(sum(n), 0) as used
  from (select distinct lang, source from docs) g left join counts c on c.lang = g.lang and c.source = g.source group by g.lang, g.source
), shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    cast(1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (g.used + 2 * l.v) as bigint) as p,
    cast(1 + 1000000000::hugeint * (k.total + 2) // (l.used + 2 * l.v) as bigint) as q
  from groups g join langs l on l.lang = g.lang join kept k on k.lang = g.lang
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(s.value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from shares where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from parts
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
