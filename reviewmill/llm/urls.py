"""URL verdicts: explicit rules, and block decisions carried over to redirect aliases.

Pages that name another address as their canonical one, or send the reader on to it, are the same
resource as that address. The aliases form components of a graph; a component with a blocked
member is blocked, unless a member is explicitly allowed. A page's own rule always stands.
Everything is built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm.common import once
from reviewmill.llm.components import connected_components
from reviewmill.operators.joins import broadcast_if_small
from reviewmill.staging import Stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINKS = r"(?i)canonical|http-equiv"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty for null and for texts without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _host(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def _path(rest: Column) -> Column:
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _key(rest: Column) -> Column:
    """Host, path and query: the name of a resource, whatever the scheme and fragment."""
    host = _host(rest)
    return F.concat(host, F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(action, rule_host, rule_path) from a list; larger sets come as a table of this shape."""
    return spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")


def with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path, ...) plus ``rule`` and ``action`` of the longest rule that fits.

    A rule fits its host and all subdomains where the path starts with the rule's. Every host is
    looked up under each of its parent domains, so cost does not grow with the number of rules.
    Of equally long rules the one with the longer host wins, then allow.
    """
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    text = F.concat("rule_host", "rule_path")
    rank = F.struct(
        F.length(text).alias("n"), F.length("rule_host").alias("h"), (F.col("action") == "allow").alias("allow"),
        text.alias("rule"), F.col("action").alias("action"),
    )
    fitting = (
        urls.select("host", "path").distinct().withColumn("rule_host", F.explode(parents))
        .join(broadcast_if_small(rules), "rule_host")
        .filter(F.startswith("path", F.col("rule_path")))
        .groupBy("host", "path").agg(F.max(rank).alias("best"))
        .select(F.col("host").alias("_host"), F.col("path").alias("_path"), "best.rule", "best.action")
    )
    same = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return urls.join(fitting, same, "left").drop("_host", "_path")


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    parts = [F.nullif(F.regexp_extract(tag, pattern, i), F.lit("")) for i in (1, 2, 3)]
    return F.trim(F.replace(F.coalesce(*parts), F.lit("&amp;"), F.lit("&")))


def _resolved(href: Column, host: Column, path: Column) -> Column:
    """Host, path and query of a link on a page; null for other schemes than those with ``://``."""
    folder = F.regexp_replace(path, r"[^/]*$", "")
    local = F.concat(host, F.when(folder == "", F.lit("/")).otherwise(folder), F.regexp_replace(href, r"^\./", ""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), _rest(href))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(F.startswith(href, F.lit("//")), F.substring(href, F.lit(3), F.length(href)))
        .when(F.startswith(href, F.lit("/")), F.concat(host, href))
        .when(href.rlike(r"^[?#]"), F.concat(host, path, href))
        .otherwise(local)
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(key, target): canonical links and refresh redirects found in the html of ``pages``."""
    plain = F.regexp_replace("html", r"(?s)<!--.*?-->", "")
    tags = F.regexp_extract_all(plain, F.lit(r"(?i)<(?:link|meta)\s[^<>]*>"), F.lit(0))
    tag = F.col("tag")
    canonical = tag.rlike(r"(?i)^<link") & F.coalesce(_attribute(tag, "rel"), F.lit("")).rlike(r"(?i)(^|\s)canonical(\s|$)")
    refresh = tag.rlike(r"(?i)^<meta") & (F.lower(F.coalesce(_attribute(tag, "http-equiv"), F.lit(""))) == "refresh")
    sent_to = F.nullif(F.regexp_extract(_attribute(tag, "content"), r"""(?i)url\s*=\s*['"]?([^'"\s]+)""", 1), F.lit(""))
    href = F.when(canonical, _attribute(tag, "href")).when(refresh, sent_to)
    found = pages.filter(F.col("html").rlike(LINKS)).select("key", "host", "path", F.explode(tags).alias("tag"))
    linked = found.select("key", "host", "path", once(href).alias("href")).filter("href is not null and href <> ''")
    target = _resolved(F.col("href"), F.col("host"), F.col("path"))
    reached = linked.select("key", once(target).alias("rest")).filter("rest is not null")
    return reached.select("key", _key(F.col("rest")).alias("target")).filter("key <> '' and target <> ''")


def judge_urls(pages: DataFrame, rules: DataFrame, stage: Stage, redirects: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_of), one row per row of ``pages``.

    ``verdict`` is the action of the page's own rule, else what its aliases decide, else ``default``.
    Aliases come from the html and, if given, from ``redirects`` (source_url, target_url); an alias need
    not be a page itself. ``alias_of`` is the smallest address of the page's component. Null urls and
    urls without ``://`` have an empty host and path, no rule and no alias; null html has no links;
    repeated rows are judged alike; other columns are ignored.
    """
    rest = F.col("rest")
    named = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), _rest(F.coalesce("url", F.lit(""))).alias("rest"), "html"
    ).select("page_id", _host(rest).alias("host"), _path(rest).alias("path"), _key(rest).alias("key"), "html")
    edges = alias_edges(named)
    if redirects is not None:
        more = redirects.select(_key(_rest(F.col("source_url"))).alias("key"), _key(_rest(F.col("target_url"))).alias("target"))
        edges = edges.unionByName(more.filter("key <> '' and target <> ''"))
    parts = stage.put(connected_components(stage.put(edges, "aliases"), "key", "target", stage), "components")
    members = parts.select("node", "component", _host(F.col("node")).alias("host"), _path(F.col("node")).alias("path"))
    ruled = with_rule(members, rules).groupBy("component").agg(
        F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked")
    )
    carried = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    known = parts.join(ruled, "component").select(F.col("node").alias("_node"), F.col("component").alias("alias_of"), carried.alias("carried"))
    known = broadcast_if_small(stage.put(known, "carried"))
    judged = with_rule(named.drop("html"), rules).join(known, F.col("key") == F.col("_node"), "left")
    verdict = F.coalesce("action", "carried", F.lit(default))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "alias_of")
