from __future__ import annotations

import pytest

from reviewmill.llm.queries import URL_RULES
from reviewmill.llm.urls import judge_urls, rule_table

PAGES = "page_id bigint, url string, html string"


def canonical(href):
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


@pytest.fixture()
def judge(spark, stage):
    def run(rows, rules=URL_RULES, redirects=None):
        pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PAGES).selectExpr("*", "'x' as rule", "'y' as key", "1 as rest")
        out = judge_urls(pages, rule_table(spark, rules), stage, redirects).collect()
        return {r["page_id"]: r for r in out}

    return run


def test_rules(judge):
    urls = {
        "http://Blog.Example.ORG/es/1?x=1": ("blog.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/123#top": ("example.org", "/en/123", "example.org/en/1", "block"),
        "https://example.org/en/23": ("example.org", "/en/23", "org/", "allow"),
        "https://notexample.org/es/1": ("notexample.org", "/es/1", "org/", "allow"),
        "http://a.com/fr/": ("a.com", "/fr/", "com/fr/", "allow"),
        "http://a.com/de/x": ("a.com", "/de/x", "com/de/", "block"),
        "http://a.com/DE/x": ("a.com", "/DE/x", None, "allow"),
        "http://com/de/": ("com", "/de/", "com/de/", "block"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://x.org?a/b": ("x.org", "", None, "allow"),
        "http://ÄB.org/": ("Äb.org", "/", "org/", "allow"),
        "a://b://c.com/de/": ("b:", "//c.com/de/", None, "allow"),
        "x.org/es/": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    got = judge([(u, None) for u in urls])
    for i, expected in enumerate(urls.values()):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == expected


def test_longest_rule_and_ties(judge):
    rules = [("block", "b.com", "/"), ("allow", "com", "/ab"), ("block", "com", "/ab"), ("block", "a.b.com", "/x"), ("allow", "b.com", "/x/y")]
    got = judge([("http://b.com/abc", None), ("http://a.b.com/x/y", None), ("http://c.com/abc", None)], rules)
    assert [got[i]["rule"] for i in range(3)] == ["b.com/", "a.b.com/x", "com/ab"]
    assert [got[i]["verdict"] for i in range(3)] == ["block", "block", "allow"]


def test_aliases(judge, spark):
    rows = [
        ("http://a.net/1", canonical("https://bad.com/de/1")),       # blocked target, itself no page
        ("http://b.net/2", canonical("http://a.net/1#part")),        # two steps away
        ("http://c.net/3", '<META http-equiv="Refresh" content="0; url=/4">'),
        ("http://c.net/4", "<link href='//a.net/1' rel='alternate CANONICAL'>"),
        ("http://good.com/fr/5", canonical("http://bad.com/de/1")),  # own rule stands and frees the component
        ("http://d.net/6", "<!-- " + canonical("http://x.com/de/") + " -->"),
        ("http://e.net/7", canonical("mailto:x@y.z") + canonical("") + "<link rel=canonical>"),
        ("http://f.net/8/", canonical("9?q=1&amp;p=2")),
        ("http://f.net/8/9?q=1&p=2", canonical("http://z.com/de/")),
        ("http://g.net/g", None),
    ]
    got = judge(rows)
    assert [got[i]["verdict"] for i in range(10)] == ["allow"] * 5 + ["allow", "allow", "block", "block", "allow"]
    assert got[2]["alias_of"] == got[0]["alias_of"] and got[5]["alias_of"] is None
    without = judge(rows[:4] + rows[5:])
    assert [without[i]["verdict"] for i in range(4)] == ["block"] * 4
    more = spark.createDataFrame([("http://g.net/g", "http://q.com/de/"), (None, "x"), ("http://g.net/g", None)], "source_url string, target_url string")
    assert judge(rows, redirects=more)[9]["verdict"] == "block"


def test_hub_and_repeats(judge):
    rows = [(f"http://h{i}.net/", canonical("http://hub.com/de/")) for i in range(60)]
    got = judge(rows + rows[:5])
    assert {r["verdict"] for r in got.values()} == {"block"}
    assert len(got) == 65


def test_empty(judge):
    assert judge([]) == {}
