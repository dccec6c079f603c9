from __future__ import annotations

import random

import pytest

from reviewmill.llm import html_text as H
from reviewmill.llm.html_blocks import page_blocks

PAGES = "page_id bigint, url string, html string"


def text_of(html):
    return H.main_text(page_blocks(html), None)[0]


@pytest.mark.parametrize("html,expected", [
    ("", ""),
    ("plain", "plain"),
    ("<p>a  b\n c</p><p>d</p>", "a b c\nd"),
    ("<article><h1>T &amp; U</h1><p>x&lt;y &#233;&nbsp;z<br>w</article><p>after", "T & U\nx<y é z\nw"),
    ("<nav>n</nav><article>a<nav>m</nav><aside>s</aside><form>f</form><script>var x='</p>'</script><style>p{}</style></article><footer>f</footer>", "a"),
    ("<article><header><h1>Title</h1></header><p>b</p><div class='comments'><article>c</article></div><div id=ad-1>d</div></article>", "Title\nb"),
    ("<header>h</header><div class='site-header'>h</div><main><p>m</p></main><p>o</p>", "m"),
    ("<div role=\"navigation\">n</div><div class=cookie-notice>c</div><p>body</p>", "body"),
    ("<!-- <p>x</p> --><p>y<!-- z -->w</p><!doctype html><?php a ?>", "yw"),
    ("<article><p title='a>b'>q</p><p data-x=\"<p>\">r</p></article>", "q\nr"),
    ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb\nc\nd\n1\n2\n3"),
    ("<article><p class=ad>ad<p>text</article>", "text"),
    ("<article></article><p>outside</p>", ""),
    ("<article>a<b>b</b>c</i></article></article></p>", "abc"),
    ("<p>a < b && c <1> </ x>d", "a < b && c <1> d"),
    ("<p>cut <a href=\"x", "cut"),
    ("<article>cut &am", "cut &am"),
    ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ("<article><textarea>t</textarea><noscript>n</noscript><select><option>o</select>k</article>", "k"),
])
def test_blocks(html, expected):
    assert text_of(html) == expected


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b):
            diagonal, row[j + 1] = row[j + 1], diagonal + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_longest_common_subsequence(monkeypatch, limit):
    monkeypatch.setattr(H, "ROWS_BYTES", limit)
    draw = random.Random(4)
    for _ in range(1500):
        a, b = ([draw.randrange(5) for _ in range(draw.randint(0, 12))] for _ in range(2))
        found = H.common_positions(a, b)
        rest = iter(b)
        assert found == sorted(set(found)) and len(found) == lcs_length(a, b) and all(a[i] in rest for i in found)


def site():
    """Pages without an article element: a template around two lines of their own."""
    rows = []
    for host in ("a.com", "b.com"):
        for n in range(30):
            rows.append((f"http://{host}/p/{n:03d}", f"<div>Welcome to {host}</div><p>own {host} {n}</p><p>more {n}</p><div>All rights {host}</div>"))
    rows.append(("http://single.com/x", "<div>Top</div><p>only page</p>"))
    rows += [("http://copy.com/1", "<p>same</p>"), ("http://copy.com/2", "<p>same</p>")]
    rows += [("http://art.com/1", "<div>T</div><article><p>short</p><p>one</p></article>"), ("http://art.com/2", "<div>T</div><article><p>short</p><p>two</p></article>")]
    rows += [(None, "<p>null url</p>"), (None, None), ("no scheme", "<p>null url</p><p>x</p>"), ("http://z.com/", "")]
    return [(i, *r) for i, r in enumerate(rows)]


def expected(rows):
    out = {}
    for i, url, html in rows:
        if url and ("a.com" in url or "b.com" in url) and "art" not in url:
            n = int(url[-3:])
            out[i] = f"own {url.split('/')[2]} {n}\nmore {n}"
        elif url and "single" in url:
            out[i] = "Top\nonly page"
        elif url and "copy" in url:
            out[i] = "same"
        elif url and "art" in url:
            out[i] = "short\n" + ("one" if url.endswith("1") else "two")
    return out


@pytest.mark.parametrize("parts", [1, 8])
def test_neighbouring_pages_share_their_template(spark, parts):
    rows = site()
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' as host", "'y' as data", "1 as block").repartition(5)
    got = H.extract_pages(pages, parts).collect()
    assert sorted(r["page_id"] for r in got) == list(range(len(rows)))
    by_id = {r["page_id"]: r for r in got}
    for i, text in expected(rows).items():
        assert by_id[i]["text"] == text
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["url"] == rows[r["page_id"]][1]
    assert by_id[0]["n_shared"] == 2
    plain = {(r["page_id"], r["text"]) for r in H.extract_pages(spark.createDataFrame(rows, PAGES).coalesce(1), 3).collect()}
    assert plain == {(r["page_id"], r["text"]) for r in got}


def test_repeats_null_ids_and_long_pages(spark):
    long = "<article>" + "".join(f"<p>line {i % 50}</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "http://a/1", "<article>x</article>")] * 3 + [(None, "http://a/2", "<article>y</article>"), (2, "http://a/3", long), (3, "http://a/4", long)]
    got = H.extract_pages(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(r["text"][:1] for r in got) == ["l", "l", "x", "x", "x", "y"]
    assert {len(r["text"].split("\n")) for r in got if r["text"].startswith("line")} == {20_000}
    assert H.extract_pages(spark.createDataFrame([], PAGES)).count() == 0
