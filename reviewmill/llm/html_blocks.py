"""Text blocks of one page: a forgiving scan of the markup in time proportional to its length."""

from __future__ import annotations

import re
from html import unescape

# Elements that flow inside a line; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
# Elements that are never main text, and those that are not outside an article.
DROPPED = frozenset(
    "head nav footer aside form button select menu dialog template noscript svg object canvas audio video applet fieldset".split()
)
DROPPED_OUTSIDE = frozenset({"header"})
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
# Words in a class or id that mark boilerplate anywhere, and those that do outside an article.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr notice notices sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer comment comments commentlist discussion disqus reply replies respond share sharing "
    "social newsletter subscribe signup popup modal pagination pager".split()
)
NOISE_OUTSIDE = frozenset("header masthead banner related widget toolbar".split())
KEPT_WHOLE = frozenset({"html", "body", "article", "main"})
ITEM_PARENTS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr")}

ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
PART = re.compile(r"[a-z]+")
OUTSIDE, MAIN, ARTICLE = 0, 1, 2


class Scanner:
    """Finds tags. A quote that never closes is looked for once, so no input is scanned twice."""

    def __init__(self, html: str):
        self.html, self.unclosed = html, set()

    def tag_end(self, at: int) -> int:
        """Position of the > that ends the tag at ``at``, or -1."""
        html, inside = self.html, at
        while True:
            end = html.find(">", inside)
            if end < 0:
                return -1
            quote = self.open_quote(inside, end)
            if quote is None:
                return end
            mark, place = quote
            close = -1 if mark in self.unclosed else html.find(mark, place + 1)
            if close < 0:
                self.unclosed.add(mark)
                return end
            inside = close + 1
            if inside > end:
                continue

    def open_quote(self, start: int, end: int) -> tuple[str, int] | None:
        """The quote that opens an attribute value in [start, end) and is not closed there."""
        html, at = self.html, start
        while True:
            found = [p for p in (html.find('"', at, end), html.find("'", at, end)) if p >= 0]
            if not found:
                return None
            place = min(found)
            if not html[max(start, place - 8) : place].rstrip().endswith("="):
                at = place + 1
                continue
            close = html.find(html[place], place + 1, end)
            if close < 0:
                return html[place], place
            at = close + 1


def _is_noise(name: str, tag: str, region: int) -> bool:
    if name in DROPPED or (region != ARTICLE and name in DROPPED_OUTSIDE):
        return True
    if name in KEPT_WHOLE and name != "article" or "=" not in tag:
        return False
    for match in ATTRIBUTE.finditer(tag):
        key = match[1].lower()
        if key not in ("class", "id", "role"):
            continue
        words = set(PART.findall((match[2] or match[3] or match[4] or "").lower()))
        if key == "role":
            if words & DROPPED_ROLES:
                return True
        elif words & NOISE or (region != ARTICLE and words & NOISE_OUTSIDE):
            return True
    return False


def page_blocks(html: str) -> list[tuple[int, str]]:
    """(region, text) of every block that is not marked as boilerplate, in page order.

    Regions are the article element, the main element and the rest. White space in a block is one
    blank; character references are decoded; empty blocks are left out.
    """
    blocks: list[tuple[int, str]] = []
    stack: list[tuple[str, bool, int]] = []  # name, starts boilerplate, region before
    names: dict[str, int] = {}
    text: list[str] = []
    dropped, region = 0, OUTSIDE
    scanner, at = Scanner(html), 0

    def flush() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                blocks.append((region, line))
            text.clear()

    def pop() -> None:
        nonlocal dropped, region
        name, noisy, before = stack.pop()
        names[name] -= 1
        dropped -= noisy
        region = before

    while at < len(html):
        less = html.find("<", at)
        if less < 0:
            less = len(html)
        if less > at and not dropped:
            text.append(unescape(html[at:less]))
        if less + 1 >= len(html):
            if less + 1 == len(html) and not dropped:
                text.append("<")
            break
        mark = html[less + 1]
        if html.startswith("<!--", less):
            end = html.find("-->", less + 4)
            at = len(html) if end < 0 else end + 3
            continue
        if mark in "!?":
            end = html.find(">", less)
            at = len(html) if end < 0 else end + 1
            continue
        closing = mark == "/"
        match = NAME.match(html, less + 1 + closing)
        if not match:
            if closing:  # a broken end tag
                end = html.find(">", less)
                at = len(html) if end < 0 else end + 1
            else:
                if not dropped:
                    text.append("<")
                at = less + 1
            continue
        name = match[0].lower()
        end = scanner.tag_end(match.end())
        tag = html[match.end() : end if end >= 0 else len(html)]
        at = len(html) if end < 0 else end + 1
        if name not in INLINE:
            flush()
        if closing:
            if names.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in RAW:
            close = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, at)
            stop = -1 if close is None else html.find(">", close.end())
            at = len(html) if stop < 0 else stop + 1
            continue
        if name in VOID:
            continue
        if name not in INLINE and stack and stack[-1][0] == "p":
            pop()
        if name in ITEM_PARENTS and names.get(name):
            inner = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in (name, *ITEM_PARENTS[name]))
            if stack[inner][0] == name:
                while len(stack) > inner:
                    pop()
        noisy = _is_noise(name, tag, region)
        stack.append((name, noisy, region))
        names[name] = names.get(name, 0) + 1
        dropped += noisy
        if not dropped:
            if name == "article":
                region = ARTICLE
            elif region == OUTSIDE and (name == "main" or re.search(r"""role\s*=\s*["']?main\b""", tag)):
                region = MAIN
            if region != stack[-1][2]:
                blocks.append((region, ""))  # the region exists, even if it is empty
    if not dropped:
        flush()
    return blocks


def main_region(blocks: list[tuple[int, str]]) -> int:
    return max((region for region, _ in blocks), default=OUTSIDE)
