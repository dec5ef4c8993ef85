"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page becomes a flat list of text blocks. A block's features are its words and link density, those of its neighbours,
whether it stands in a container that is named as content or as something else (menu, footer, advert, comments ...),
how much of the page's text stands in content containers, and whether it is a heading. A decision tree, trained on the small
labelled table below, keeps or drops each block.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page
order by a newline. Nothing else is changed or cut.

Edge cases: null, empty or text-free html gives an empty text; unclosed tags end with their container or the page;
markup that isn't HTML is text; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import fresh, quoted

# Elements by their role in HTML, and words of class and id names.
DROPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "math", "select", "textarea", "button", "title", "head", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NOT_CONTENT = {"nav", "footer", "aside", "form", "menu", "dialog"}
CONTENT = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
NOT_CONTENT_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr legal login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split())
CONTENT_WORDS = set("article articlebody content entry main mainbody post postbody story".split())
WRAPPER_WORDS = {"wrap", "wrapper", "container", "layout", "inner", "outer"}
LAYOUT_WORDS = {"has", "with", "without", "no", "category", "tag"}  # first words of names that tell of something else on the page
ROLES = {"main": 1, "article": 1, "navigation": -1, "banner": -1, "contentinfo": -1, "complementary": -1, "search": -1, "form": -1, "dialog": -1, "alert": -1}

FEATURES = ["zone", "page_in_elements", "page_in_content", "heading", "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after"]

# The labelled table: pages as lists of blocks in order. A block is (zone, heading, words, words in links, label);
# zone 1: in a content element or role, 0.5: in a container that only its class or id names as content, -1: in a container
# named otherwise, 0: neither.
LABELLED = [
    [(-1, 0, 6, 6, 0), (-1, 0, 12, 0, 0), (1, 1, 9, 0, 1), (1, 0, 80, 2, 1), (1, 0, 1, 0, 1), (1, 0, 40, 0, 1), (-1, 0, 14, 1, 0)],
    [(-1, 0, 1, 1, 0), (-1, 0, 1, 1, 0), (0, 0, 9, 0, 0), (1, 1, 5, 0, 1), (1, 0, 3, 0, 1), (1, 0, 3, 3, 1), (1, 0, 120, 8, 1), (-1, 0, 60, 0, 0), (-1, 0, 20, 1, 0)],
    [(0, 0, 30, 0, 0), (1, 0, 2, 0, 1), (1, 0, 4, 4, 1), (1, 0, 55, 0, 1), (1, 0, 2, 0, 1), (0, 0, 45, 0, 0), (0, 0, 8, 8, 0)],
    [(1, 1, 6, 0, 1), (1, 0, 25, 25, 1), (1, 0, 8, 0, 1), (-1, 0, 150, 0, 0), (-1, 0, 35, 2, 0), (-1, 1, 3, 0, 0), (0, 1, 4, 0, 0)],
    [(-1, 0, 40, 0, 0), (-1, 1, 2, 0, 0), (1, 0, 15, 0, 1), (1, 0, 90, 0, 1), (-1, 0, 25, 25, 0), (1, 0, 30, 1, 1), (0, 0, 70, 3, 0)],
    [(0, 0, 5, 5, 0), (0, 0, 7, 6, 0), (0, 1, 8, 0, 1), (0, 0, 60, 2, 1), (0, 0, 45, 0, 1), (0, 0, 12, 1, 1), (0, 0, 80, 0, 1), (0, 0, 6, 5, 0), (0, 0, 9, 9, 0)],
    [(-1, 0, 8, 8, 0), (0, 1, 6, 0, 1), (0, 0, 25, 0, 1), (0, 0, 4, 0, 1), (0, 0, 70, 4, 1), (0, 0, 30, 1, 1), (-1, 0, 18, 2, 0)],
    [(0, 0, 3, 3, 0), (0, 0, 2, 2, 0), (0, 0, 4, 4, 0), (0, 1, 7, 0, 1), (0, 0, 35, 0, 1), (0, 0, 90, 3, 1), (0, 0, 20, 0, 1), (0, 0, 5, 4, 0), (0, 0, 3, 3, 0)],
    [(0, 0, 16, 15, 0), (0, 0, 22, 0, 1), (0, 0, 50, 0, 1), (0, 0, 18, 17, 0), (0, 0, 10, 10, 0), (-1, 0, 12, 0, 0)],
    [(0, 0, 40, 0, 1)],
    [(0, 0, 3, 0, 1)],
    [(1, 0, 1, 0, 1)],
    [(1, 1, 3, 0, 1), (1, 0, 1, 0, 1), (1, 0, 4, 0, 1), (1, 0, 1, 1, 1), (1, 0, 2, 2, 1), (1, 0, 3, 0, 1), (1, 0, 2, 0, 1)],
    [(1, 1, 1, 0, 1), (1, 0, 5, 5, 1), (1, 0, 9, 6, 1), (1, 0, 1, 0, 1), (1, 0, 200, 0, 1), (1, 0, 2, 0, 1), (-1, 0, 1, 0, 0)],
    [(-1, 0, 1, 1, 0), (1, 1, 2, 0, 1), (1, 0, 1, 0, 1), (1, 0, 4, 0, 1), (-1, 0, 1, 0, 0)],
    [(-1, 0, 1, 1, 0), (1, 0, 1, 0, 1), (-1, 0, 7, 0, 0), (1, 0, 3, 0, 1), (1, 0, 8, 4, 1), (-1, 0, 2, 2, 0), (-1, 0, 90, 0, 0)],
    [(0, 0, 4, 0, 0), (1, 1, 6, 6, 1), (1, 0, 2, 0, 1), (1, 0, 7, 0, 1), (1, 0, 6, 0, 1), (0, 0, 60, 0, 0), (0, 0, 3, 0, 0)],
    [(0, 1, 3, 0, 0), (0, 0, 120, 2, 0), (1, 0, 10, 0, 1), (1, 0, 11, 1, 1), (1, 0, 5, 0, 1), (0, 0, 11, 0, 0), (0, 0, 12, 1, 0)],
    [(-1, 0, 5, 0, 0), (-1, 0, 6, 0, 0), (1, 1, 4, 0, 1), (1, 0, 6, 3, 1), (1, 0, 9, 0, 1), (1, 0, 8, 0, 1), (0, 0, 25, 0, 0)],
    [(0, 0, 14, 0, 0), (0, 0, 50, 0, 0), (0, 0, 40, 1, 0), (1, 0, 60, 1, 1), (1, 0, 2, 0, 1), (0, 0, 45, 1, 0), (0, 0, 80, 0, 0), (0, 0, 30, 0, 0)],
    [(0, 0, 7, 0, 0), (1, 1, 4, 0, 1), (1, 0, 20, 0, 1), (1, 0, 18, 9, 1), (0, 0, 20, 0, 0), (0, 0, 60, 4, 0), (0, 0, 70, 0, 0), (0, 0, 24, 0, 0), (0, 0, 16, 0, 0)],
    [(0, 0, 22, 0, 0), (0, 0, 33, 0, 0), (0, 0, 5, 0, 0), (0, 0, 28, 0, 0), (1, 0, 90, 0, 1), (0, 0, 3, 0, 0), (0, 0, 55, 0, 0)],
    [(0, 0, 90, 2, 0), (0, 0, 44, 0, 0), (1, 0, 12, 0, 1), (1, 0, 3, 3, 1), (0, 0, 100, 0, 0), (0, 0, 8, 0, 0), (0, 0, 35, 0, 0)],
    [(0, 0, 1, 0, 0), (0, 0, 4, 4, 0), (0, 0, 3, 3, 0), (0, 1, 6, 0, 1), (0, 0, 50, 2, 1), (0, 0, 14, 5, 1), (0, 0, 44, 0, 1), (0, 0, 2, 0, 0), (0, 0, 5, 5, 0), (0, 0, 1, 0, 0), (0, 0, 2, 2, 0)],
    [(0, 0, 2, 0, 0), (0, 0, 6, 6, 0), (0, 0, 65, 1, 1), (0, 0, 20, 6, 1), (0, 0, 38, 0, 1), (0, 0, 10, 3, 1), (0, 0, 70, 0, 1), (0, 0, 1, 0, 0), (0, 0, 3, 3, 0), (0, 0, 2, 0, 0), (0, 0, 4, 4, 0)],
    [(0, 0, 3, 3, 0), (0, 0, 1, 0, 0), (0, 0, 3, 3, 0), (0, 1, 8, 0, 1), (0, 0, 33, 0, 1), (0, 0, 16, 4, 1), (0, 0, 52, 1, 1), (0, 0, 9, 9, 0), (0, 0, 2, 0, 0), (0, 0, 7, 7, 0)],
    [(0, 0, 3, 3, 0), (0, 0, 3, 2, 0), (0, 1, 3, 0, 1), (0, 0, 40, 0, 1), (0, 0, 40, 1, 1), (0, 0, 2, 2, 0)],
    [(0, 0, 1, 1, 0), (0, 1, 5, 0, 1), (0, 0, 30, 2, 1), (0, 0, 3, 0, 1), (0, 0, 26, 0, 1), (0, 0, 4, 4, 0), (0, 0, 2, 2, 0)],
    [(-1, 0, 50, 0, 0), (-1, 0, 4, 4, 0), (0, 0, 28, 1, 1), (0, 0, 33, 0, 1), (-1, 0, 9, 0, 0)],
    [(0, 0, 3, 3, 0), (0, 0, 2, 2, 0), (1, 1, 7, 0, 1), (0, 0, 60, 1, 1), (0, 0, 45, 0, 1), (0, 0, 80, 2, 1), (0, 0, 6, 5, 0), (0, 0, 3, 3, 0)],
    [(-1, 0, 6, 6, 0), (1, 1, 5, 0, 1), (1, 0, 4, 1, 1), (0, 0, 90, 0, 1), (0, 0, 30, 0, 1), (0, 0, 120, 3, 1), (0, 0, 40, 1, 1), (-1, 0, 14, 1, 0)],
    [(0, 0, 8, 8, 0), (1, 1, 9, 0, 1), (1, 0, 3, 0, 1), (0, 0, 35, 0, 1), (0, 1, 4, 0, 1), (0, 0, 70, 2, 1), (0, 0, 55, 0, 1), (0, 0, 5, 5, 0), (0, 0, 2, 2, 0)],
    [(1, 1, 6, 6, 1), (0, 0, 200, 4, 1), (0, 0, 150, 0, 1), (-1, 0, 30, 2, 0), (0, 0, 4, 4, 0)],
    [(-1, 0, 6, 6, 0), (0.5, 1, 5, 0, 1), (0.5, 0, 4, 1, 1), (0, 0, 90, 0, 1), (0, 0, 30, 0, 1), (0, 0, 40, 1, 1), (0, 0, 3, 3, 0)],
    [(0, 0, 2, 2, 0), (0.5, 1, 7, 0, 1), (0.5, 0, 30, 0, 1), (0, 0, 80, 1, 1), (0, 0, 25, 0, 1), (0, 0, 120, 0, 1), (0, 0, 60, 2, 1), (0, 0, 4, 4, 0)],
    [(0, 0, 3, 3, 0), (0.5, 1, 5, 0, 1), (0.5, 0, 40, 0, 1), (0, 0, 45, 0, 1), (0, 1, 4, 0, 1), (0, 0, 60, 0, 1), (0, 0, 30, 3, 1), (0, 0, 5, 5, 0)],
    [(0, 0, 4, 4, 0), (0.5, 0, 60, 0, 1), (0, 0, 70, 0, 1), (0, 0, 9, 0, 1), (0, 0, 61, 1, 1), (-1, 0, 20, 0, 0), (0, 0, 6, 5, 0)],
    [(0, 0, 5, 5, 0), (0.5, 1, 6, 0, 1), (0.5, 0, 80, 2, 1), (0.5, 0, 3, 0, 1), (0.5, 0, 40, 0, 1), (0, 0, 60, 0, 0), (0, 0, 9, 3, 0)],
    [(-1, 0, 9, 0, 0), (0.5, 0, 15, 0, 1), (0.5, 0, 90, 1, 1), (0.5, 0, 2, 2, 1), (0, 0, 30, 0, 0), (0, 0, 70, 1, 0), (0, 0, 2, 2, 0)],
    [(0, 0, 12, 0, 0), (0.5, 1, 4, 0, 1), (0.5, 0, 200, 4, 1), (0.5, 0, 1, 0, 1), (0, 0, 45, 0, 0), (0, 1, 3, 0, 0), (0, 0, 8, 8, 0)],
    [(0, 0, 2, 2, 0), (0.5, 1, 2, 0, 1), (0, 0, 62, 0, 1), (0, 0, 58, 1, 1), (0, 0, 2, 2, 0)],
    [(0.5, 1, 1, 0, 1), (0, 0, 40, 0, 1), (0, 0, 8, 0, 1), (0, 0, 90, 2, 1), (0, 0, 35, 0, 1), (0, 0, 1, 1, 0)],
    [(0, 0, 1, 1, 0), (0, 0, 2, 2, 0), (0, 1, 2, 0, 1), (0, 0, 75, 0, 1), (0, 0, 12, 0, 1), (0, 0, 30, 1, 1), (0, 0, 10, 0, 1), (0, 0, 3, 3, 0), (0, 0, 1, 1, 0)],
    [(0.5, 1, 3, 0, 1), (0, 0, 300, 3, 1), (0, 0, 4, 4, 0)],
    [(0.5, 1, 4, 0, 1), (0, 0, 7, 0, 1), (0, 0, 11, 0, 1)],
    [(0, 0, 55, 0, 1), (0, 0, 70, 0, 1)],
    [(0, 0, 110, 1, 1), (0, 0, 5, 0, 1), (0, 0, 45, 0, 1), (0, 0, 9, 9, 0)],
    [(0, 0, 4, 4, 0), (0, 0, 50, 0, 1), (0, 0, 6, 0, 1), (0, 0, 6, 0, 1), (0, 0, 64, 2, 1), (0, 0, 2, 2, 0)],
    [(0, 0, 7, 0, 0), (0.5, 0, 30, 0, 1), (0.5, 0, 5, 0, 1), (0, 0, 22, 0, 0), (0, 0, 2, 2, 0)],
    [(0, 0, 3, 0, 0), (0.5, 1, 1, 0, 1), (0.5, 0, 60, 0, 1), (0.5, 0, 60, 0, 1), (0.5, 0, 1, 0, 1), (0, 0, 60, 0, 0)],
    [(-1, 0, 3, 0, 0), (0.5, 0, 4, 0, 1), (0.5, 0, 12, 0, 1), (-1, 0, 50, 0, 0), (0, 0, 5, 0, 0)],
    [(0, 0, 1, 1, 0), (0.5, 1, 2, 0, 1), (0.5, 0, 25, 0, 1), (0, 0, 95, 0, 1), (0, 0, 8, 0, 1), (0, 0, 40, 0, 1), (0, 0, 2, 2, 0)],
]


def _names(attrs: dict[str, str | None]) -> set[str]:
    """Words of an element's class and id names, without names of the page's layout; a wrapper of content and more is neither."""
    out: set[str] = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if len(words) > 1 and words[0] in LAYOUT_WORDS or words and words[-1] in WRAPPER_WORDS and CONTENT_WORDS & set(words) and NOT_CONTENT_WORDS & set(words):
            continue
        out.update(words)
    return out


def _hidden(attrs: dict[str, str | None]) -> bool:
    style = (attrs.get("style") or "").replace(" ", "").lower()
    return "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or "display:none" in style or "visibility:hidden" in style


class Blocks(HTMLParser):
    """Flat text blocks of a page: (text, words, words in links, zone, heading)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, float, int]] = []
        self.open: list[tuple[str, float, bool, bool]] = []  # tag, zone, dropped, whether the zone comes from a name alone
        self.text: list[str] = []
        self.linked: list[str] = []
        self.links = self.dropped = self.good = self.fair = self.bad = self.headings = 0
        self.articles = 0  # that stand in no other content element
        self.carded: list[bool] = []  # which blocks stand in these

    def parse_html_declaration(self, i: int) -> int:
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def flush(self) -> None:
        words = "".join(self.text).split()
        if words:
            zone = -1 if self.bad else 1 if self.good else 0.5 if self.fair else 0
            self.blocks.append((" ".join(words), len(words), min(len(words), len("".join(self.linked).split())), zone, int(self.headings > 0)))
            self.carded.append(self.good == 1 and any(o[0] == "article" and o[1] == 1 for o in self.open))
        self.text, self.linked = [], []

    def _push(self, tag: str, zone: float, drop: bool, named: bool = False) -> None:
        self.open.append((tag, zone, drop, named))
        self.good += zone == 1
        self.fair += zone == 0.5
        self.bad += zone == -1
        self.dropped += drop
        self.headings += tag in HEADINGS

    def _pop(self) -> None:
        tag, zone, drop, _ = self.open.pop()
        self.good -= zone == 1
        self.fair -= zone == 0.5
        self.bad -= zone == -1
        self.dropped -= drop
        self.headings -= tag in HEADINGS

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.text.append(" " if tag in ("br", "hr") else "")
            if tag == "hr":
                self.flush()
            return
        if tag == "a":
            self.links += 1
        if tag not in BLOCKS and tag not in DROPPED:
            if _hidden(dict(attrs)) or any(o[0] == tag for o in self.open):
                self._push(tag, 0, _hidden(dict(attrs)))  # an inline element; its like inside of it are counted
            return
        if tag in BLOCKS:
            self.flush()
            if self.open and self.open[-1][0] == "p":
                self._pop()
            while self.open and self.open[-1][0] in CLOSES.get(tag, ()):
                self._pop()
        drop, zone, named, main = tag in DROPPED, 0, False, tag == "main"
        if tag in CONTENT:
            zone = 1
        elif tag in NOT_CONTENT or tag == "header" and not self.good and not self.fair:
            zone = -1
        if attrs and tag not in ("body", "html"):
            found = dict(attrs)
            drop |= _hidden(found)
            names = _names(found)
            role = ROLES.get((found.get("role") or "").lower(), 0)
            main |= (found.get("role") or "").lower() == "main"
            if role < 0:
                zone = -1
            elif names & NOT_CONTENT_WORDS and not main:
                if tag != "article":
                    named = zone >= 0
                    zone = -1
                elif not names & CONTENT_WORDS:
                    zone = 0
            elif not zone and (role > 0 or names & CONTENT_WORDS):
                zone = 1 if role > 0 else 0.5
        if main:  # what holds the main part is a wrapper, whatever its name
            for i, (t, z, d, by_name) in enumerate(self.open):
                if by_name:
                    self.open[i] = (t, 0, d, False)
                    self.bad -= z == -1
        self.articles += tag == "article" and zone == 1 and not self.good
        self._push(tag, zone, drop, named)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash closes nothing but void elements, which aren't opened

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.flush()
        if tag in BLOCKS or tag in DROPPED or any(o[0] == tag for o in self.open):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    while len(self.open) > i:
                        self._pop()
                    break

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)
            if self.links:
                self.linked.append(data + " ")


def page_blocks(html: str | None) -> list[tuple[str, int, int, float, int]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    blocks = parser.blocks
    plain = [(w - k) * (z >= 0) for _, w, k, z, _ in blocks]
    if parser.articles > 1 and 2 * sum(n for n, c in zip(plain, parser.carded, strict=True) if c) < sum(plain):
        # several articles that together hold less text than the rest of the page are teasers: being in one says nothing
        blocks = [(t, w, k, 0 if c else z, h) for (t, w, k, z, h), c in zip(blocks, parser.carded, strict=True)]
    return blocks


def block_features(blocks: list[tuple[float, int, int, int]]) -> np.ndarray:
    """Feature rows of one page's blocks, given as (zone, heading, words, words in links)."""
    b = np.array(blocks, float).reshape(-1, 4)
    density = b[:, 3] / np.maximum(b[:, 2], 1)
    before, after = lambda x: np.r_[0.0, x[:-1]], lambda x: np.r_[x[1:], 0.0]
    plain = (b[:, 2] - b[:, 3]) * (b[:, 1] == 0)  # words of text that are neither links nor headings
    total = max(plain[b[:, 0] >= 0].sum(), 1)
    elements, content = (np.full(len(b), plain[at].sum() / total) for at in (b[:, 0] == 1, b[:, 0] > 0))
    return np.stack([b[:, 0], elements, content, b[:, 1], b[:, 2], density, before(b[:, 2]), before(density), after(b[:, 2]), after(density)], 1)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 6) -> tuple:
    """A tree (feature, threshold, left, right) with shares of label 1 at the leaves; splits lower the Gini impurity most."""
    share = float(y.mean())
    best = (1e-9, None, None)
    if depth and 0 < share < 1:
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, j] <= cut
                n, m = left.sum(), (~left).sum()
                p, q = y[left].mean(), y[~left].mean()
                gain = share * (1 - share) - (n * p * (1 - p) + m * q * (1 - q)) / len(y)
                if gain > best[0] + 1e-12:
                    best = (gain, j, cut)
    if best[1] is None:
        return (share,)
    left = x[:, best[1]] <= best[2]
    return (best[1], best[2], train_tree(x[left], y[left], depth - 1), train_tree(x[~left], y[~left], depth - 1))


def tree_share(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    return np.where(x[:, tree[0]] <= tree[1], tree_share(tree[2], x), tree_share(tree[3], x))


def default_tree() -> tuple:
    """The tree of the labelled table."""
    x = np.concatenate([block_features([b[:4] for b in page]) for page in LABELLED])
    return train_tree(x, np.array([b[4] for page in LABELLED for b in page], float))


def main_text(html: str | None, tree: tuple) -> tuple[str, int, int]:
    """Text of the kept blocks, number of blocks and of kept blocks."""
    blocks = page_blocks(html)
    if not blocks:
        return "", 0, 0
    keep = tree_share(tree, block_features([(zone, heading, words, linked) for _, words, linked, zone, heading in blocks])) >= 0.5
    kept = [b[0] for b, k in zip(blocks, keep, strict=True) if k]
    return "\n".join(kept), len(blocks), len(kept)


def extract(pages: DataFrame, html_col: str = "html", tree: tuple | None = None) -> DataFrame:
    """``pages`` without the html (and without columns of the new names), with ``text``, ``n_chars``, ``n_blocks`` and ``n_kept``."""
    tree = tree or default_tree()

    @F.pandas_udf("text string, n_chars long, n_blocks int, n_kept int")
    def found(html: pd.Series) -> pd.DataFrame:
        rows = [main_text(h, tree) for h in html]
        return pd.DataFrame([(text, len(text), n, kept) for text, n, kept in rows], columns=["text", "n_chars", "n_blocks", "n_kept"])

    new = ["text", "n_chars", "n_blocks", "n_kept"]
    others = [c for c in pages.columns if c != html_col and c not in new]
    name = fresh("_found", pages.columns)
    return pages.select(*quoted(others), found(F.col(html_col)).alias(name)).select(*quoted(others), *[F.col(f"{name}.{c}").alias(c) for c in new])
