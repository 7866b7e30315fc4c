"""Operator 2, main text of web pages by text-to-tag ratio.

The standard library's parser streams events over the page. Each block becomes
a line with its text and its number of tags; the ratio of the two is smoothed
by a Gaussian over neighbouring lines, and lines above the threshold (the
standard deviation of the smoothed ratios) form the content clusters. The
containers that hold such lines are the content regions: all their lines stay,
short ones too, except what lies in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or reader comments.

Cases: null or empty html and pages without content give an empty text; unclosed
elements end with the element around them; the longest page is held by one task
alone; rows that repeat a page are extracted one by one; other columns are not
passed on.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_batches

#: Elements whose whole content is never main text.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form menu dialog button select option textarea input label fieldset svg canvas iframe object embed audio video map datalist".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stay inside the line of the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
#: Elements that may be a content region.
REGIONS = frozenset("article main section div td body html blockquote center".split())
#: Words in class, id or role of elements beside the article.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs "
    "sidebar sidebars aside rail complementary footer foot header masthead contentinfo comment comments commentlist replies reply discussion disqus notice notices alert cookie cookies consent gdpr "
    "popup modal overlay dialog newsletter subscribe subscription signup login search share sharing social related recommended recommendations pagination pager toolbar widget skip".split()
)
#: Such words that also name the head of an article when they stand inside one.
HEAD_WORDS = frozenset(["header"])
#: Words that may stand beside those without changing what an element is.
NEUTRAL_WORDS = frozenset(
    "a an the of and my user users reader readers visitor page site web main global primary secondary top bottom left right center upper lower first last box list area section container wrapper wrap "
    "bar item items block body inner outer unit slot panel pane group row col column content holder module text post article blog fixed sticky floating mobile desktop js x px thread form icon icons link links buttons button".split()
)
#: What a head holds; anything else ends a head that is left open.
HEAD_CONTENT = frozenset("base basefont bgsound link meta title script style noscript template".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset(
    "p address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol pre search section table ul".split()
)
#: For a start tag: the open elements that it ends, and those beyond which it ends none.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    **dict.fromkeys(("dt", "dd"), (frozenset("dt dd".split()), frozenset(["dl"]))),
    "option": (frozenset(["option"]), frozenset("select datalist".split())),
    **dict.fromkeys(("td", "th"), (frozenset("td th".split()), frozenset("tr table".split()))),
    "tr": (frozenset("td th tr".split()), frozenset(["table"])),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset("td th tr tbody thead tfoot".split()), frozenset(["table"]))),
}
#: Elements that end a dropped one whose end tag is missing, if no article follows in it.
ENDS_DROPPED = REGIONS | frozenset("p h1 h2 h3 h4 h5 h6 table pre".split())
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SIGMA, _RADIUS = 1.0, 2
_KERNEL = np.array([math.exp(-(i * i) / (2 * _SIGMA * _SIGMA)) for i in range(-_RADIUS, _RADIUS + 1)])


@dataclass
class Line:
    region: int
    article: int
    tags: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links
    text: str = ""


@dataclass
class Region:
    parent: int
    tag: str
    classes: frozenset[str]

    def like(self, other: Region) -> bool:
        return self.tag == other.tag and (self.classes == other.classes or bool(self.classes & other.classes))


@dataclass
class Element:
    tag: str
    dropped: bool
    region: int
    article: int
    link: bool
    number: int = 0  # place of its start tag in the page
    outermost: bool = False  # dropped, and not inside another dropped element
    holds_article: bool = False


def _is_article(tag: str, attrs: list) -> bool:
    return tag in ("article", "main") or ("role", "main") in attrs


def _is_beside(tag: str, attrs: list, in_article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    for name, value in attrs:
        if name in ("class", "id", "role") and value and tag not in ("html", "body"):
            for one in value.split():
                words = {w.lower() for w in _TOKENS.findall(one) if not w.isdigit()}
                beside = words & ASIDE_WORDS
                if (beside - HEAD_WORDS if in_article else beside) and words <= ASIDE_WORDS | NEUTRAL_WORDS:
                    return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


class LineReader(HTMLParser):
    """Turns parser events into lines.

    ``unclosed`` tells, for dropped elements whose end tag is missing, whether an
    article starts in them; a second reader that is told ends them there, or at
    the next block."""

    def __init__(self, ending: dict[int, bool] | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.ending = ending or {}
        self.unclosed: dict[int, bool] = {}
        self.tags = 0
        self.stack = [Element("", False, 0, 0, False)]
        self.lines: list[Line] = []
        self.line = Line(0, 0)
        self.regions = [Region(-1, "", frozenset())]
        self.articles = 0

    def _break(self) -> None:
        if self.line.parts:
            self.lines.append(self.line)
        top = self.stack[-1]
        self.line = Line(top.region, top.article)

    def _cut(self, at: int, closed: bool = False) -> None:
        """End the open elements from ``at`` on; ``closed``: the first by its own end tag."""
        for e in self.stack[at + closed :]:
            if e.outermost and e.tag not in ("head", "p") and e.tag not in IMPLIED:
                self.unclosed[e.number] = e.holds_article
        del self.stack[at:]

    def _end_implied(self, tag: str, attrs: list) -> None:
        """End what a start tag ends without an end tag."""
        size = len(self.stack)
        if tag == "body" or self.stack[-1].tag == "head" and tag not in HEAD_CONTENT:
            self._cut(next((i for i, e in enumerate(self.stack) if e.tag == "head"), size))
        if self.ending:
            article = _is_article(tag, attrs)
            at = next((i for i, e in enumerate(self.stack) if e.number in self.ending and (article if self.ending[e.number] else tag in ENDS_DROPPED)), None)
            if at is not None:
                self._cut(at)
        if tag in ENDS_P:
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at].tag == "p":
                    self._cut(at)
                    break
                if self.stack[at].tag not in INLINE:
                    break
        if tag in IMPLIED:
            ended, beyond = IMPLIED[tag]
            first = None
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at].tag in beyond:
                    break
                if self.stack[at].tag in ended:
                    first = at
            if first is not None:
                self._cut(first)
        if len(self.stack) < size:
            self._break()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        self._end_implied(tag, attrs)
        top = self.stack[-1]
        self.line.tags += 1
        if tag == "br":
            if not top.dropped:
                self.line.parts.append("\n")
            return
        if tag in VOID:
            if tag not in INLINE:
                self._break()
            return
        element = Element(tag, top.dropped or _is_beside(tag, attrs, bool(top.article)), top.region, top.article, top.link or tag == "a", self.tags)
        element.outermost = element.dropped and not top.dropped
        if tag in REGIONS:
            classes = next((v for k, v in attrs if k == "class" and v), "")
            self.regions.append(Region(top.region, tag, frozenset(classes.split())))
            element.region = len(self.regions) - 1
            if top.dropped and _is_article(tag, attrs):
                next(e for e in self.stack if e.outermost).holds_article = True
            if not element.article and _is_article(tag, attrs):
                self.articles += 1
                element.article = self.articles
        self.stack.append(element)
        if tag not in INLINE:
            self._break()
            self.line.tags += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag == tag:
                crossed = any(e.tag not in INLINE for e in self.stack[at:])
                if tag in INLINE and crossed:  # an inline end does not close blocks
                    del self.stack[at]
                else:
                    self._cut(at, closed=True)
                break
        if tag not in INLINE:
            self._break()

    def handle_data(self, data: str) -> None:
        if self.stack[-1].tag == "head" and data.strip():  # text stands behind a head
            self._cut(len(self.stack) - 1)
            self._break()
        top = self.stack[-1]
        if not top.dropped:
            self.line.parts.append(data)
            if top.link:
                self.line.linked += len(data.strip())

    def result(self) -> list[Line]:
        self.close()
        self._cut(1)
        self._break()
        out = []
        for line in self.lines:
            line.text = " ".join("".join(line.parts).split())
            if line.text:
                out.append(line)
        return out


def _clusters(lines: list[Line]) -> np.ndarray:
    """Which lines stand above the threshold of smoothed text-to-tag ratios."""
    ratio = np.array([max(0, len(x.text) - x.linked) / max(1, x.tags) for x in lines])
    n = len(ratio)
    weight = np.convolve(np.ones(n), _KERNEL)[_RADIUS : _RADIUS + n]
    smooth = np.convolve(ratio, _KERNEL)[_RADIUS : _RADIUS + n] / weight
    chosen = smooth >= min(smooth.std(), smooth.max())
    return chosen & (ratio > 0)


def _path(regions: list[Region], region: int) -> list[int]:
    """A region and those around it, from the inside."""
    out = []
    while region >= 0:
        out.append(region)
        region = regions[region].parent
    return out


def _container(regions: list[Region], lines: list[Line], chosen: np.ndarray) -> set[int]:
    """The regions inside the one that holds the main text.

    It is the innermost region around all chosen lines, or one around it: as
    long as what is added has text of the outer region itself, a region like the
    one left, or a sentence, the outer one is taken."""
    paths = {x.region: _path(regions, x.region) for x in lines}
    texts = [x for x in lines if 2 * x.linked < len(x.text)]
    picked = [paths[x.region] for x, c in zip(lines, chosen) if c and 2 * x.linked < len(x.text)] or list(paths.values())
    shared = set(picked[0]).intersection(*map(set, picked[1:]))
    inner = next(r for r in picked[0] if r in shared)
    for outer in _path(regions, inner)[1:]:
        added = [x for x in texts if outer in paths[x.region] and inner not in paths[x.region]]
        beside = {p[p.index(outer) - 1] for x in added if (p := paths[x.region])[0] != outer}
        own = any(x.region == outer for x in added)
        alike = any(regions[r].like(regions[inner]) for r in beside)
        if added and not (own or alike or any(x.text.endswith((".", "!", "?", "…", "。")) for x in added)):
            break
        inner = outer
    return {r for r, path in paths.items() if inner in path}


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    reader = LineReader()
    reader.feed(html)
    lines = reader.result()
    if reader.unclosed:
        reader = LineReader(reader.unclosed)
        reader.feed(html)
        lines = reader.result()
    if not lines:
        return ""
    chosen = _clusters(lines)
    articles = {x.article for x, c in zip(lines, chosen) if c and x.article}
    if articles:
        kept = [x for x in lines if x.article in articles]
    else:
        regions = _container(reader.regions, lines, chosen)
        kept = [x for x, c in zip(lines, chosen) if x.region in regions and (c or 2 * x.linked < len(x.text))]
    return " ".join(x.text for x in kept)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, ``text``, ``n_chars``) of every page."""

    def run(batch: pa.RecordBatch):
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"]
        )

    source = pages.select(id_col, url_col, html_col)
    schema = T.StructType([source.schema[id_col], source.schema[url_col], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return map_batches(source, run, schema)
