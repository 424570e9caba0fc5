"""Main text of web pages by text-to-tag ratios.

The events of the standard library's parser are cut into lines, one for each block element.
A line's ratio is its signs over its tags; parts of a page that say by their element, role,
class or id that they are no content have ratio zero. Ratios are smoothed with a Gaussian
kernel, and lines above a threshold, the standard deviation of the smoothed ratios, are
content. The region around a content line, its article or else its nearest container, is
selected as a whole, so that short lines between long ones stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import small_batches

RADIUS = 2
SIGMA = 1.0

# fixed values: what elements mean
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NEVER = set(
    "script style noscript template head title nav footer aside form button select textarea iframe object svg math"
    " canvas audio video menu dialog".split()
)
#: of those, what may stand within a line of text, which goes on behind it
MUTED = set("script style noscript template button select textarea iframe object svg math canvas audio video".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = set("article main section div body td th blockquote center".split())
BOILERPLATE_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split()
)
HEADER_NAMES = set("header masthead".split())
COMMENT_NAMES = set("comment comments commentlist respond disqus replies discussion".split())
BOILERPLATE_NAMES = COMMENT_NAMES | set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar footer bottombar sidebar aside rail widget"
    " ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share"
    " sharing social related recommended recommendations pagination pager search toolbar copyright legal"
    " disclaimer skip".split()
)
#: words that make a name one of a state, not of a part
STATES = set("has is no not with without open opened closed enabled disabled allowed".split())
#: an element that holds more than this share of a page's text is not dropped for its name
MOST_BY_NAME, MOST_COMMENTS = 2 / 3, 9 / 10
# an element that a start of one of the others ends
CLOSED_BY = {
    "p": CONTAINERS | set("p ul ol dl table h1 h2 h3 h4 h5 h6 pre hr form nav aside header footer figure".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "tr": {"tr"},
    "option": {"option"},
}

_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_OPEN_TAG_AT_END = re.compile(r"<(?:!--(?:(?!-->).)*|[a-zA-Z/!?][^<>]*)\Z", re.S)


def _names(value: str | None) -> set[str]:
    return {n.lower() for n in _NAME.findall(value or "")}


@dataclass
class _Element:
    tag: str
    region: int
    dropped: str = ""  # why what is inside is no content
    article: bool = False
    named: tuple[int, ...] = ()  # the elements around that names say to be no content
    why: str = ""  # the outermost reason of both kinds
    muted: bool = False  # stands within a line


@dataclass
class _Line:
    region: int
    dropped: bool
    article: bool
    named: tuple[int, ...] = ()
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class _Lines(HTMLParser):
    """Cuts parser events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("", 0)]
        self.regions = 0
        self.lines: list[_Line] = []
        self.links = self.muted = 0
        self.named: list[str] = []  # why each of the named elements is none
        self._new_line()

    def _new_line(self) -> None:
        top = self.stack[-1]
        self.line = _Line(top.region, bool(top.dropped), top.article, top.named)
        self.lines.append(self.line)

    def _id_names(self, tag: str, values: dict[str, str | None]) -> set[str]:
        """Names in an id, without ids that are made of titles: those of headings, sections and what is in an article."""
        names, inside = _names(values.get("id")), self.stack[-1].article
        if tag in HEADINGS or tag in INLINE and (inside or any(e.tag in HEADINGS for e in self.stack)):
            return set()
        if tag == "article" or tag == "section" and not inside:
            return names if names <= BOILERPLATE_NAMES else set()
        if tag == "section":
            # around articles comments may have a section
            return names if names <= COMMENT_NAMES and all(e.tag != "article" for e in self.stack) else set()
        if inside:
            named = tag == "div" and "section" not in _names(values.get("class")) and len(names) == 1
            return names & BOILERPLATE_NAMES if named else set()
        return names

    def _why_dropped(self, tag: str, attrs: list[tuple[str, str | None]], inside: _Element) -> str:
        if inside.dropped:
            return inside.dropped
        if tag in NEVER or tag == "header" and not inside.article:
            return tag
        values = dict(attrs)
        style = (values.get("style") or "").replace(" ", "").lower()
        if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style:
            return "hidden"
        if (values.get("role") or "").lower() in BOILERPLATE_ROLES:
            return "role"
        if tag in ("html", "body", "main"):
            return ""
        tokens = [_names(c) for c in (values.get("class") or "").split()]
        names = set().union(*(n for n in tokens if not n & STATES)) | self._id_names(tag, values)
        if inside.article and tag != "article":
            # a name of several words, as of a topic, decides only if all of them say no content
            names = set().union(*(n for n in tokens if n <= BOILERPLATE_NAMES)) | self._id_names(tag, values)
        if names & COMMENT_NAMES:
            return "comment"
        if tag == "article":
            return ""
        if names & BOILERPLATE_NAMES or names & HEADER_NAMES and not inside.article:
            return "name"
        return ""

    def _pop(self) -> _Element:
        self.muted -= self.stack[-1].muted
        return self.stack.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        starts = tag in ("article", "main")
        if not starts and tag not in VOID and (self.muted or tag in MUTED and not self.stack[-1].dropped):
            self._open(tag, attrs, muted=True)
            return
        if tag in INLINE:
            self.line.tags += 1
            if tag == "br":
                self.line.parts.append(" ")
            elif tag == "a":
                self.links += 1
            elif tag not in VOID and self._why_dropped(tag, attrs, self.stack[-1]) and not self.stack[-1].dropped:
                self._open(tag, attrs, muted=True)
            return
        while self.stack[-1].tag in CLOSED_BY and tag in CLOSED_BY[self.stack[-1].tag]:
            self._pop()
        if starts:
            # what was left open before the content does not swallow it; comments may hold articles
            while self.stack[-1].why not in ("", "comment"):
                self._pop()
        if tag in VOID:
            self._new_line()
            self.line.tags += 1
            return
        self._open(tag, attrs)

    def _open(self, tag: str, attrs: list[tuple[str, str | None]], muted: bool = False) -> None:
        inside = self.stack[-1]
        if muted:
            self.muted += 1
            self.stack.append(_Element(tag, inside.region, "muted", inside.article, inside.named, inside.why or "muted", True))
            return
        region, named, dropped = inside.region, inside.named, inside.dropped
        why = self._why_dropped(tag, attrs, inside)
        if why in ("name", "comment"):
            named = (*named, len(self.named))
            self.named.append(why)
        else:
            dropped = why
        if tag in CONTAINERS and not inside.article:
            self.regions += 1
            region = self.regions
        self.links = 0
        article = inside.article or tag in ("article", "main") and not dropped and not named
        self.stack.append(_Element(tag, region, dropped, article, named, inside.why or why))
        self._new_line()
        self.line.tags += 1

    def handle_endtag(self, tag: str) -> None:
        self.line.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        open_tags = [e.tag for e in self.stack]
        if tag in open_tags[1:]:
            # an end tag inside an article does not reach what is around it, except from its parents
            closed = [self._pop()]
            while closed[-1].tag != tag:
                closed.append(self._pop())
            if not all(e.muted for e in closed):
                self._new_line()
        elif self.muted:
            return
        elif tag not in INLINE:
            self._new_line()

    def handle_data(self, data: str) -> None:
        if self.muted:
            return
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len(data.strip())


def smoothed(ratios: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """Ratios under a Gaussian kernel; the ends count as repeated."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def _not_dropped(parser: _Lines, texts: list[str], lines: list[_Line]) -> list[str]:
    """Texts of lines that no element drops, names only if what they drop is not most of a page without an article."""
    sizes = [0 if line.dropped else len(text) for line, text in zip(lines, texts, strict=True)]
    held = [0] * len(parser.named)
    for line, size in zip(lines, sizes, strict=True):
        for k in line.named:
            held[k] += size
    most = {"name": MOST_BY_NAME * sum(sizes), "comment": MOST_COMMENTS * sum(sizes)}
    articles = any(size for line, size in zip(lines, sizes, strict=True) if line.article and not line.named)
    drops = [articles or size <= most[why] for size, why in zip(held, parser.named, strict=True)]
    return [
        "" if line.dropped or any(drops[k] for k in line.named) else text for line, text in zip(lines, texts, strict=True)
    ]


def _content(lines: list[_Line], texts: list[str]) -> np.ndarray:
    """Which lines have smoothed ratios above the threshold."""
    ratios = np.array([len(text) / max(1, line.tags) for line, text in zip(lines, texts, strict=True)])
    smooth = smoothed(ratios)
    return (smooth > smooth.std()) & (ratios > 0)


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks, white space as single spaces, joined by line ends.

    A page without content, null or empty gives an empty text. What is not markup counts as
    text; a tag or comment that the end of the page cuts off does not.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(_OPEN_TAG_AT_END.sub("", html))
    parser.close()
    lines = [line for line in parser.lines if line.tags or line.parts]
    if not lines:
        return ""
    texts = _not_dropped(parser, [line.text for line in lines], lines)
    # lists of links are menus, unless they are in an article
    texts = [
        "" if not line.article and line.linked * 10 >= 9 * len(text.replace(" ", "")) else text
        for line, text in zip(lines, texts, strict=True)
    ]
    content = _content(lines, texts)
    # articles count alone if they hold most of the content; else they may be teasers below it
    sizes = np.array([len(t) for t in texts]) * content
    if 2 * sizes[[line.article for line in lines]].sum() >= sizes.sum() > 0:
        texts = [text if line.article else "" for line, text in zip(lines, texts, strict=True)]
        content = _content(lines, texts)
    regions = {line.region for line, is_content in zip(lines, content, strict=True) if is_content}
    return "\n".join(text for line, text in zip(lines, texts, strict=True) if text and line.region in regions)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
            texts = [main_text(h.as_py()) for h in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["id", "url", "text", "n_chars"],
            )


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url, text, n_chars) for every row of ``pages``.

    ``n_chars`` counts code points. A null or empty page has an empty text. Every row is
    judged by its own page: repeated and null ids and urls change nothing. An empty table
    gives an empty table; other columns are not read.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    out = rows.mapInArrow(_extracted, "id long, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col)
