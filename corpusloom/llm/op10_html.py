"""HTML extraction: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines, one for each block of text.  A line's ratio is its
number of characters outside links to the tags on both sides of it; the logarithms of the ratios are smoothed
along the page with a Gaussian, whatever the lines are, and split in two clusters by the threshold that leaves the least sum
of squares within them.  Every line then weighs its distance from the threshold, for or against the elements that
hold it: a menu of many short lines counts against the page around it more than a long notice counts for it.  The
region is the container with the greatest weight around the line of the highest ratio, the innermost of equal ones.

Names of elements have two further uses.  Lines of page furniture (navigation, headers, footers, asides, forms, and
elements whose class, id or role names menus, sidebars, notices, adverts or reader comments) have a quarter of their
ratio, are not where a region starts, and count a quarter where they count for one.  Inside the region they are left out where
their own ratio is below the threshold; other lines are kept, being headings and short paragraphs.  Scripts, styles,
hidden elements and the like hold no text of the page.

Results for special rows: null and empty pages give an empty text; so do pages without content;
a page whose lines are all alike is its own region; rows are independent, so repeated rows change
nothing; an empty table gives an empty result; further columns are not read.  Pages are parsed whole,
whatever their length, in time linear in it but for a sort of the lines' ratios.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.runtime import ship

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is no text of the page.
SKIPPED_TAGS = frozenset("script style noscript template iframe object svg button select option textarea head title dialog canvas audio video".split())
FURNITURE_TAGS = frozenset("nav header footer aside form menu".split())
#: Words of class, id and role attributes that mark page furniture.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar sidenav aside header masthead footer contentinfo complementary notice notices cookie cookies consent gdpr popup modal overlay alert "
    "comment comments reply replies disqus discussion share sharing social related recommended newsletter subscribe subscription signup login "
    "search searchbox toolbar pagination pager widget skip copyright".split()
)
#: Elements that a class or id alone does not make furniture, unless it names reader comments.
KEPT_TAGS = frozenset("html body main article".split())
COMMENT_WORDS = frozenset("comment comments reply replies disqus discussion".split())
#: Opening one of these ends an open paragraph or item of the same kind.
CLOSED_BY_PEER = frozenset("p li dt dd tr td th option".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "head", "title", "button", "option", "select", "optgroup"}

#: Standard deviation of the Gaussian in lines, and how far it reaches.
SIGMA, REACH = 3.0, 10
#: What a line of page furniture counts of its ratio, and of its weight for a region.
FURNITURE_SHARE = 0.25
#: Elements wide enough to be a region; the page itself is one.
CONTAINERS = frozenset("article body center div html main section table td".split())


def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
    found: set[str] = set()
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            found.update(re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", value).lower()))
    return found


def _kind(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether an element's text is skipped, and whether it is page furniture."""
    if tag in SKIPPED_TAGS:
        return True, False
    if not attrs:
        return False, tag in FURNITURE_TAGS
    said = {k: (v or "").replace(" ", "").lower() for k, v in attrs}
    hidden = "hidden" in said or said.get("aria-hidden") == "true" or "display:none" in said.get("style", "")
    named = bool(_names(attrs) & (COMMENT_WORDS if tag in KEPT_TAGS else FURNITURE_WORDS))
    return hidden and tag not in KEPT_TAGS, named or tag in FURNITURE_TAGS


class Line(NamedTuple):
    """A block's text, the tags since the line before, the number of the element around it, whether it is furniture, and its characters in links."""

    text: str
    tags: int
    node: int
    furniture: bool
    linked: int


class _Lines(HTMLParser):
    """The lines of a page; ``n_tags`` is left with the tags behind the last one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, bool]] = []
        self.open: Counter[str] = Counter()
        self.parents: list[int] = [-1]
        self.tags: list[str] = ["html"]
        self.lines: list[Line] = []
        self.buffer: list[str] = []
        self.n_tags = self.skipped = self.furniture = self.linked = 0

    def _node(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            self.lines.append(Line(text, self.n_tags, self._node(), self.furniture > 0, min(self.linked, len(text))))
            self.n_tags = self.linked = 0
        self.buffer.clear()

    def _pop(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, _, skipped, furniture = self.stack[-1]
            if tag in BLOCKS:
                self._flush()
            self.stack.pop()
            self.open[tag] -= 1
            self.skipped -= skipped
            self.furniture -= furniture

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._flush()
        self.n_tags += 1
        if tag in VOID:
            return
        if tag in CLOSED_BY_PEER and self.open[tag] or tag in CLOSES_P and self.open["p"]:
            for depth in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[depth][0]
                if open_tag == tag and tag in CLOSED_BY_PEER or open_tag == "p" and tag in CLOSES_P:
                    self._pop(depth)
                    break
                if open_tag in BLOCKS and open_tag not in CLOSED_BY_PEER:
                    break
        self.parents.append(self._node())
        self.tags.append(tag)
        skipped, furniture = _kind(tag, attrs)
        self.stack.append((tag, len(self.parents) - 1, skipped, furniture))
        self.open[tag] += 1
        self.skipped += skipped
        self.furniture += furniture

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.n_tags += 1
        if tag in VOID or not self.open[tag]:
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                self._pop(depth)
                return

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.buffer.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        pass


def _ratios(lines: list[Line], behind: int = 0) -> np.ndarray:
    """Each line's characters outside links to the tags on both sides of it; furniture counts a share of it.

    ``behind`` is the number of tags behind the last line.
    """
    before = np.array([line.tags for line in lines], float)
    after = np.append(before[1:], behind)
    plain = np.array([len(line.text) - line.linked for line in lines]) / (1 + before + after)
    return plain * np.where([line.furniture for line in lines], FURNITURE_SHARE, 1.0)


def _smoothed(values: np.ndarray) -> np.ndarray:
    """The Gaussian mean of each value and its neighbours on the page, as far as there are any."""
    steps = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(steps**2) / (2 * SIGMA * SIGMA))
    middle = slice(REACH, REACH + len(values))
    return np.convolve(values, kernel)[middle] / np.convolve(np.ones(len(values)), kernel)[middle]


def _levels(ratios: np.ndarray) -> np.ndarray:
    """The smoothed logarithms of the ratios; one long paragraph is no cluster of its own."""
    return _smoothed(np.log1p(ratios))


def _threshold(values: np.ndarray) -> float:
    """Between the two clusters of least squares; values that are all alike are high, unless they are zero."""
    v = np.sort(values)
    if v[-1] - v[0] < 1e-9:
        return float(v[0]) / 2 if v[0] > 0 else np.inf
    size = np.arange(1, len(v))
    below, whole = np.cumsum(v)[:-1], v.sum()
    between = below**2 / size + (whole - below) ** 2 / (len(v) - size)
    cut = int(np.argmax(between))
    return float(v[cut] + v[cut + 1]) / 2


def _parsed(html: str) -> _Lines:
    # No tag ends after the last closing bracket; the parser would look for one again at each opening bracket.
    tail = html.rfind(">") + 1
    html = html[:tail] + html[tail:].replace("<", "&lt;")
    parser = _Lines()
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # a malformed declaration that the parser refuses: read it as text
        parser = _Lines()
        parser.feed(html.replace("<!", "&lt;!"))
        parser.close()
    parser._pop(0)
    parser._flush()
    return parser


def main_text(html: str | None) -> str:
    """The main text of one page."""
    parser = _parsed(html or "")
    lines = parser.lines
    if not lines:
        return ""
    ratios = _ratios(lines, parser.n_tags)
    level = _levels(ratios)
    cut = _threshold(level)
    if not (level >= cut).any():
        return ""
    weight = [0.0] * len(parser.parents)
    for line, distance in zip(lines, (level - cut).tolist(), strict=True):
        weight[line.node] += distance * (FURNITURE_SHARE if line.furniture and distance > 0 else 1.0)
    for node in range(len(weight) - 1, 0, -1):
        weight[parser.parents[node]] += weight[node]
    own = [-1.0 if line.furniture else r for line, r in zip(lines, ratios.tolist(), strict=True)]
    around, node = [], lines[int(np.argmax(own))].node
    while node >= 0:
        around.append(node)
        node = parser.parents[node]
    region = max((n for n in around if parser.tags[n] in CONTAINERS), key=lambda n: (weight[n], n))
    inside = {region}
    for node in range(region + 1, len(parser.parents)):
        if parser.parents[node] in inside:
            inside.add(node)
    return " ".join(line.text for line, r in zip(lines, np.log1p(ratios).tolist(), strict=True) if line.node in inside and (r >= cut or not line.furniture))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of each page."""

    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(2)]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), sizes],
                ["page_id", "url", "text", "n_chars"],
            )

    columns = [pages[f"`{page_id}`"].cast("long"), pages[f"`{url}`"].cast("string"), pages[f"`{html}`"].cast("string")]
    return pages.select(*columns).mapInArrow(run, "page_id long, url string, text string, n_chars long")
