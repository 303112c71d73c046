"""Main text of web pages from parser events.

``html.parser`` streams events into lines, one per block element. Each line has a ratio of text to tags; a Gaussian
smooths the ratios along the page, and two-means clustering of their logarithms sets the threshold between content lines and the rest.
Regions are article and main elements and what lies outside of them. Every region with a content line is kept; the outside is left out where
the elements hold more of the content than it does. Within a region a line goes if it is one of a run of links whose own ratio is below the threshold (a menu), or belongs to an
element that by its name or class is not part of the article.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML by their role, and words that name boilerplate in class, id and role.
BLOCKS = frozenset("""address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table
tbody td tfoot th thead title tr ul""".split())
SKIPPED = frozenset("""script style noscript template title head nav footer aside form button select textarea option iframe object
embed svg math canvas audio video map datalist dialog menu""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSTACKED = frozenset("p li dt dd tr td th option".split())  # their end tags are often left out
REGIONS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent
cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager
pagination popup promo promoted promotion related replies reply respond responds share sharing sidebar signup social sponsor sponsored
subscribe subscription toolbar toc widget widgets contentinfo complementary search alert alertdialog""".split())
HEADERS = frozenset(("header", "topbar", "banner"))  # of a site; an article's own header is part of it
# Words that only say where or what kind of box it is, in names such as site-footer or comment-list.
NEUTRAL = frozenset("""site page main top bottom left right global primary secondary list container wrapper box block area section bar inner
item items unit slot button buttons link links form post posts article articles story stories user reader thread body text content group panel
sticky fixed mobile desktop""".split())
IN_REGION_IDS = frozenset("comment comments commentlist respond disqus sidebar footer nav menu".split())

_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_MARKUP = re.compile(r"<[A-Za-z/!?]")


def names_boilerplate(token: str, words: frozenset[str]) -> bool:
    """Is a class or id one of the words, alone or with neutral ones? ``with-sidebar`` and ``related-work`` are not."""
    parts = [x.lower() for x in _PARTS.split(token) if x]
    return any(x in words for x in parts) and all(x in words or x in NEUTRAL for x in parts)


class _Line:
    __slots__ = ("parts", "tags", "linked", "region", "skipped", "named", "heading")

    def __init__(self, region: int, skipped: bool, named: tuple[int, ...]):
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0
        self.region = region
        self.skipped = skipped
        self.named = named
        self.heading = False


class Lines(HTMLParser):
    """Collects the lines of a page. ``stack`` holds the open elements that can contain blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, bool]] = []  # name, skipped by its kind, number if skipped by a name, begins a region
        self.open: Counter[str] = Counter()
        self.skipping = 0
        self.names = 0              # elements skipped by a name so far
        self.named: list[int] = []  # those that are open
        self.wrappers: set[int] = set()  # those that hold a page's main element or first heading
        self.regions = 0    # regions so far
        self.inside = 0     # open regions, nested ones included
        self.links = 0
        self.lines: list[_Line] = []
        self._next()

    def _next(self) -> None:
        self.line = _Line(self.regions if self.inside else 0, bool(self.skipping), tuple(self.named))
        self.lines.append(self.line)

    def _boilerplate(self, tag: str, attrs) -> bool:
        """Does a class, id or role name the element as boilerplate?"""
        if tag in ("html", "body", "main") or tag in HEADINGS:
            return False
        words = BOILERPLATE if self.inside else BOILERPLATE | HEADERS
        for name, value in attrs:
            if name in ("class", "role") and value:
                if any(names_boilerplate(t, words - HEADERS if self.inside else words) for t in value.split()):
                    return True
            elif name == "id" and value:
                if names_boilerplate(value, IN_REGION_IDS if self.inside else words):
                    return True
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return True
        return False

    def handle_starttag(self, tag, attrs):
        self.line.tags += 1
        if tag == "br":
            self.line.parts.append(" ")
            return
        if tag == "body" and self.open["head"]:
            self._close("head")
        if self.stack and self.stack[-1][0] in UNSTACKED and (self.stack[-1][0] == tag or self.stack[-1][0] == "p" and tag in BLOCKS):
            self._close(self.stack[-1][0])
        if tag == "a":
            self.links += 1
        kind = tag not in VOID and (tag in SKIPPED or tag == "header" and not self.inside)
        named = not kind and tag not in VOID and self._boilerplate(tag, attrs)
        block = tag in BLOCKS
        if tag in ("h1", "main"):
            self.wrappers.update(self.named)
        if kind or named or tag in REGIONS or (block and tag not in VOID and tag not in UNSTACKED):
            region = tag in REGIONS and not kind and not named
            self.names += named
            self.stack.append((tag, kind, self.names if named else 0, region))
            self.open[tag] += 1
            self.skipping += kind
            if named:
                self.named.append(self.names)
            if region:
                self.regions += not self.inside
                self.inside += 1
        if block or kind or named:
            self._next()
            self.line.heading = tag in HEADINGS

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # the slash means nothing on other elements, save that foreign ones are closed
            self.handle_starttag(tag, attrs)
            if tag in ("svg", "math") or tag not in BLOCKS:
                self.handle_endtag(tag)

    def _close(self, tag: str) -> None:
        if not self.open[tag]:
            return
        while self.stack:
            name, kind, named, region = self.stack.pop()
            self.open[name] -= 1
            self.skipping -= kind
            self.inside -= region
            if named:
                self.named.pop()
            if name == tag:
                break

    def handle_endtag(self, tag):
        self.line.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        self._close(tag)
        if tag in BLOCKS or tag in SKIPPED:
            self._next()

    def parse_comment(self, i, report=1):
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else end  # without an end the rest of the page is the comment

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<![", i):  # not markup of a page: passed over up to the next bracket
            return self.rawdata.find(">", i) + 1 or len(self.rawdata)
        return super().parse_html_declaration(i)

    def handle_data(self, data):
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len("".join(data.split()))


def without_unfinished(html: str) -> str:
    """The page up to markup that nothing closes, which the parser would try again at each of its openings."""
    start = html.rfind(">") + 1
    open_tag = _MARKUP.search(html, start)
    return html[:open_tag.start()] if open_tag else html


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing along the page, over three standard deviations."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach), kernel / kernel.sum(), "valid")


def threshold(values: np.ndarray) -> float:
    """Two-means: the middle between the means of the two clusters that it splits the values into."""
    at = float(values.mean())
    for _ in range(100):
        low, high = values[values < at], values[values >= at]
        if not len(low) or not len(high):
            break
        new = (float(low.mean()) + float(high.mean())) / 2
        if new == at:
            break
        at = new
    return at


def runs(marks: np.ndarray, least: int) -> list[slice]:
    """Stretches of at least ``least`` marks."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return [slice(a, b) for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(without_unfinished(html))
    parser.close()
    lines = []
    for line in parser.lines:
        text = " ".join("".join(line.parts).split())
        if text or line.tags:
            lines.append((text, line))
    if not lines:
        return ""
    length = np.array([len(text) for text, _ in lines], float)
    by_kind = np.array([line.skipped for _, line in lines])
    by_name = [line.named for _, line in lines]

    # a name does not make boilerplate of what wraps the page: an element with most of its text that holds its main element or heading, or all there is
    weight = Counter()
    for size, kind, named in zip(length, by_kind, by_name, strict=True):
        for n in named:
            weight[n] += 0 if kind else size
    total = length[~by_kind].sum()
    lifted = {n for n, w in weight.items() if 2 * w > total and n in parser.wrappers}
    skipped = by_kind | np.array([any(n not in lifted for n in named) for named in by_name])
    if not length[~skipped].any():
        skipped = by_kind

    size = np.where(skipped, 0.0, length)
    tags = np.array([max(1, line.tags) for _, line in lines])
    ratio = np.log1p(smoothed(size / tags))
    limit = threshold(ratio)
    high = (ratio >= limit) & (size > 0)
    linked = np.array([len("".join(text.split())) <= line.linked for text, line in lines]) & (size > 0)
    menu = np.zeros(len(lines), bool)
    full = np.flatnonzero(length > 0)  # tags alone stand between the entries of a list
    for run in runs(linked[full], 3):
        entries = full[run]
        menu[entries] = np.log1p(size[entries].sum() / tags[entries].sum()) < limit
    content = high & ~linked
    if not content.any():
        content = high if high.any() else size > 0

    region = np.array([line.region for _, line in lines])
    held = np.bincount(region, weights=length * content)
    chosen = (held > 0)[region] & (region > 0)
    if held[0] and 2 * held[0] >= held.sum():
        plain = [line.region == 0 and not gone and not line.linked for (_, line), gone in zip(lines, skipped, strict=True)]
        own = np.flatnonzero(content & (region == 0))
        first, last = own[0], own[-1]  # headings stand before the text they head, short lines after it
        while first and plain[first - 1]:
            first -= 1
        while last + 1 < len(lines) and plain[last + 1]:
            last += 1
        outside = np.zeros(len(lines), bool)
        outside[first:last + 1] = True
        chosen |= outside & (region == 0)
    chosen &= ~skipped & ~menu
    return "\n".join(text for (text, _), ok in zip(lines, chosen, strict=True) if ok and text)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``html`` replaced by text and n_chars (its code points).

    Null and empty pages, and pages without text, give an empty text. Broken markup is read as the parser reads it, save that markup that
    the page's end leaves unfinished is dropped; nothing is cut, whatever the length. The time is linear in it. Input columns named text or n_chars are replaced; other columns stay.
    """
    columns = [c for c in pages.columns if c.lower() not in {"text", "n_chars", html.lower()}]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(x) if x else "" for x in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 names=[*columns, "text", "n_chars"])

    return pages.select(html, *columns).mapInArrow(run, ", ".join(x for x in (fields, "text string, n_chars long") if x))
