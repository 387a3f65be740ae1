"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's event parser reads a page once. A line is the text between two block boundaries; it knows its
characters, its tags, its characters inside links and the region it lies in: the nearest enclosing ``article``, ``main``,
``section``, ``div``, table cell or body. Elements that never are article text (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments), told by tag, role or a word of class and id, take their lines with them. A
word is evidence alone: it is not followed where the element holds ``main``, or half or more of the unlinked text of the page
or of its articles.

Over the other lines the text-to-tag ratio is smoothed by a Gaussian and split in two clusters at a threshold found by
two-means. A region that holds a line above it, by itself and smoothed, is content, and so is what lies between two such
lines; all lines of content stay, so a short paragraph among long ones is never dropped. Regions made of links never are
content. ``article`` and ``main`` are evidence: the choice extends to all that is so marked and to nothing else, unless that is
made of links, or the chosen lines outside, those under no such word, have more than ``WEIGHT`` times its unlinked text: then the
clusters' regions alone are the content, as on a page that marks nothing.

Null and empty pages and pages without content give an empty text. Rows that repeat get the same answer, malformed markup
(unclosed or stray tags) is read as far as it goes, extra columns pass through. Pages are read whole, one at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import replaced, replaced_schema, slices

SIGMA = 1.0
#: by how much the unlinked text chosen outside must exceed that of a marked article
WEIGHT = 2
#: HTML element names by their part in a page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head title script style noscript template nav header footer aside form button select option textarea input iframe object svg canvas dialog menu audio video map".split())
REGIONS = frozenset("article main section div td th body".split())
BLOCKS = REGIONS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption address table caption thead tbody tfoot tr hr html details summary hgroup center fieldset legend".split()) | DROPPED
ARTICLE = frozenset(["article", "main"])
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id that mark what is no article text
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager footer footers masthead toolbar "
    "share sharing social related recommended recommendations comment comments reply replies respond disqus widget widgets skip hidden".split()
)
OUTSIDE = frozenset("header headers".split())  # marks outside an article alone: inside one it may be the headline's
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}


class Line:
    __slots__ = ("text", "tags", "linked", "region", "article", "mark")

    def __init__(self, text: str, tags: int, linked: int, region: int, article: bool, mark: int = 0):
        self.text, self.tags, self.linked, self.region, self.article, self.mark = text, tags, linked, region, article, mark

    def unlinked(self) -> int:
        return max(0, len("".join(self.text.split())) - self.linked)


class Reader(HTMLParser):
    """Turns events into the lines that may be content."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.tags = self.linked = self.regions = 0
        self.open: list[tuple[str, bool, int, bool, int]] = []  # element, dropped, region, inside an article, nearest mark
        self.at: defaultdict[str, list[int]] = defaultdict(list)  # places of each element in it
        self.links = 0
        self.marks: list[int] = [0]  # of each element with a word that marks, the nearest such element around it; the first is the page
        self.mains: set[int] = set()  # nearest marks of main elements

    def state(self) -> tuple[bool, int, bool, int]:
        return self.open[-1][1:] if self.open else (False, 0, False, 0)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            dropped, region, article, mark = self.state()
            if text and not dropped:
                self.lines.append(Line(text, max(1, self.tags), self.linked, region, article, mark))
            self.parts.clear()
        self.tags = self.linked = 0

    def pop_to(self, depth: int) -> None:
        for element, *_ in self.open[depth:]:
            self.links -= element == "a"
            self.at[element].pop()
        del self.open[depth:]

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of these; -1 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def close_implied(self, tag: str) -> None:
        """What the start of ``tag`` ends: an open paragraph, the item before, anything left open outside an article."""
        if tag in ARTICLE:
            at = min((self.at[t][0] for t in ("nav", "header", "footer", "head", "ul", "ol", "a") if self.at.get(t)), default=None)
            if at is not None and self.last(ARTICLE) < 0:
                self.pop_to(at)
        around = self.last((*STOPS.get(tag, ()), *REGIONS))
        ended = [self.at[t][bisect_left(self.at[t], around)] for t in ("p", *CLOSES.get(tag, ())) if self.at.get(t) and self.at[t][-1] >= around]
        if ended:
            self.pop_to(min(ended))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            self.close_implied(tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        dropped, region, article, mark = self.state()
        if tag in REGIONS:
            self.regions += 1
            region = self.regions
        if not dropped:
            named = dict(attrs)
            dropped = self.unwanted(tag, named, article)
            if not dropped and self.marked(tag, named, article):
                self.marks.append(mark)
                mark = len(self.marks) - 1
            if tag == "main" and not dropped:
                self.mains.add(mark)
        self.links += tag == "a"
        self.at[tag].append(len(self.open))
        self.open.append((tag, dropped, region, article or (tag in ARTICLE and not dropped), mark))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    @staticmethod
    def unwanted(tag: str, attrs: dict[str, str | None], article: bool) -> bool:
        if tag in DROPPED and not (tag == "header" and article):
            return True
        if tag in ("html", "body"):
            return False
        style = re.sub(r"\s", "", (attrs.get("style") or "").lower())
        return (
            (attrs.get("role") or "").lower() in ROLES or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true"
            or "display:none" in style or "visibility:hidden" in style
        )

    @staticmethod
    def marked(tag: str, attrs: dict[str, str | None], article: bool) -> bool:
        if tag in ("html", "body"):
            return False
        words = set(re.split(r"[^a-z0-9]+", f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()))
        return bool(words & MARKS) or (not article and bool(words & OUTSIDE))

    def wanted(self) -> list[Line]:
        """The lines under no mark that is followed."""
        n = len(self.marks)
        text, articles, main = [0] * n, [0] * n, [i in self.mains for i in range(n)]
        for x in self.lines:
            text[x.mark] += x.unlinked()
            articles[x.mark] += x.unlinked() if x.article else 0
        for i in range(n - 1, 0, -1):  # a mark around another one has the smaller number
            around = self.marks[i]
            text[around], articles[around], main[around] = text[around] + text[i], articles[around] + articles[i], main[around] or main[i]
        followed = [False] * n
        for i in range(1, n):
            kept = main[i] or (text[i] > 0 and 2 * text[i] >= text[0]) or (articles[i] > 0 and 2 * articles[i] >= articles[0])
            followed[i] = followed[self.marks[i]] or not kept
        return [x for x in self.lines if not followed[x.mark]]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        at = self.last((tag,))
        if at < 0 or (tag not in BLOCKS and self.last(REGIONS) > at):
            return
        self.pop_to(at)

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.links:
            self.linked += len("".join(data.split()))


def read(html: str) -> list[Line]:
    reader = Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.wanted()


def smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian over three sigmas either way, its weights renewed at the ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = lambda x: np.convolve(x, kernel)[reach : reach + len(x)]
    return full(values) / full(np.ones(len(values)))


def threshold(values: np.ndarray) -> float:
    """Between the two means of two clusters on a line."""
    low, high = float(values.min()), float(values.max())
    cut = (low + high) / 2
    for _ in range(100):
        under, over = values[values < cut], values[values >= cut]
        new = (float(under.mean() if len(under) else low) + float(over.mean())) / 2
        if new == cut:
            break
        cut = new
    return cut


def content(lines: list[Line]) -> list[Line]:
    """The lines of the content regions, in page order."""
    if not lines:
        return []
    ratios = np.array([(len(x.text) - min(x.linked, len(x.text))) / x.tags for x in lines])
    smoothed = smooth(ratios)
    cut = threshold(smoothed)
    high = [i for i in range(len(lines)) if smoothed[i] >= cut and ratios[i] >= cut] or [int(ratios.argmax())]
    chars, linked = {}, {}
    for x in lines:
        chars[x.region] = chars.get(x.region, 0) + len("".join(x.text.split()))
        linked[x.region] = linked.get(x.region, 0) + x.linked
    chosen = {lines[i].region for i in high}
    inside = lambda i, x: x.region in chosen or high[0] < i < high[-1]
    outside = sum(lines[i].unlinked() for i in high if not lines[i].article and not lines[i].mark)
    marked = [x for x in lines if x.article]
    within, of_links = sum(x.unlinked() for x in marked), sum(x.linked for x in marked)
    if marked and of_links <= within and outside <= WEIGHT * within:
        return marked
    return [x for i, x in enumerate(lines) if inside(i, x) and 2 * linked[x.region] <= chars[x.region]]


def main_text(html: str | None) -> str:
    return "\n\n".join(x.text for x in content(read(html))) if html else ""


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html``; a column that has the name of ``text`` is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            found = pa.array([main_text(x) for x in batch.column(html).to_pylist()], pa.string())
            yield replaced(batch, [found], field)

    field = [T.StructField(text, T.StringType())]
    return pages.mapInArrow(run, replaced_schema(pages, field))
