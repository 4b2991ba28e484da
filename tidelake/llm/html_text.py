"""The main text of web pages, from parser events and smoothed text-to-tag ratios.

The standard library's parser streams a page's events; each block of text between block-level tags
becomes a line with its characters, its tags and the elements it stands in. The ratio of text to
tags per line is smoothed by a Gaussian and split into two clusters. Where article and main elements
hold half of the text of the upper cluster's lines, all these elements together are the article; or
else the region from the first to the last line of that cluster, with what stands beside it up to
the next menu. The text is every line of it, short and linked ones too, apart from what stands in
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments. Links
only serve to find the region. Tags and whole words in class or id name those parts, unless an
article stands within them; where a word is only a part of a name (has-sidebar, related-work), the
clusters decide: such a part is left out if less than half of its text is in the upper one.

Null, empty and wordless pages give an empty text; broken markup is read as far as browsers would;
repeated rows give repeated results."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead title tr ul".split()
)
#: Elements whose text is never part of an article.
OUTSIDE = frozenset("head nav footer aside form menu script style noscript template select button textarea iframe object svg canvas audio video dialog search title datalist".split())
#: Words in class or id, and roles, that say the same.
SIGNS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login nav navbar navigation navi menu breadcrumb breadcrumbs sidebar sidebars aside footer masthead topbar toolbar comment comments commentlist disqus replies respond share sharing social related recommended recommendations widget widgets pagination pager outbrain taboola skip hidden".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: An open element of the first kind ends when one of the second kind begins.
CLOSES = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"])}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p blockquote figcaption".split())
SCOPES = frozenset("ul ol dl table tbody select article section main div td body nav aside footer header form".split())
SIGMA = 1.0
#: Parts of a name that say where a thing is or what shape it has, not what it is.
SHAPES = frozenset("list box section area container wrapper wrap block item items inner outer left right top bottom primary secondary site page global main slot unit bar link links panel group row col column".split())
_WORDS = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Lines(HTMLParser):
    """lines: of each block its text, its tags, the characters in links, the elements around it
    (numbers, outermost first) and whether it is outside of any article. doubtful: elements that a
    part of a name says are outside; named: those that a whole name does."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, number, outside
        self.names: list[str] = []
        self.doubtful: set[int] = set()
        self.named: set[int] = set()
        self.holds: set[int] = set()  # an article or main element
        self.lines: list[tuple[str, int, int, tuple[int, ...], bool]] = []
        self.text: list[str] = []
        self.tags = self.linked = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.linked, tuple(n for _, n, _ in self.open), bool(self.open) and self.open[-1][2]))
            self.tags = self.linked = 0
        self.text.clear()

    def _outside(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if self.open and self.open[-1][2] or tag in OUTSIDE:
            return True
        inside = any(t in ("article", "main") for t, _, _ in self.open)
        if tag == "header" and not inside:
            return True
        if tag in ("html", "body", "main", "article"):
            return False
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id"):
                for token in value.split():
                    parts = _WORDS.findall(token)
                    said = [p for p in parts if p in SIGNS or not inside and p == "header"]
                    if said and all(p in SIGNS or p in SHAPES or p.isdigit() or p == "header" for p in parts):
                        self.named.add(len(self.names))
                    elif said:
                        self.doubtful.add(len(self.names))
            elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
                return True
        return False

    def _end(self, at: int) -> None:
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self.flush()
            for i in range(len(self.open) - 1, -1, -1):  # an open paragraph ends before a block
                if self.open[i][0] == "p":
                    self._end(i)
                    break
                if self.open[i][0] in SCOPES:
                    break
        if tag in CLOSES:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in CLOSES[tag]:
                    self._end(i)
                    break
                if self.open[i][0] in SCOPES and self.open[i][0] not in ("td", "div"):
                    break
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "img"):
                self.text.append(" ")
            return
        if tag in ("td", "th"):
            self.text.append(" ")
        if tag == "body":  # an unclosed head ends here
            self.open = [x for x in self.open if x[0] == "html"]
        self.open.append((tag, len(self.names), self._outside(tag, attrs)))
        if tag in ("article", "main"):
            self.holds.update(n for _, n, _ in self.open[:-1])
        self.names.append(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as in HTML, the slash says nothing

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._end(i)
                return
            if tag not in BLOCK and self.open[i][0] in SCOPES:
                return  # an inline end tag closes nothing beyond its block

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if any(t == "a" for t, _, _ in self.open):
            self.linked += len(data.strip())


def read(html: str) -> Lines:
    for text in (html, html.replace("<![", "&lt;![")):
        lines = Lines()
        try:
            lines.feed(text)
            lines.close()
            lines.flush()
            return lines
        except AssertionError:  # of the parser, on a marked section that never ends
            continue
    return Lines()


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which lines are content: Gaussian smoothing of the ratios, then the upper of two clusters,
    found by moving a threshold to the middle of the two means."""
    reach = np.arange(-3, 4)
    kernel = np.exp(-0.5 * (reach / SIGMA) ** 2)
    smooth = np.convolve(ratios, kernel, "same")[: len(ratios)] if len(ratios) >= len(kernel) else np.convolve(ratios, kernel)[3 : 3 + len(ratios)]
    smooth = np.log1p(smooth)
    threshold = smooth.mean()
    for _ in range(20):
        upper = smooth >= threshold
        if upper.all():
            break
        moved = (smooth[upper].mean() + smooth[~upper].mean()) / 2
        if abs(moved - threshold) < 1e-9:
            break
        threshold = moved
    return smooth >= threshold


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = read(html)
    left_out = page.named - page.holds
    lines = [(*x[:4], x[4] or not left_out.isdisjoint(x[3])) for x in page.lines]
    chosen, lines = _chosen(lines, page)
    if not chosen.any():
        return ""
    own = np.array([any(page.names[n] in ("article", "main") for n in x[3]) for x in lines])
    sizes = np.array([len(x[0]) for x in lines])
    if 2 * sizes[chosen & own].sum() >= sizes[chosen].sum():
        return "\n".join(x[0] for x, inside in zip(lines, own, strict=True) if inside and not x[4])
    first, last = _region(page, lines, chosen)
    return "\n".join(x[0] for x in lines[first : last + 1] if not x[4])


def _chosen(lines: list[tuple], page: Lines) -> tuple[np.ndarray, list[tuple]]:
    """Lines of the upper cluster, and all lines after doubtful elements have been judged by it."""
    if all(x[4] for x in lines):
        return np.zeros(len(lines), bool), lines
    inside = np.array([not x[4] for x in lines])
    ratios = np.array([0.0 if outside else max(0, len(text) - linked) / max(1, tags) for text, tags, linked, _, outside in lines])
    chosen = content_lines(ratios) & inside
    if not chosen.any():
        chosen = inside
    sizes, upper = np.array([len(x[0]) for x in lines]), np.array([len(x[0]) if c else 0 for x, c in zip(lines, chosen, strict=True)])
    judged: set[int] = set()
    for n in page.doubtful - page.holds:
        at = np.array([i for i, x in enumerate(lines) if n in x[3] and not x[4]], int)
        if len(at) and 2 * upper[at].sum() < sizes[at].sum():
            judged.add(n)
    if not judged:
        return chosen, lines
    lines = [(*x[:4], x[4] or not judged.isdisjoint(x[3])) for x in lines]
    if all(x[4] for x in lines):
        return chosen, [(*x[:4], False) if c else x for x, c in zip(lines, chosen, strict=True)]
    kept = np.array([not x[4] for x in lines])
    return (chosen & kept if (chosen & kept).any() else kept), lines


def _region(page: Lines, lines: list[tuple], chosen: np.ndarray) -> tuple[int, int]:
    """The first and the last line of the region that holds all chosen lines, and what stands beside
    them up to the next menu: a block that is mostly link, unless it is a heading or a paragraph."""
    linked = np.array([2 * x[2] > len(x[0]) for x in lines])
    at = np.flatnonzero(chosen & ~linked if (chosen & ~linked).any() else chosen)

    def block(i: int) -> str:
        return next((page.names[n] for n in reversed(lines[i][3]) if page.names[n] in BLOCK), "")

    def beside(step: int, i: int) -> int:
        edge = i
        while 0 <= i + step < len(lines):
            i += step
            if lines[i][4]:
                continue
            if linked[i] and block(i) not in PROSE:
                while step > 0 and edge > at[0] and (block(edge) in HEADINGS or lines[edge][4]):
                    edge -= 1  # a heading over the menu belongs to it
                break
            edge = i
        return edge

    return beside(-1, int(at[0])), beside(1, int(at[-1]))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; no shuffle."""
    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(_extracted, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))
