"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams events over the page. Block elements end a line; each line has its text,
the number of tags since the last line, the characters inside links, and the elements around it. A line's ratio
is its text outside links by its tags; a line in an element that names itself as something else (navigation, page
header, footer, sidebar, notice, advert, form, comments) has a ratio of zero. Ratios are smoothed with a Gaussian along
the page, and two clusters (low and high, found by alternating means) give the threshold.

Lines above it are content. The region begins as the innermost element that holds nearly all of their text. An article
or main element around it is taken whole. Without one the region widens, element by element: a part beside it is
taken if most of its text is content, and a heading if it stands right before what is taken. Of a page without any
element around its text the region goes from the first content line that isn't mostly links to the last. All lines of the region are kept,
short ones and links too, but for those in elements named as something else.

A class or id names an element if all words of one of its tokens are such names or say no more than a place or a shape
(``site-footer``, but not ``social-history``). It doesn't count on an element with most of the page's text, unless it
is for readers' comments.

Defined results: a null or empty page has empty text; broken markup is read as the parser reports it; foreign elements
that close themselves are empty; formulas are text; hidden elements aren't; pages of any length are read whole; equal
pages give equal text; columns other than the html and the result stay as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas audio video head title select button textarea datalist".split())
#: Elements that may hold a page's text as a whole.
CONTAINERS = frozenset("html body main article section div center td".split())
OTHER = frozenset("nav header footer aside form menu dialog fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words in class or id that say what an element is, when it isn't the article.
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
NAMES = COMMENTS | frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended cookie cookies consent notice alert popup modal newsletter subscribe signup login share sharing social pagination pager copyright".split())
#: Words beside such names that leave an element what they say.
PLACES = frozenset("site page main global primary secondary top bottom left right upper lower inner outer container wrapper wrap box bar block area section list links link item items slot unit holder panel row group buttons icons posts articles thread form text bg fixed sticky mobile desktop".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: What may stand in a head; anything else ends one that isn't closed.
_IN_HEAD = frozenset("head html meta link title style script base noscript template".split())
_WORD, _CAMEL, _SPACE = re.compile(r"[a-z]+"), re.compile(r"(?<=[a-z])(?=[A-Z])"), re.compile(r"\s+")
_CLOSES_P = BLOCKS - {"body", "html", "head"}
SIGMA, PIECE, SHARE, MOST = 2.0, 1 << 16, 0.9, 0.75


def named(value: str) -> tuple[bool, bool]:
    """Whether a class or id says that an element is something else, and that it is readers' comments."""
    other = comments = False
    for token in value.split():
        words = set(_WORD.findall(_CAMEL.sub("-", token).lower()))
        if words & NAMES and words <= NAMES | PLACES:
            other, comments = True, comments or bool(words & COMMENTS)
    return other, comments


@dataclass
class Line:
    text: str
    tags: int
    linked: int  # characters in links
    path: tuple  # (number, whether an article or main element) of the open containers
    marks: tuple  # (number, whether it always counts) of the elements around that name themselves as something else
    heading: bool

    @property
    def own(self) -> int:
        return max(len(self.text) - self.linked, 0)


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list = []  # name, number, skipped, marked
        self.path: tuple = ()
        self.marks: tuple = ()
        self.text: list = []
        self.tags = self.linked = self.number = self.skipped = self.links = self.headings = self.head = 0

    def end_line(self):
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append(Line(text, max(self.tags, 1), self.linked, self.path, self.marks, self.headings > 0))
        self.text, self.tags, self.linked = [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if self.head and tag not in _IN_HEAD:
            self.close_until("head", ())
        if tag in BLOCKS:
            self.end_line()
            if tag in _CLOSES_P:
                self.close_until("p", BLOCKS)
            if tag == "li":
                self.close_until("li", {"ul", "ol", "menu"})
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        skipped, other, always = tag in SKIP, tag in OTHER, False
        # A header within the article is its own; a page's header isn't.
        if tag == "header" and any(x[0] in ("article", "main") for x in self.stack):
            other = False
        for name, value in attrs:
            if name in ("class", "id") and value and tag not in ("html", "body", "article", "main"):
                said = named(value)
                other, always = other or said[0], always or said[1]
            elif name == "role" and value:
                other = other or value.lower() in ROLES
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                skipped = True
        self.number += 1
        self.stack.append((tag, self.number, skipped, other))
        self.skipped += skipped
        self.links += tag == "a"
        self.headings += tag in HEADINGS
        self.head += tag == "head"
        if other:
            self.marks = (*self.marks, (self.number, always))
        if tag in CONTAINERS:
            self.path = (*self.path, (self.number, tag in ("article", "main")))

    def handle_startendtag(self, tag, attrs):
        if tag in SKIP:
            self.tags += 1
        else:
            self.handle_starttag(tag, attrs)

    def pop(self):
        tag, _, skipped, other = self.stack.pop()
        self.skipped -= skipped
        self.links -= tag == "a"
        self.headings -= tag in HEADINGS
        self.head -= tag == "head"
        if other:
            self.marks = self.marks[:-1]
        if tag in CONTAINERS:
            self.path = self.path[:-1]

    def close_until(self, tag, walls):
        """Close the innermost open ``tag`` unless one of ``walls`` stands before it."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            if name in walls:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        if any(x[0] == tag for x in self.stack):
            walls = () if tag in BLOCKS else BLOCKS
            self.close_until(tag, walls)

    def handle_data(self, data):
        if not self.skipped:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    ones = np.convolve(np.ones(len(values)), weights)[reach : reach + len(values)]
    return np.convolve(values, weights)[reach : reach + len(values)] / ones


def threshold(values: np.ndarray) -> float:
    """Between the means of two clusters."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        cut = (low + high) / 2
        above = values > cut
        if not above.any() or above.all():
            break
        means = float(values[~above].mean()), float(values[above].mean())
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2


def marked(lines: list[Line], most: float = MOST) -> np.ndarray:
    """Which lines stand in an element named as something else; a name on an element with most of the text isn't one."""
    held: dict = {}
    for line in lines:
        for mark in line.marks:
            held[mark] = held.get(mark, 0) + line.own
    total = sum(x.own for x in lines)
    counts = {mark for mark, n in held.items() if mark[1] or n <= most * total}
    return np.array([any(m in counts for m in x.marks) for x in lines], bool)


def content_lines(lines: list[Line], other: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Which lines have a smoothed ratio in the high cluster."""
    ratio = np.array([x.own / x.tags for x in lines]) * ~other
    ratio = smoothed(ratio, sigma)
    return (ratio >= threshold(ratio)) & ~other


def content_region(lines: list[Line], content: np.ndarray, other: np.ndarray, share: float = SHARE) -> np.ndarray:
    """Which lines are in the region of the content lines, those of elements named otherwise left out."""
    mass: dict = {}
    for i in np.flatnonzero(content).tolist():
        for element in lines[i].path:
            mass[element] = mass.get(element, 0) + lines[i].own
    total = sum(lines[i].own for i in np.flatnonzero(content).tolist())
    core = max((e for e, n in mass.items() if n >= share * total), default=None)
    around = next((x.path for x, c in zip(lines, content, strict=True) if c and core in x.path), ())
    around = around[: around.index(core) + 1] if core else ()
    whole = next((i for i in range(len(around) - 1, -1, -1) if around[i][1]), None)
    if whole is not None:
        return np.array([around[whole] in x.path for x in lines], bool) & ~other
    chosen = np.array([core is not None and core in x.path for x in lines], bool) & ~other
    if len(around) < 3:  # the text stands in the body, or in nothing
        at = np.flatnonzero(content & np.array([2 * x.own > len(x.text) for x in lines]))
        at = at if len(at) else np.flatnonzero(content)
        chosen = _with_heading(lines, (np.arange(len(lines)) >= at[0]) & (np.arange(len(lines)) <= at[-1]) & ~other, other)
    for depth in range(len(around) - 2, -1, -1):
        parts: dict = {}
        for i, x in enumerate(lines):
            if not chosen[i] and not other[i] and x.path[: depth + 1] == around[: depth + 1]:
                parts.setdefault(x.path[depth + 1] if len(x.path) > depth + 1 else -i - 1, []).append(i)
        for own in parts.values():
            if 2 * sum(lines[i].own for i in own if content[i]) > sum(len(lines[i].text) for i in own):
                chosen[own] = True
        chosen = _with_heading(lines, chosen, other)
    return chosen


def _with_heading(lines: list[Line], chosen: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The chosen lines, and the headings right before the first of them."""
    chosen = chosen.copy()
    at = int(np.argmax(chosen)) - 1
    while at >= 0 and lines[at].heading and not other[at]:
        chosen[at] = True
        at -= 1
    return chosen


def main_text(html: str, sigma: float = SIGMA, share: float = SHARE) -> str:
    """Text of the content region, a line for each block."""
    parser = Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    other = marked(lines)
    content = content_lines(lines, other, sigma)
    if not content.any():
        content = ~other
    if not content.any():
        return ""
    chosen = content_region(lines, content, other, share)
    return "\n".join(lines[i].text for i in np.flatnonzero(chosen).tolist())


@pandas_udf(StringType())
def extract(html: pd.Series) -> pd.Series:
    return pd.Series([main_text(x or "") for x in html], dtype=object)


def main_texts(df: DataFrame, html_col: str = "html", out_col: str = "main_text") -> DataFrame:
    """``df`` with the main text of each page in ``out_col``, which replaces a column of that name."""
    return df.withColumn(out_col, extract(F.col(html_col)))
