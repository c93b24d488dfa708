"""Main text of web pages by text-to-tag ratios.

The standard library's streaming parser turns a page into a row of lines, one for each
block of text, each with its number of characters outside links and of tags since the
line before.  The text-to-tag ratios are weighed (lines of page furniture by 0, lines in
``article`` or ``main`` by 2), smoothed with a Gaussian and split into two clusters by a
threshold, the standard deviation of the smoothed ratios.  The lines above it decide where
the text is:

* the region is the smallest element that holds four fifths of the upper cluster's
  characters, widened to its parents as long as these add no furniture;
* a line of the region stays if it is in the upper cluster, is a heading or has no more text
  inside links than outside;
* lines of the upper cluster that adjoin the region, with no furniture between, stay too;
* at both ends, lines with more text inside links than outside go, but for headings.

Landmarks and furniture only weigh: a page whose ``article`` is a ``div`` goes the same way.
Furniture is menus, headers and footers of the page, sidebars, notices, adverts, forms,
scripts, styles and reader comments, known by element, role or class (fixed lists below).
A class counts only as a whole: ``ad`` or ``comment-list``, not ``share-price``.

Definitions: null html is empty and gives an empty text; character references are
decoded; white space inside a block becomes one space; blocks are joined by one line
feed; unclosed and stray tags are tolerated; a very long page is parsed piece by piece and
its lines are held by one worker; of lines with equal ratios all or none are above the
threshold; repeated rows are extracted each; columns named like a result column are
replaced; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlens.llm import query

# Elements and words of page furniture.
LANDMARKS = {"article", "main"}
NEVER = {
    "aside", "button", "dialog", "footer", "form", "head", "iframe", "menu", "nav", "noscript",
    "object", "script", "select", "style", "svg", "template", "textarea", "title",
}
ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "navigation", "search"}
WORDS = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "share", "sharing",
    "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar",
}
#: Words that only say which part or place of the page a class stands for.
PLACES = {
    "area", "bar", "block", "bottom", "box", "container", "content", "form", "global", "group", "inner", "item", "left",
    "links", "list", "main", "outer", "page", "primary", "reader", "right", "secondary", "section", "site", "top", "user",
    "widget", "wrap", "wrapper",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
#: Blocks whose own text belongs to the element around them.
LEAVES = {
    "address", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "legend", "li", "option", "p", "pre",
    "summary", "td", "th",
}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
NOT_P = BLOCKS - {"p"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that a new one of the group closes, up to the named container.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.0
#: Weight of the ratio of a line in a landmark (furniture weighs 0).
RAISED = 2.0
#: Share of the upper cluster's characters that the region's element holds.
HELD = 0.8
#: Characters given to the parser at a time.
PIECE = 1 << 16

_SPLIT = re.compile(r"[^a-z0-9]+")


class Line(NamedTuple):
    """A block of text, its characters in and outside links, its tags and where it lies."""

    text: str
    plain: int
    linked: int
    tags: int
    furniture: bool
    landmark: bool
    place: int  # number of the element that holds the block
    heading: bool = False

    @property
    def of_links(self) -> bool:
        return self.linked > self.plain and not self.heading


class _Open(NamedTuple):
    tag: str
    furniture: bool
    landmark: bool
    place: int


class _Lines(HTMLParser):
    """Collects the lines of a page; ``parents[place]`` is the element around an element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents: list[int] = [-1]
        self.stack: list[_Open] = []
        self.open: Counter[str] = Counter()
        self.parts: list[str] = []
        self.plain = self.linked = self.tags = 0

    def _here(self) -> _Open:
        return self.stack[-1] if self.stack else _Open("", False, False, 0)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            here = self._here()
            heading = any(self.open[tag] for tag in HEADINGS)
            self.lines.append(Line(text, self.plain, self.linked, self.tags, here.furniture, here.landmark, here.place, heading))
            self.tags = 0
        self.parts, self.plain, self.linked = [], 0, 0

    def _pop_to(self, at: int) -> None:
        if any(e.tag in BLOCKS for e in self.stack[at:]):
            self.flush()
        self.open.subtract(e.tag for e in self.stack[at:])
        del self.stack[at:]

    def _close(self, tags: set[str], within: set[str]) -> None:
        """Close the innermost of ``tags`` that is open inside ``within``."""
        if not any(self.open[tag] for tag in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag in tags:
                self._pop_to(at)
                return
            if self.stack[at].tag in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            self._close({"p"}, NOT_P)
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        here = self._here()
        furniture = here.furniture or _is_furniture(tag, attrs, here.landmark)
        if furniture != here.furniture:
            self.flush()
        place = here.place
        if tag in BLOCKS and tag not in LEAVES:
            place = len(self.parents)
            self.parents.append(here.place)
        self.stack.append(_Open(tag, furniture, here.landmark or tag in LANDMARKS and not furniture, place))
        self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if not self.open[tag]:
            if tag in BLOCKS:
                self.flush()
            return
        at = len(self.stack) - 1
        while self.stack[at].tag != tag:
            at -= 1
        if self.stack[at].furniture != (self.stack[at - 1].furniture if at else False):
            self.flush()
        self._pop_to(at)

    def handle_data(self, data):
        self.parts.append(data)
        if self.open["a"]:
            self.linked += len(data.strip())
        else:
            self.plain += len(data.strip())


def _is_furniture(tag: str, attrs, landmark: bool) -> bool:
    if tag in ("html", "body") or tag in LANDMARKS:
        return False
    if tag in NEVER or tag == "header" and not landmark:
        return True
    for key, value in attrs:
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return True
        if key in ("class", "id") and value:
            for name in value.lower().split():
                words = set(filter(None, _SPLIT.split(name)))
                telling = words & WORDS if landmark else words & (WORDS | {"header"})
                if telling and words <= telling | PLACES:
                    return True
    return False


def lines_of(html: str) -> tuple[list[Line], list[int]]:
    """A page's lines, and the parents of its elements."""
    parser = _Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    parser.close()
    parser.flush()
    return parser.lines, parser.parents


def ratio(line: Line) -> float:
    """The weighed text-to-tag ratio."""
    weight = 0.0 if line.furniture else RAISED if line.landmark else 1.0
    return weight * line.plain / max(1, line.tags)


def smoothed(ratios: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing over the neighbouring lines (weights sum to 1 at the edges too)."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(ratios)):
        span = range(max(0, i - reach), min(len(ratios), i + reach + 1))
        weights = [kernel[j - i + reach] for j in span]
        out.append(sum(w * ratios[j] for w, j in zip(weights, span)) / sum(weights))
    return out


def upper_cluster(lines: list[Line]) -> list[bool]:
    """Whether each line's smoothed ratio reaches the threshold; furniture never does."""
    smooth = smoothed([ratio(line) for line in lines])
    if not smooth or max(smooth) == 0:
        return [False] * len(lines)
    mean = sum(smooth) / len(smooth)
    threshold = min(math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth)), max(smooth))
    return [x >= threshold and not line.furniture for x, line in zip(smooth, lines)]


def region_of(lines: list[Line], parents: list[int], upper: list[bool]) -> list[bool]:
    """Whether each element lies in the region that the upper cluster chooses."""
    mass, furniture = [0] * len(parents), [0] * len(parents)
    for line, up in zip(lines, upper):
        mass[line.place] += up * max(1, line.plain)
        furniture[line.place] += line.furniture
    for place in range(len(parents) - 1, 0, -1):  # an element is numbered after its parent
        mass[parents[place]] += mass[place]
        furniture[parents[place]] += furniture[place]
    root = max(place for place in range(len(parents)) if mass[place] >= HELD * mass[0])
    while root and furniture[parents[root]] == furniture[root]:
        root = parents[root]
    inside = [False] * len(parents)
    for place in range(root, len(parents)):
        inside[place] = place == root or parents[place] >= 0 and inside[parents[place]]
    return inside


def main_text(html: str | None) -> str:
    """The main text of one page."""
    lines, parents = lines_of(html or "")
    upper = upper_cluster(lines)
    if not any(upper):
        return ""
    inside = region_of(lines, parents, upper)
    region = [inside[line.place] and not line.furniture for line in lines]
    kept = [r and (up or not line.of_links) for r, up, line in zip(region, upper, lines)]
    for order in (range(1, len(lines)), range(len(lines) - 2, -1, -1)):
        for i in order:
            kept[i] = kept[i] or upper[i] and kept[i - order.step]
    for order in (range(len(lines)), range(len(lines) - 1, -1, -1)):
        for i in order:
            if kept[i] and not lines[i].of_links:
                break
            kept[i] = False
    return "\n".join(line.text for line, k in zip(lines, kept) if k)


def _extract(batches):
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``text``, the main text."""
    others = [c for c in pages.columns if c not in ("text", html_col)]
    row = T.StructType([pages.schema[c] for c in others])
    schema = T.StructType([T.StructField("row", row), T.StructField("text", T.StringType())])
    return pages.select(F.struct(*others).alias("row"), F.col(html_col).alias("html")).mapInArrow(_extract, schema).select("row.*", "text")


@query
def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Every page's main text and its code points."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
