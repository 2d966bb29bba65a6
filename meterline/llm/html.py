"""Main text of web pages by text-to-tag ratios.

Method.  The standard library's streaming parser turns a page into lines: the text between
two block-level tags, with the number of tags met in it.  Each line has a text-to-tag ratio;
the ratios of all visible lines - menus, adverts and footers included - are smoothed by a
Gaussian, and a two-means threshold clusters them into content and the rest.

Content lines vote for the region.  If most of their text lies in article or main elements,
those of them that hold content are the region; else it is the smallest element that holds
most of that text; where that is no more than the page's body, the runs of content lines
themselves are (short lines between them and the headings before them included).  Inside the
region, elements that declare themselves to be something else - navigation, footer, aside,
form, advert, notice, comments, hidden parts - are taken out; names such as "header",
"related" or "share" count there only if most of the element's text is links.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.words import slices
from meterline.plans.cluster import ship

# HTML element names and the words that class, id and role attributes use for page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
SKIP = frozenset("nav footer aside form button select option textarea dialog menu map label input datalist".split())
NEVER = frozenset("script style noscript template head title iframe object svg canvas audio video".split())
FURNITURE = frozenset("ad ads advert adverts advertisement advertising adsense banner sponsored sponsor promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs masthead topbar toolbar comment comments disqus reply replies respond discussion cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login pagination skip hidden".split())
LINKED = frozenset("footer header pager recommendations recommended related share sharing social widget".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
REGION = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: So many lines that are no content may lie between two content lines of one run.
GAP = 2
CLOSED_BY_BLOCK = frozenset(("p",))
SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_TOKEN = re.compile(r"[a-z]+|[0-9]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_SPACE = re.compile(r"\s+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Line(NamedTuple):
    text: str
    tags: int
    up: tuple[int, ...]  # the open elements' numbers, outermost first
    linked: int  # characters within links
    apart: bool  # in an element that declares itself to be no content


class Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, str]] = []  # name, number, what it declares itself to be
        self.names: list[str] = []
        self.doubtful: set[int] = set()  # elements that are apart if they mostly link
        self.lines: list[Line] = []
        self.text: list[str] = []
        self.aside: list[str] = []
        self.tags = self.linked = 0

    def declared(self, tag: str, attrs) -> str:
        """``never`` text, ``apart`` from the content, ``linked`` (apart if it mostly links) or nothing."""
        if tag in NEVER:
            return "never"
        if tag in SKIP:
            return "apart"
        inside = any(n in REGION for n, _, _ in self.open)
        if tag == "header":
            return "" if inside else "apart"
        if tag in ("html", "body"):
            return ""
        found = ""
        for k, v in attrs:
            if k == "hidden" or (k == "aria-hidden" and v == "true"):
                return "apart"
            if not v:
                continue
            if k == "style" and _HIDING.search(v):
                return "apart"
            if k == "role" and v.lower() in ROLES:
                return "apart"
            if k in ("class", "id") and tag not in REGION:
                words = _TOKEN.findall(_CAMEL.sub(r"\1 \2", v).lower())
                if not FURNITURE.isdisjoint(words):
                    return "apart"
                if not LINKED.isdisjoint(words):
                    found = "linked" if inside else "apart"
        return found

    def flush(self) -> None:
        if self.text or self.aside:
            up = tuple(n for _, n, _ in self.open)
            for parts, apart in ((self.text, False), (self.aside, True)):
                text = _SPACE.sub(" ", "".join(parts)).strip()
                if text:
                    self.lines.append(Line(text, self.tags, up, min(self.linked, len(text)), apart))
                    break
            self.text, self.aside = [], []
        self.tags = self.linked = 0

    def leave(self, to: int) -> None:
        if any(name in BLOCK for name, _, _ in self.open[to:]):
            self.flush()
        del self.open[to:]

    def shut(self, names, until) -> None:
        """Closes the nearest open element of ``names`` not beyond one of ``until``."""
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name in names:
                self.leave(i)
                return
            if name in until:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.shut(CLOSED_BY_BLOCK, ("td", "th", "article", "section", "div", "main", "body", "li", "blockquote"))
            self.flush()
        if tag in SIBLING:
            self.shut(SIBLING[tag], ("ul", "ol", "dl", "table", "select"))
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        kind = self.declared(tag, attrs)
        self.names.append(tag)
        self.open.append((tag, len(self.names) - 1, kind))
        if kind == "linked":
            self.doubtful.add(len(self.names) - 1)

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.leave(i)
                return

    def handle_data(self, data):
        kinds = {kind for _, _, kind in self.open}
        if "never" in kinds:
            return
        (self.aside if "apart" in kinds else self.text).append(data)
        if any(name == "a" for name, _, _ in self.open):
            self.linked += len(data.strip())


def content(ratio: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Mask of content lines: Gaussian smoothing, then a two-means threshold."""
    if len(ratio) < 2:
        return np.ones(len(ratio), bool)
    r = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    s = np.convolve(np.pad(ratio, r, mode="edge"), kernel / kernel.sum(), "valid")
    low, high = s.min(), s.max()
    if high == low:
        return np.ones(len(s), bool)
    for _ in range(50):
        top = s >= (low + high) / 2
        now = s[~top].mean(), s[top].mean()
        if now == (low, high):
            break
        low, high = now
    return s >= (low + high) / 2


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The article's blocks, one a line; empty for null, empty or contentless pages."""
    if not html:
        return ""
    p = Lines()
    p.feed(html)
    p.close()
    p.leave(0)
    p.flush()
    lines = p.lines
    if not lines:
        return ""
    good = content(np.array([len(x.text) / max(1, x.tags) for x in lines]), sigma)
    sizes = {i: [0, 0] for i in p.doubtful}
    for x in lines:
        for i in p.doubtful.intersection(x.up):
            sizes[i][0] += x.linked
            sizes[i][1] += len(x.text)
    links = {i for i, (linked, size) in sizes.items() if 2 * linked > size}
    body = [not x.apart and links.isdisjoint(x.up) for x in lines]
    inside = region(p.names, lines, good, body)
    return "\n".join(x.text for x, i, b in zip(lines, inside, body, strict=True) if i and b)


def region(names: list[str], lines: list[Line], good: np.ndarray, body: list[bool]) -> list[bool]:
    """Which lines lie in the region that the content lines vote for."""
    votes = [len(x.text) if g and b else 0 for x, g, b in zip(lines, good, body, strict=True)]
    if not any(votes):  # no content line is left: the threshold says nothing about the rest
        votes = [len(x.text) if b else 0 for x, b in zip(lines, body, strict=True)]
    total = sum(votes)
    declared = [next((i for i in x.up if names[i] in REGION), None) for x in lines]
    if 2 * sum(v for v, d in zip(votes, declared, strict=True) if d is not None) > total:
        chosen = {d for d, v in zip(declared, votes, strict=True) if v and d is not None}
        return [d in chosen for d in declared]
    weight: dict[int, int] = {}
    for x, v in zip(lines, votes, strict=True):
        for i in x.up if v else ():
            weight[i] = weight.get(i, 0) + v
    most = [i for i, w in weight.items() if 4 * w >= 3 * total and names[i] in BLOCK and names[i] not in ("p", "li", "td", "h1", "h2", "h3", "html", "body")]
    if most:
        return [max(most) in x.up for x in lines]
    # no element stands out: the runs of content lines, joined over short gaps, with the headings before them
    at = [i for i, v in enumerate(votes) if v]
    keep = set(at)
    for i, j in zip(at, at[1:]):
        if j - i <= GAP + 1:
            keep.update(range(i, j))
    for i in sorted(keep):
        j = i - 1
        while j >= 0 and any(names[k] in HEADINGS for k in lines[j].up):
            keep.add(j)
            j -= 1
    return [i in keep for i in range(len(lines))]


def extract(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """One row per row of ``pages(page_id, url, html, ...)``: page_id, url, text, n_chars.

    Defined cases: null and empty pages and pages without content give the empty string; a
    page cut off in the middle is read as far as it goes; repeated rows get equal results; an
    empty table gives no rows; further columns, whatever their names, are ignored.
    """
    ship(pages.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                text = [main_text(x, sigma) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
