"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, clustering.

The standard library's parser streams a page's events. Block elements cut it into lines. A line's
ratio is its characters outside links by its tags; where the page marks its article, it is the share of
these characters in its text and tags, and 0 outside of the mark. Lines inside menus, headers, footers, forms,
adverts and the like, known by element, role, class or id, are left out and count 0. Ratios are
smoothed over neighbouring lines with a Gaussian, and two clusters of the smoothed ratios give the
threshold. A run of lines above a share of it is content if one of them passes it; a line without
text outside links, as in a list of links, has to pass it by itself.

Defined results: a NULL or empty page, or one without text, gives an empty text; broken markup is
read as far as it goes; end tags that HTML lets pages leave out are implied by what follows, other
missing ones end with their parent; repeated rows are read one by one; columns other than those
used do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from stockweave.llm.common import with_computed

SIGMA = 1.0
SHARE = 0.25  # of the threshold, for lines next to those that pass it
TAG_CHARS = 0.1  # what a tag counts beside text in a marked article
# HTML elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
APART = set(
    "aside button dialog footer form head header iframe menu nav noscript object script select style svg "
    "template textarea title".split()
)
ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
NAMES = set(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "pagination popup promo promotion related reply respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split()
)
# Elements that may stand in a head; any other ends it.
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
# Elements whose start ends an open paragraph.
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
# Elements whose start ends open ones, and those beyond which these are not looked for.
_ROW_GROUPS = {"tbody", "thead", "tfoot"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    **dict.fromkeys(_ROW_GROUPS, (_ROW_GROUPS | {"caption", "colgroup", "tr"}, {"table"})),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
# Elements that an open paragraph outside them does not reach into.
SCOPES = set("applet button caption html marquee object table td template th".split())
WRAPPERS = set("html body main article".split())
_NAME_PARTS = re.compile(r"[a-z0-9]+")
_QUALIFIED = re.compile(r"\b(?:has|with|no|is)[-_][a-z0-9_-]+")


def _apart(tag: str, attributes: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element holds none of the main text."""
    if tag in APART and not (tag == "header" and in_article):
        return True
    for name, value in attributes:
        if name == "hidden":
            return True
        if not value:
            continue
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id"):
            parts = _NAME_PARTS.findall(_QUALIFIED.sub(" ", value.lower()))
            wanted = {"comment", "comments"} if tag in WRAPPERS else NAMES
            if not wanted.isdisjoint(parts):
                return True
        elif name == "aria-hidden" and value == "true":
            return True
    return False


class Lines(HTMLParser):
    """Lines of a page as (text, tags, link characters, place): place -1 apart, 1 in an article, else 0."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, apart, in article, in link
        self.open_tags: Counter[str] = Counter()
        self.apart = self.article = self.link = False
        self.texts: list[str] = []
        self.tags = self.link_chars = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.texts).split())
        if text:
            place = -1 if self.apart else int(self.article)
            self.lines.append((text, self.tags, self.link_chars, place))
            self.tags = self.link_chars = 0
        self.texts = []

    def end_element(self, depth: int) -> None:
        """End the open element at this depth and all inside."""
        tag, apart, article, link = self.open[depth]
        if tag in BLOCKS or apart != self.apart or article != self.article:
            self.end_line()
        self.apart, self.article, self.link = apart, article, link
        self.open_tags.subtract(inner for inner, *_ in self.open[depth:])
        del self.open[depth:]

    def end_open(self, ended: set[str], beyond: set[str]) -> None:
        """End the open elements of these kinds, the outermost on this side of ``beyond``."""
        if not any(self.open_tags[tag] for tag in ended):
            return
        found = -1
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth][0]
            if tag in beyond:
                break
            if tag in ended:
                found = depth
        if found >= 0:
            self.end_element(found)

    def imply_ends(self, tag: str) -> None:
        """End what the start of an element ends where the page has no end tag."""
        if tag not in IN_HEAD:
            self.end_open({"head"}, {"body", "noscript", "svg", "template"})
        if tag in IMPLIED:
            self.end_open(*IMPLIED[tag])
        if tag in ENDS_P:
            self.end_open({"p"}, SCOPES)

    def handle_starttag(self, tag, attrs):
        self.imply_ends(tag)
        if tag in BLOCKS:
            self.end_line()
        elif tag == "br":
            self.texts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        before = (tag, self.apart, self.article, self.link)
        apart = self.apart or _apart(tag, attrs, self.article)
        if apart != self.apart:
            self.end_line()
        self.open.append(before)
        self.open_tags[tag] += 1
        self.apart = apart
        self.article = self.article or tag in ("article", "main")
        self.link = self.link or tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self.end_element(depth)
                return
        if tag in BLOCKS:
            self.end_line()

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and data.strip():
            self.end_element(len(self.open) - 1)
        self.texts.append(data)
        if self.link:
            self.link_chars += len(data)


def lines_of(html: str) -> list[tuple[str, int, int, int]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser.lines


def ratios(lines: list[tuple[str, int, int, int]], marked: bool = False) -> np.ndarray:
    """Characters outside links by tags; for a ``marked`` page their share in text and tags of the article's lines."""
    values = []
    for text, tags, links, place in lines:
        plain = max(0, len(text) - links)
        if place < 0 or marked and not place:
            values.append(0.0)
        else:
            values.append(plain / (len(text) + TAG_CHARS * tags) if marked else plain / max(1, tags))
    return np.array(values)


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    radius = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return np.convolve(values, kernel / kernel.sum())[radius : radius + len(values)]


def threshold(values: np.ndarray) -> float:
    """Half way between the centres of two clusters of the values and 0, the ratio of no text."""
    values = np.append(values, 0.0)
    low, high = values.min(), values.max()
    while True:
        upper = values > (low + high) / 2
        centres = values[~upper].mean(), values[upper].mean() if upper.any() else high
        if centres == (low, high):
            return (low + high) / 2
        low, high = centres


def content(lines: list[tuple[str, int, int, int]]) -> list[str]:
    """Texts of the lines that are content."""
    marked = any(place == 1 and len(text) > links for text, _, links, place in lines)
    own = ratios(lines, marked)
    if not own.any():
        return []
    even = smoothed(own)
    inside = np.array([place == int(marked) for *_, place in lines])
    least = threshold(even[inside])
    high = inside & (even >= least)
    wanted = high | inside & (own > 0) & (even >= SHARE * least)
    kept: list[str] = []
    start = 0
    for i in range(1, len(lines) + 1):
        if i < len(lines) and wanted[i] == wanted[start]:
            continue
        if wanted[start] and high[start:i].any():
            kept += [text for text, *_ in lines[start:i]]
        start = i
    return kept


def main_text(html: str | None) -> str:
    """Blocks of the main text, joined by empty lines."""
    return "\n\n".join(content(lines_of(html or "")))


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``."""

    def prepare():
        def compute(part):
            texts = [main_text(html) for html in part.column("html").to_pylist()]
            return texts, [len(text) for text in texts]

        return compute

    return with_computed(pages, "text string, n_chars bigint", prepare, ["html"])


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))
