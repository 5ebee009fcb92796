"""Main text of HTML pages, from streaming parser events and text-to-tag ratios.

The standard library's HTMLParser is fed once; its events build a list of lines (the
text between two block-level tags), each with the tags it held and the innermost open
container. The text-to-tag ratio of each line (characters per tag) is smoothed with
a Gaussian over neighbouring lines, and a two-means threshold on the smoothed ratios
splits the lines into content and the rest. The content region starts from the innermost
container that has nine tenths of the content lines' text, and is the main or article
element around it; where there is none, the innermost container of all content lines,
and further out as long as that adds no lines of links. Its lines are returned in page
order, short ones included, less those under menus, headers, footers, sidebars, notices,
adverts, forms and reader comments.

Words of class, id and role mark such parts, but not a wrapper of the whole page: where
every main and article element is inside marked ones, those around the main (or the
article of most text) count as unmarked, and in a page without them those that hold most
of the text of high ratio.

Character references are decoded, white space inside a line becomes one space, lines
are trimmed and joined by an empty line. Null or empty html, or a page without text,
gives the empty string. Broken markup (unclosed tags, cut references) is read as far
as it goes; whole pages are parsed, never prefixes. Each row is extracted by itself,
so repeated rows and extra columns need no care.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frame h1 h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav ol p pre
section summary table tbody td tfoot th thead title tr ul""".split()) - {"br"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold article text.
NOT_TEXT = frozenset("""head script style noscript template svg canvas iframe object nav footer aside button select
option textarea label menu dialog title""".split())
#: Containers in which the region is looked for.
CONTAINERS = frozenset("article body div main section td blockquote html".split())
#: Words of class, id and role that mark other parts than the article.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"nav\w*|menu\w*|breadcrumbs?|side-?bar|aside|widget|related|recommend\w*|share|sharing|social|footer|masthead|"
    r"comments?|commentlist|disqus|replies|respond|newsletter|subscribe\w*|signup|login|search|pagination|pager|"
    r"copyright|legal|disclaimer|toolbar|complementary|contentinfo|skip-?link)(?:$|[\s_-])", re.I)
#: Words that speak of a part elsewhere, as has-sidebar does; what follows them marks nothing.
COMPOUND = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|with|without)[_-]+[\w-]*", re.I)
#: Marks of reader comments, which can be longer than the article.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])", re.I)
SPACE = re.compile(r"\s+")
SIGMA, REGION_SHARE = 1.0, 0.9


#: text, tags, innermost container, boilerplate
Line = tuple[str, int, int, bool]


def totals(parent: list[int], own: dict[int, int]) -> list[int]:
    """The sum of ``own`` over each element and all inside it (an element comes after the one around it)."""
    out = [own.get(c, 0) for c in range(len(parent))]
    for c in range(len(parent) - 1, 0, -1):
        out[parent[c]] += out[c]
    return out


def chain(parent: list[int], c: int) -> list[int]:
    """The element and those around it, innermost first."""
    out = []
    while c:
        out.append(c)
        c = parent[c]
    return out


def added(to: dict[int, int], key: int, n: int) -> None:
    to[key] = to.get(key, 0) + n


class Events(HTMLParser):
    """Collects a ``Line`` for every line of the page. Containers and marked elements are numbered from 1 in the
    order in which they open, each with the number of the one around it (0: none), so that memory follows the
    page's length however deep it nests."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, bool, bool, bool]] = []  # tag, never text, container, marked
        self.open: Counter[str] = Counter()  # tags of the stack
        self.marked_in: list[int] = [0]  # of each element marked by class, id or role, the marked one around it
        self.mark = 0  # the innermost open one
        self.marks: list[int] = []  # of each line
        self.articles: dict[int, int] = {}  # the innermost marked element around each article and main
        self.article_in: dict[int, int] = {}  # the article or main around each of them
        self.article, self.mark_article = 0, [0]  # the innermost open one; that around each marked element
        self.comments: set[int] = set()  # the marked elements that hold reader comments
        self.inside: list[int] = [0]  # of each container, the one around it
        self.container = 0  # the innermost open one
        self.bad, self.tags, self.parts = 0, 0, []
        self.names: dict[int, str] = {}  # tag of each container
        self.linked: list[bool] = []  # of each line, whether most of its text is in links
        self.anchors, self.in_links = 0, 0

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.tags, self.container, self.bad > 0))
            self.linked.append(2 * self.in_links > len(text))
            self.marks.append(self.mark)
        self.parts, self.tags, self.in_links = [], 0, 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            if tag == "p":  # a paragraph ends the one before
                self._close("p", CONTAINERS)
            elif tag == "li":
                self._close("li", frozenset(("ul", "ol", "menu")))
        if tag in VOID:
            return
        words = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true")
                     or (k == "style" and v and re.search(r"display\s*:\s*none", v)) for k, v in attrs)
        bad = tag in NOT_TEXT or hidden
        words = COMPOUND.sub(" ", words)
        # a form holds controls, or the whole page (as some frameworks have it): its text decides, as with marked words
        marked = tag == "form" or bool(words and tag not in ("html", "body", "article", "main") and BOILERPLATE.search(words))
        if tag == "header" and not self.article:
            bad = True  # the page's header; an article's own header holds its headline
        self._open(tag, bad, marked)
        if marked and COMMENTS.search(words):
            self.comments.add(len(self.marked_in) - 1)

    def _open(self, tag: str, bad: bool, marked: bool) -> None:
        container = tag in CONTAINERS
        self.stack.append((tag, bad, container, marked))
        self.open[tag] += 1
        self.bad += bad
        if marked:
            self.marked_in.append(self.mark)
            self.mark_article.append(self.article)
            self.mark = len(self.marked_in) - 1
        self.anchors += tag == "a"
        if container:
            self.inside.append(self.container)
            self.container = len(self.inside) - 1
            self.names[self.container] = tag
            if tag in ("article", "main"):
                self.articles[self.container] = self.mark
                self.article_in[self.container] = self.article
                self.article = self.container

    def _pop(self) -> None:
        tag, bad, container, marked = self.stack.pop()
        self.open[tag] -= 1
        self.bad -= bad
        if marked:
            self.mark = self.marked_in[self.mark]
        self.anchors -= tag == "a"
        if container:
            if self.container == self.article:
                self.article = self.article_in[self.article]
            self.container = self.inside[self.container]

    def _close(self, tag: str, stop: frozenset[str]) -> None:
        if not self.open[tag]:
            return
        for i in reversed(range(len(self.stack))):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in stop:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag != "br":
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if self.open[tag]:
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        self.parts.append(data)
        if self.anchors:
            self.in_links += len(data.strip())


def smoothed_ratios(lines: list[Line], sigma: float = SIGMA) -> np.ndarray:
    """Characters per tag of each line, smoothed with a Gaussian of ``sigma`` lines."""
    ratio = np.array([0.0 if bad else len(text) / max(tags, 1) for text, tags, _, bad in lines])
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel, "full")[reach:reach + len(ratio)]
    return np.convolve(ratio, kernel, "full")[reach:reach + len(ratio)] / weight


def threshold(values: np.ndarray) -> float:
    """The border of two clusters (two-means in one dimension, started at the extremes)."""
    low, high = float(values.min()), float(values.max())
    if high <= low:
        return low
    for _ in range(100):
        cut = (low + high) / 2
        below, above = values[values < cut], values[values >= cut]
        new = (float(below.mean()) if len(below) else low, float(above.mean()))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def settled(page: Events) -> list[Line]:
    """The lines, boilerplate also under marked elements that are no wrapper of the whole page."""
    lines, marked_in = page.lines, page.marked_in
    if len(marked_in) == 1:
        return lines
    by_container: dict[int, int] = {}
    by_mark: dict[int, int] = {}
    for (text, _, container, bad), m in zip(lines, page.marks, strict=True):
        if not bad:
            added(by_container, container, len(text))
            added(by_mark, m, len(text))
    size = totals(page.inside, by_container)
    around = [c for c in page.articles if size[c]]
    wrappers: set[int] = set()
    if around:
        if all(page.articles[c] for c in around):
            wrappers = set(chain(marked_in, page.articles[max(around, key=lambda c: (page.names[c] == "main", size[c]))]))
        # a marked block that is most of an article (a text on legal or related matters) is the article; the
        # smallest article around it that is no reader comment itself is asked
        commented = [False] * len(marked_in)
        for m in range(1, len(marked_in)):
            commented[m] = m in page.comments or commented[marked_in[m]]
        asked = {0: 0}
        for c, outer in page.article_in.items():
            asked[c] = asked[outer] if commented[page.articles[c]] else c
        held = totals(marked_in, by_mark)
        wrappers |= {m for m in range(1, len(marked_in)) if m not in page.comments
                     and (c := asked[page.mark_article[m]]) and 2 * held[m] > size[c]}
    elif any(not x[3] for x in lines):
        r = smoothed_ratios(lines)
        open_lines = [k for k, x in enumerate(lines) if not x[3]]
        cut = threshold(r[open_lines])
        high: dict[int, int] = {}
        for k in open_lines:
            if r[k] >= cut:
                added(high, page.marks[k], len(lines[k][0]))
        held = totals(marked_in, high)
        wrappers = {m for m in range(1, len(marked_in)) if 2 * held[m] > held[0]}
    cleared = [True] * len(marked_in)
    for m in range(1, len(marked_in)):
        cleared[m] = m in wrappers and cleared[marked_in[m]]
    return [(text, tags, container, bad or not cleared[m])
            for (text, tags, container, bad), m in zip(lines, page.marks, strict=True)]


def region(page: Events, lines: list[Line], content: list[int]) -> int | None:
    """The container whose open lines are the article; None for the whole page."""
    own: dict[int, int] = {}
    for k in content:
        added(own, lines[k][2], len(lines[k][0]))
    weight = totals(page.inside, own)
    inner = max((c for c in range(1, len(weight)) if weight[c] and weight[c] >= REGION_SHARE * weight[0]), default=0)
    if not inner:  # innermost: opened last
        return None
    path = chain(page.inside, inner)
    for tag in ("main", "article"):
        around = next((c for c in reversed(path) if page.names[c] == tag), None)
        if around is not None:
            return around
    links: dict[int, int] = {}
    for k, x in enumerate(lines):
        if not x[3] and page.linked[k]:
            added(links, x[2], 1)
    linked = totals(page.inside, links)
    found = None
    for c in path:
        if found is not None and weight[found] == weight[0] and linked[c] > linked[found]:
            break
        found = c
    return found if weight[found] == weight[0] else None


def within(parent: list[int], whole: int) -> list[bool]:
    """Of each element, whether it is ``whole`` or inside it."""
    out = [False] * len(parent)
    for c in range(1, len(parent)):
        out[c] = c == whole or out[parent[c]]
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    p = Events()
    p.feed(html)
    p.close()
    p.flush()
    lines = settled(p)
    open_lines = [k for k, x in enumerate(lines) if not x[3]]
    if not open_lines:
        return ""
    r = smoothed_ratios(lines)
    cut = threshold(r[open_lines])
    content = [k for k in open_lines if r[k] >= cut]
    whole = region(p, lines, content)
    kept = None if whole is None else within(p.inside, whole)
    return "\n\n".join(x[0] for x in lines if not x[3] and (kept is None or kept[x[2]]))


def text_column(html: Column) -> Column:
    """The main text as a Column (Arrow batches; only the html crosses to Python)."""
    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([main_text(x) for x in b], dtype=object)

    return extract(html)


def extract(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` without the html, with the main text in ``into`` (replacing a column of that name)."""
    kept = [c for c in pages.columns if c not in (html, into)]
    return pages.select(*kept, text_column(F.col(html)).alias(into))
