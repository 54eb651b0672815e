"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks, each with its chain of open elements. A classifier adds up what a block's own
statistics (length beside the page's other blocks, share of links, last sign) and its elements (names, class words)
say, as finite weights that one another can outweigh: the cost of calling it boilerplate less that of calling it
content. These are the capacities from the source and to the sink. Smoothness edges of the same order tie a block to
the next one, and to the last one with the same parent; they weigh more the nearer the two stand in the element tree.
The maximum flow saturates the cheapest cut, and blocks on the source's side of it are the content: a short line, or
one that is all link, goes with its surroundings. Time is linear in the page's length and in its depth.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

# HTML element names by role.
#: Elements whose start and end break a block of text.
BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; what they hold is never shown as text.
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes".split())
#: Elements that hold no main text.
AWAY = frozenset("nav footer aside form menu dialog button select datalist head search svg canvas object audio video".split())
#: An open element that a start tag of the given name closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Start tags that close an open paragraph.
ENDS_P = BREAKS - {"body", "html", "head", "button", "option", "optgroup", "select", "caption", "legend", "td", "th", "tr", "tbody", "thead", "tfoot", "title"}
#: Elements that another one's start may close, and where the search for one stops.
IMPLIED = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("table ul ol dl td th div section article main body html".split())
# Words in class, id and role attributes.
AWAY_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead topbar footer foot bottom comment comments reply replies respond disqus discussion cookie cookies consent "
    "gdpr notice notices alert notification popup modal overlay newsletter subscribe subscription signup login social share sharing "
    "related recommended recommendations widget toolbar pagination pager copyright legal search skip complementary contentinfo hidden".split()
)
MAIN_WORDS = frozenset("article articlebody content main post entry story body text prose".split())
#: Of the words above, those of what readers wrote.
READER_WORDS = frozenset("comment comments reply replies respond disqus discussion".split())
#: First words of a name that tells what an element has, not what it is.
HAVING = frozenset("has with without".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
#: Where a raw element ends, found in the page itself: lower case may have another length.
ENDS = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: Smoothness of neighbours, and of blocks with one parent; both fall with the steps between them in the tree.
NEXT, SIBLING = 1.0, 1.5
#: Weights of the classifier. Length counts by its logarithm beside half the typical length of the page's blocks.
LENGTH, LEAST, MOST, TYPICAL = 0.75, -2.0, 2.0, 80
#: A last sign that ends a sentence, being a heading, links (inside a main element or a page without one, and elsewhere).
ENDED, HEADING, LINKED, LINKED_OUTSIDE = 0.5, 1.0, -2.0, -5.0
#: Inside a main element; outside of the page's main elements; in a page without one.
MAIN, OUTSIDE, NO_MAIN = 2.0, -3.0, 2.1
#: An element that holds no main text; a header; an element that its words call boilerplate. The strongest one counts.
AWAY_COST, HEADER_COST, MARKED_COST = -9.0, -8.0, -8.0
#: An element with more than this share of a page's text may be a wrapper of the main text, if it holds that.
WRAPPER = 0.6
#: Code points from which unlinked text is prose.
PROSE = 80


class Element:
    __slots__ = ("away", "best", "chars", "depth", "h1", "heading", "main", "marked", "name", "near", "nests", "offers", "parent", "path", "plain", "readers", "solid")

    def __init__(self, name: str, parent: Element | None, attributes: str):
        self.name, self.parent, self.chars = name, parent, 0
        self.depth = parent.depth + 1 if parent else 0
        words: set[str] = set()
        self.away = name in AWAY
        # whether a word marks it as boilerplate, and whether a name of it is nothing but main words
        self.marked, self.plain = False, name in ("article", "main")
        if attributes and not attributes.isspace():
            for key, a, b, c in ATTRIBUTE.findall(attributes):
                key = key.lower()
                if key in ("class", "id", "role"):
                    for word in (a or b or c).split():
                        parts = [w.lower() for w in WORD.findall(word)]
                        words.update(parts)
                        self.marked = self.marked or (bool(AWAY_WORDS.intersection(parts)) and parts[0] not in HAVING)
                        self.plain = self.plain or (bool(parts) and MAIN_WORDS.issuperset(parts))
                elif key == "hidden" or (key == "aria-hidden" and (a or b or c) == "true") or (key == "style" and "display:none" in (a or b or c).replace(" ", "")):
                    self.away = True
        self.main = name in ("article", "main") or bool(words & MAIN_WORDS)
        self.readers = bool(words & READER_WORDS)
        self.heading, self.h1 = len(name) == 2 and name[0] == "h" and name[1].isdigit(), name == "h1"
        # the nearest open elements that an implied end tag may close, up to the nearest scope
        open_near = parent.near if parent and name not in SCOPES else {}
        self.near = {**open_near, name: self} if name in IMPLIED else open_near


class Block:
    __slots__ = ("element", "linked", "text")

    def __init__(self, element: Element, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked


def parse(html: str) -> tuple[list[Block], list[Element]]:
    """The page's blocks in order (white space as one space, character references decoded, no markup) and its elements, parents first."""
    blocks: list[Block] = []
    at = Element("html", None, "")
    elements = [at]
    is_open = {"html": 1}
    parts: list[str] = []
    links, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(at, text, min(linked, len(text))))
            at.chars += len(text)
        parts.clear()
        linked = 0

    def close(to: Element) -> None:
        """Goes up to an element that stays open."""
        nonlocal at
        while at is not to:
            is_open[at.name] -= 1
            at = at.parent

    position = 0
    while True:
        m = TAG.search(html, position)
        piece = html[position : m.start() if m else len(html)]
        if piece:
            piece = unescape(piece)
            parts.append(piece)
            linked += len(piece) * (links > 0)
        if not m:
            break
        position = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name == "br" or name == "wbr":
            parts.append(" " if name == "br" else "")
            continue
        if not m[1]:
            if name in RAW:
                end = ENDS[name].search(html, position)
                position = end.start() if end else len(html)
                continue
            if name == "a":
                links = 1
            if name in BREAKS or name in AWAY:
                flush()
                for closed in (("p",) if name in ENDS_P else (), CLOSES.get(name, ())):
                    found = [at.near[x] for x in closed if x in at.near]
                    if found:
                        close(max(found, key=lambda e: e.depth).parent)
                if name not in VOID and name not in ("html", "body"):
                    at = Element(name, at, m[3])
                    elements.append(at)
                    is_open[name] = is_open.get(name, 0) + 1
        elif name == "a":
            links = 0
        elif name in BREAKS or name in AWAY:
            flush()
            if is_open.get(name) and name != "html":
                while at.name != name:
                    close(at.parent)
                close(at.parent)
    flush()
    for e in reversed(elements):
        if e.parent:
            e.parent.chars += e.chars
    return blocks, elements


class Path:
    """What holds for an element by those that it stands in: each value follows from the parent's and the element's own."""

    __slots__ = ("away", "heading", "h1", "main", "marked", "marked_heading", "of_article", "readers", "site", "small")


def wrappers(blocks: list[Block], elements: list[Element]) -> set[Element]:
    """Elements that their name or words call boilerplate although they hold the main text.

    A share of the text isn't enough, as comments or a sidebar may be longer than the article. A marked element must
    hold the headline, or, where no main element stands outside of marked ones, most of its text in a main element.
    It must also be large or have a main word itself. A form must be large and hold a main element, a headline or prose.
    """
    if not any(e.marked or e.name == "form" for e in elements):
        return set()
    least = WRAPPER * elements[0].chars
    for e in elements:
        e.offers = e.nests = e.solid = False
        e.best = 0
    for b in blocks:
        b.element.solid = True
        b.element.offers = b.element.offers or len(b.text) - b.linked >= PROSE
    # upwards: solid elements hold a block that no boilerplate stands around, offers is what a form needs below it
    forms: set[Element] = set()
    for e in reversed(elements):
        if e.marked or (e.away and e.name != "form"):
            continue
        if e.name == "form" and e.offers and e.chars > least:
            forms.add(e)
        if e.parent:
            e.parent.solid = e.parent.solid or e.solid
            e.parent.offers = e.parent.offers or e.offers or (e.solid and (e.main or e.h1))
    # downwards
    for e in elements:
        p, up = Path(), e.parent.path if e.parent else None
        p.away = (e.away and e not in forms) or bool(up and up.away)
        p.marked = e.marked or bool(up and up.marked)
        p.readers = (e.marked and e.readers) or bool(up and up.readers)
        p.small = (e.marked and not (e.chars > least or e.main)) or bool(up and up.small)
        p.main = e.main or bool(up and up.main)
        p.h1 = e.h1 or bool(up and up.h1)
        p.of_article = e.name in ("article", "main") or bool(up and up.of_article)
        p.site = (e.name == "header" and not (up and up.of_article)) or bool(up and up.site)
        e.path = p
    clean = clean_main = 0
    headline: Element | None = None
    for b in blocks:
        p = b.element.path
        if p.away:
            continue
        if not p.marked:
            clean += len(b.text)
            clean_main += len(b.text) * p.main
        elif not p.readers:
            b.element.nests = True
        if headline is None and p.h1 and 2 * b.linked < len(b.text) and not p.site and not p.small:
            headline = b.element
    found: set[Element] = set()
    while headline is not None:
        if headline.marked and not (headline.readers and clean_main >= PROSE):
            found.add(headline)
        headline = headline.parent
    if clean_main < PROSE:
        for e in reversed(elements):
            # a main element by its words alone may be part of a sidebar beside text that nothing marks
            if e.nests and e.main and (e.plain or not e.marked) and (clean < PROSE or e.name in ("article", "main")):
                e.best = max(e.best, e.chars)
            if e.marked and (e.chars > least or e.main) and 2 * e.best > e.chars:
                found.add(e)
            if e.parent:
                e.parent.nests = e.parent.nests or e.nests
                e.parent.best = max(e.parent.best, e.best)
    return found | forms


def costs(blocks: list[Block], elements: list[Element]) -> list[float]:
    """For each block the cost of calling it boilerplate less that of calling it content."""
    wrapping = wrappers(blocks, elements)
    for e in elements:
        p, up = Path(), e.parent.path if e.parent else None
        p.main = e.main or bool(up and up.main)
        p.heading = e.heading or bool(up and up.heading)
        p.of_article = e.name in ("article", "main") or bool(up and up.of_article)
        # what the elements say of blocks of text, and of headings among them
        p.marked, p.marked_heading = (up.marked, up.marked_heading) if up else (0.0, 0.0)
        if e.name == "header":
            p.marked = min(p.marked, HEADER_COST)
            # a heading at the head of an article belongs to it
            p.marked_heading = up.away if up and up.of_article else HEADER_COST
        elif e.marked and e not in wrapping:
            p.marked, p.marked_heading = min(p.marked, MARKED_COST), min(p.marked_heading, MARKED_COST)
        p.away = up.away if up else 0.0
        if e.away and e.name != "header" and e not in wrapping:
            p.away = min(p.away, AWAY_COST)
        e.path = p
    said = []
    for b in blocks:
        p = b.element.path
        said.append(min(p.away, p.marked_heading if p.heading else p.marked))
    # a main element within boilerplate, as the text of a comment, says nothing of the rest
    has_main = any(b.element.path.main and not path for b, path in zip(blocks, said, strict=True))
    lengths = [len(b.text) for b, path in zip(blocks, said, strict=True) if not path]
    # the length of the block in which a code point of the page stands, on average
    typical = min(TYPICAL, sum(n * n for n in lengths) / sum(lengths)) if lengths else TYPICAL
    out = []
    for b, path in zip(blocks, said, strict=True):
        p, n = b.element.path, len(b.text)
        cost = path + min(MOST, max(LEAST, LENGTH * log2(2 * n / typical)))
        cost += ENDED * (b.text[-1] in ".!?…:\"'”»")
        if p.heading:
            cost += HEADING
        else:
            cost += (LINKED if p.main else LINKED_OUTSIDE) * b.linked / n
        out.append(cost + (MAIN if p.main else OUTSIDE if has_main else NO_MAIN))
    return out


def steps(a: Element, b: Element) -> int:
    """Steps from one element to the other through the tree."""
    n = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def minimum_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes lie on the source's side of the minimum cut.

    cost above 0 is capacity from the source, below 0 capacity to the sink; edges carry their weight both ways.
    Shortest augmenting paths, found level by level from all nodes that still have something to send.
    """
    n = len(cost)
    # a node without a cost goes with those that it is tied to, so only these cases need no search
    if not edges or min(cost) > 0 or max(cost) <= 0:
        return [c > 0 for c in cost]
    send, take = [max(c, 0.0) for c in cost], [max(-c, 0.0) for c in cost]
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += (b, a)
        room += (w, w)
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if send[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            if take[i] > tiny:
                reached = True
            for e in out[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [v >= 0 for v in level]
        current = [0] * n
        for start in range(n):
            path: list[int] = []
            i = start
            while send[start] > tiny and level[start] == 0:
                if take[i] > tiny:
                    flow = min([send[start], take[i], *(room[e] for e in path)])
                    send[start] -= flow
                    take[i] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    # back to where the path broke
                    for k, e in enumerate(path):
                        if room[e] <= tiny:
                            i = to[e ^ 1]
                            del path[k:]
                            break
                    continue
                while current[i] < len(out[i]):
                    e = out[i][current[i]]
                    if room[e] > tiny and level[to[e]] == level[i] + 1:
                        break
                    current[i] += 1
                else:
                    if not path:
                        break
                    level[i] = -2
                    i = to[path.pop() ^ 1]
                    current[i] += 1
                    continue
                path.append(e)
                i = to[e]


def main_blocks(html: str) -> list[str]:
    """Texts of the blocks that the cut leaves with the content."""
    blocks, elements = parse(html)
    if not blocks:
        return []
    edges, last = [], {}
    for k, b in enumerate(blocks):
        parent = id(b.element.parent)
        before = last.get(parent)
        if k:
            edges.append((k - 1, k, NEXT / (1 + steps(blocks[k - 1].element, b.element))))
        if before is not None:
            edges.append((before, k, SIBLING / (1 + steps(blocks[before].element, b.element))))
        last[parent] = k
    return [b.text for b, keep in zip(blocks, minimum_cut(costs(blocks, elements), edges), strict=True) if keep]


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars (code points), n_blocks (blocks kept).

    text holds the kept blocks in page order, one space between them; it is empty where the page is null, empty or
    all boilerplate. Character references are decoded once; runs of white space are one space. Repeated rows and
    null identifiers are kept; an empty table gives an empty result; other columns are ignored.
    """
    names = ["page_id", "url", "text", "n_chars", "n_blocks"]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                kept = [main_blocks(h.as_py()) for h in part.column(2)]
                texts = [" ".join(k) for k in kept]
                columns = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(k) for k in kept], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), shared.text_of(html_col))
    return shared.map_arrow(rows, extracted, "page_id long, url string, text string, n_chars long, n_blocks long")


def op1_html_extraction(spark, sf_dir):
    return extract_text(shared.table(spark, sf_dir, "pages"))
