"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks. A linear classifier on each block (where
it stands in the page, names of the elements around it, link share, length,
punctuation) gives a cost for calling it content and one for calling it
boilerplate: the terminal capacities. Neighbours in reading order, and
neighbours under one parent, are joined by edges that are the stronger the
closer they are in the element tree. Maximum flow then parts content from
boilerplate at the least total cost.

White space inside a block becomes one space; blocks are joined by a line feed
in page order. Defined cases: a null or empty page, and one without content,
has the text ''; broken or unclosed markup is read as far as it goes; a null
page_id or url stays null; repeated rows give repeated rows; other columns are
not read. A page is handled by one task, in time linear in its length (unclosed
tags and quotes included) but for the cut.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

# Opening and closing tags, elements without text, comments, text. A tag's end is looked for outside its quoted
# values; where that runs to the end of the page (``open``), quotes mean nothing from there on.
_PARTS = (r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe|object|select)\b{inside}>"
          r".*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*)(?P<attributes>{inside})>"
          r"|(?P<open><[/a-zA-Z]{inside}\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)")
_QUOTED = re.compile(_PARTS.replace("{inside}", r"(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+"), re.S | re.I)
_PLAIN = re.compile(_PARTS.replace("{inside}", "[^>]*+"), re.S | re.I)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|style|aria-hidden|data-ad(?:s|-[\w-]+)?)(?![\w-])"
                        r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Element and class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
OUTSIDE = frozenset("nav footer aside button menu dialog fieldset head".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Names of what an article never stands in, and of boxes that are sometimes drawn around one.
FIRM = frozenset("nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer comment comments reply replies respond "
                 "disqus related recommended recommendations pagination pager complementary contentinfo tags".split())
LOOSE = frozenset("ad ads advert adverts advertisement advertising adsbygoogle adslot adunit adbox sponsor sponsored promo promoted "
                  "promotion banner cookie cookies consent gdpr notice alert popup modal overlay widget masthead share sharing "
                  "social newsletter subscribe subscription signup login search toolbar skip copyright legal".split())
REMARKS = frozenset("comment comments reply replies respond disqus".split())
TOWARDS = frozenset("article content main post entry story text body prose".split())
LAYOUT = frozenset("has with no non without layout open closed enabled free".split())  # such a class says how a page is laid out
_SPLITS = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dd": {"dd", "dt"},
           "dt": {"dd", "dt"}, "option": {"option"}}

PAGE = frozenset("nav header footer main article aside h1".split())  # a form around one of these is around the page
# Unary costs: of what is not shown, of a place outside the article, of a box around it, of a form to fill in.
UNSEEN, OUT, BOX, FORM = 40.0, 8.0, 6.0, 6.0
IN_MAIN, BESIDE_MAIN = 2.0, 1.5  # for blocks of the page's main element, against others if there is one
ADJACENT, SIBLING = 1.5, 1.0  # smoothness of reading order and of one parent


@lru_cache(maxsize=10_000)
def names(value: str) -> frozenset[str]:
    """Words of a class, id or role value, without the classes that only tell the page's layout."""
    found: set[str] = set()
    for one in value.split():
        words = {x.lower() for x in _NAME.findall(one)}
        if not words & LAYOUT:
            found |= words
    return frozenset(found)


class _Element:
    """An open element: ``firm`` and ``loose`` are the costs of the places it stands in; main and article
    end a loose one (an advert left open, say), main ends a firm one too."""

    __slots__ = ("depth", "firm", "form", "loose", "main", "page", "parent", "tag", "towards")

    def __init__(self, tag: str, parent: "_Element | None", attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.main = bool(parent and parent.main)
        self.firm = parent.firm if parent else 0.0
        self.loose = parent.loose if parent else 0.0
        self.towards = parent.towards if parent else 0
        self.form = self if tag == "form" else parent.form if parent else None
        self.page = False  # of a form: it is around the page
        if self.form and tag in PAGE:
            self.form.page = True
        called: set[str] = set()
        role, unseen, advert = "", False, False
        for m in _ATTRIBUTE.finditer(attributes) if attributes.strip() else ():
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
                unseen = True
            elif key.startswith("data-ad"):
                advert = True
            elif key in ("class", "id", "role"):
                called |= names(value)
                role = value.strip().lower() if key == "role" else role
        if tag in MAIN or role in MAIN:
            self.loose = 0.0
            if tag == "main" or role == "main":
                self.firm = self.firm if self.firm >= UNSEEN else 0.0
            if called & REMARKS:
                self.firm = max(self.firm, OUT)
            self.main = not self.firm
        elif tag not in ("body", "html"):
            if tag in OUTSIDE or called & FIRM:
                self.firm = max(self.firm, OUT)
            if advert or called & LOOSE or not self.main and (tag == "header" or "header" in called and tag in ("div", "section")):
                self.loose = max(self.loose, BOX)
            if called & MAIN and tag in ("div", "section") and not called & (FIRM | LOOSE) and not self.firm:
                self.main = True
        if unseen:
            self.firm = UNSEEN
        self.towards += bool(called & TOWARDS)


class _Block:
    __slots__ = ("element", "linked", "parts")

    def __init__(self, element: _Element):
        self.element, self.parts, self.linked = element, [], 0


def blocks(page: str) -> list[tuple[str, _Element, float]]:
    """(text, enclosing block element, share of linked characters) in page order."""
    out: list[tuple[str, _Element, float]] = []
    at = _Element("html", None, "")
    current: _Block | None = None
    links = 0
    opened: Counter[str] = Counter()  # tags of the elements that are open

    def leave() -> None:
        nonlocal at
        opened[at.tag] -= 1
        at = at.parent

    def close() -> None:
        nonlocal current
        if current:
            text = " ".join(html.unescape("".join(current.parts)).split())
            if text:
                out.append((text, current.element, min(1.0, current.linked / len(text))))
        current = None

    token, place = _QUOTED, 0
    while place < len(page):
        m = token.match(page, place)
        raw, end, tag, attributes, rest, text = m.groups()
        if rest is not None and token is _QUOTED:
            token = _PLAIN
            continue
        place = m.end()
        if text is not None:
            if current is None:
                if text.isspace():
                    continue
                current = _Block(at)
            current.parts.append(text)
            if links:
                current.linked += len(text)
        elif tag:
            tag = tag.lower()
            if tag == "br":
                if current:
                    current.parts.append(" ")
                continue
            if tag == "a":
                links = 0 if end else 1
            if tag in INLINE:
                continue
            close()
            if tag in VOID:
                continue
            if end:
                if opened[tag]:
                    while at.tag != tag:
                        leave()
                    leave()
                links = 0
            else:
                # Elements that a new block ends: an open paragraph, the same kind of row, cell or item.
                while at.parent and (at.tag == "p" or at.tag in _SPLITS.get(tag, ()) or at.tag == "head" and tag == "body"):
                    leave()
                at = _Element(tag, at, attributes)
                opened[tag] += 1
        elif raw:
            if current:
                current.parts.append(" ")
    close()
    return out


def costs(text: str, element: _Element, linked: float, beside: bool) -> float:
    """Cost of calling a block boilerplate less that of calling it content; ``beside``: the page has a main
    element. Small against the edges but for places that leave no doubt, so that neighbours decide what is open."""
    heading = element.tag in HEADINGS
    score = -0.5 + 0.01 * min(len(text), 200) + 0.25 * min(sum(text.count(c) for c in ".,;!?"), 4)
    score += 0.5 * min(element.towards, 2) - (1.0 if heading else 3.0) * linked
    if heading or element.tag in ("p", "blockquote", "pre"):
        score += 0.5
    if element.main:
        score += IN_MAIN
    elif beside and element.tag != "h1":
        score -= BESIDE_MAIN
    return score - max(element.firm, element.loose, FORM if element.form and not element.form.page else 0.0)


def unary(found: list[tuple[str, _Element, float]]) -> list[float]:
    beside = any(e.main and not e.firm and not e.loose for _, e, _ in found)
    return [costs(*b, beside) for b in found]


def _edges(elements: list[_Element]) -> list[list[list]]:
    """Residual graph: per block [other block, capacity, index of the reverse edge]."""
    graph: list[list[list]] = [[] for _ in elements]

    def join(i: int, j: int, weight: float) -> None:
        graph[i].append([j, weight, len(graph[j])])
        graph[j].append([i, weight, len(graph[i]) - 1])

    last: dict[int, int] = {}
    for i, e in enumerate(elements):
        if i:
            a, b, steps = elements[i - 1], e, 0
            while a is not b:
                if a.depth >= b.depth and a.parent:
                    a = a.parent
                elif b.parent:
                    b = b.parent
                steps += 1
            join(i - 1, i, ADJACENT / (1 + steps))
        parent = id(e.parent)
        if parent in last and last[parent] != i - 1:
            join(last[parent], i, SIBLING)
        last[parent] = i
    return graph


def content(score: list[float], graph: list[list[list]]) -> list[bool]:
    """Minimum cut by augmenting paths; the source's side is content.

    What a block's two terminal edges share flows at once; ``excess`` is the rest.
    """
    excess = list(score)
    while True:
        came: list[tuple[int, int] | None] = [None] * len(excess)
        seen = [x > 0 for x in excess]
        queue = deque(i for i, x in enumerate(excess) if x > 0)
        ends = []
        while queue:
            i = queue.popleft()
            for k, (j, room, _) in enumerate(graph[i]):
                if room > 1e-9 and not seen[j]:
                    seen[j], came[j] = True, (i, k)
                    if excess[j] < 0:
                        ends.append(j)
                    else:
                        queue.append(j)
        if not ends:
            return seen
        for end in ends:
            path, i, flow = [], end, -excess[end]
            while came[i] is not None:
                path.append(came[i])
                flow = min(flow, graph[came[i][0]][came[i][1]][1])
                i = came[i][0]
            flow = min(flow, excess[i])
            if flow <= 0:
                continue
            for a, k in path:
                graph[a][k][1] -= flow
                graph[graph[a][k][0]][graph[a][k][2]][1] += flow
            excess[i] -= flow
            excess[end] = 0.0 if excess[end] + flow > -1e-9 else excess[end] + flow
            if excess[i] < 1e-9:
                excess[i] = 0.0


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = content(unary(found), _edges([b[1] for b in found]))
    return "\n".join(b[0] for b, k in zip(found, keep) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 500):
            part = b.slice(at, 500)
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
