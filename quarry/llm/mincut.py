"""HTML extraction by minimum cuts.

A page becomes text blocks in page order. A classifier's costs for calling
a block content or boilerplate, from its words, links and end alone, are the capacities from the source and to
the sink. Elements that tell what they hold (an article; a menu, a footer, a
form, a name such as "comments") are nodes on their side of the cut; each block is joined to the nearest
of them, to its neighbours in the page and to its neighbours among the children of one
element. The minimum cut separates content from boilerplate: a one-word line of an article is kept by its
edges, a sentence in a menu is lost by them. Pages are independent rows, so the work is one pass over
the table without a shuffle; a task holds one page's blocks at a time.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template textarea select option svg math iframe object head title".split())
#: Elements that end a text block; br and inline elements do not.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption".split())
#: Silent elements that no block element can stand in, save in one of these.
BLOCKLESS = {"select": set(), "svg": {"foreignobject", "desc", "title"}, "math": {"annotation-xml"}}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these closes an open element of the set it names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
#: Elements and names of page furniture. A class or id is one if nothing but the words around stands with it: "site-footer" and
#: "comment-list" are, "has-sidebar", "no-comments" and "tag-news" are not.
FURNITURE = frozenset("nav footer aside form menu button dialog".split())
FURNITURE_NAME = re.compile(
    r"(?:(?:page|site|global|left|right|top|bottom|main|post|entry|article|primary|secondary|sticky|fixed|user|reader|blog|header|the|js|c|l|m|u|block|wp)[_-]+)*"
    r"(?:ads?|adverts?|advertis\w+|banner|breadcrumbs?|comments?|cookies?|consent|copyright|disqus|feedback|footer|foot|gdpr|login|masthead|menu|modal|"
    r"nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promos?|promotion|related|replies|respond|search|share|sharing|sidebar|signup|social|"
    r"sponsor\w*|subscribe|subscription|tags?|toolbar|topbar|widgets?)"
    r"(?:[_-]+(?:area|bar|block|box|buttons?|container|content|footer|form|group|header|holder|icons?|inner|items?|left|links?|list|main|menu|module|nav|"
    r"notice|outer|panel|posts?|right|section|thread|title|unit|widget|wrap|wrapper|ad|\d+))*", re.I)
FURNITURE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: A named element that holds more than this share of the page's words, or its heading or article, is a wrapper.
WRAPPER_SHARE = 0.9
#: Quotes open a value only behind "="; a tag holds no other "<", and may be cut off by the end of the page.
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/><]*)((?:[^<>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)", re.S)
_NAME = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WHITE = re.compile(r"\s+")


@dataclass(frozen=True)
class Costs:
    """Weights of the classifier (log-odds for content) and capacities of the edges."""

    heading: float = 1.0
    text_per_word: float = 0.15
    most_text: float = 3.0
    link_share: float = -5.0
    sentence: float = 1.0
    base: float = -1.5
    inside: float = 6.0
    adjacency: float = 0.8
    siblings: float = 0.8


@dataclass
class Block:
    """``parent``: the element whose child it is; ``place``: the nearest element that tells what it holds, or -1."""

    text: str
    linked: int = 0
    heading: bool = False
    parent: int = 0
    place: int = -1


@dataclass
class Place:
    """An element that tells what it holds. ``named``: only its class or id says so, which a wrapper's may as well."""

    article: bool
    named: bool
    above: int


@dataclass
class _Open:
    tag: str
    number: int
    holder: int = 0
    heading: bool = False
    article: bool = False
    place: int = -1


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Lists and tables, which hide the open items and cells around them.
LISTS = frozenset("ul ol dl table menu select".split())


@dataclass
class _Builder:
    blocks: list[Block] = field(default_factory=list)
    places: list[Place] = field(default_factory=list)
    wrappers: set[int] = field(default_factory=set)
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def end(self, stack: list[_Open]) -> None:
        text = _WHITE.sub(" ", html.unescape("".join(self.parts))).strip()
        if text:
            inner = stack[-1] if stack else _Open("", 0)
            self.blocks.append(Block(text, self.linked, inner.heading, inner.holder, inner.place))
        self.parts, self.linked = [], 0

    def settle(self) -> None:
        """Named elements that turn out to be wrappers tell nothing; their blocks look to the next one around."""
        words, total = [0] * len(self.places), 0
        for b in self.blocks:
            n = len(b.text.split())
            total += n
            if b.place >= 0:
                words[b.place] += n
        for i in range(len(self.places) - 1, -1, -1):
            above = self.places[i].above
            if above >= 0:
                words[above] += words[i]
                if i in self.wrappers:
                    self.wrappers.add(above)
        stands = list(range(len(self.places)))
        for i, p in enumerate(self.places):
            if p.named and (i in self.wrappers or words[i] > WRAPPER_SHARE * total):
                stands[i] = stands[p.above] if p.above >= 0 else -1
        for b in self.blocks:
            if b.place >= 0:
                b.place = stands[b.place]


def blocks_of(page: str) -> tuple[list[Block], list[Place]]:
    """Text blocks of a page in page order, and the elements that tell what they hold. Unclosed, misnested and cut markup is
    taken as it comes. Open elements are counted by tag, so depth costs nothing."""
    out, stack, number, at, links = _Builder(), [], 0, 0, 0
    silent, inside, ends = None, Counter(), {}
    opened, marks = Counter(), []   # open elements by tag; places in the stack of items, cells, lists and tables

    def cut(depth):
        """Close all elements from this place of the stack on."""
        for e in stack[depth:]:
            opened[e.tag] -= 1
        del stack[depth:]
        while marks and marks[-1] >= depth:
            marks.pop()

    def close(tag):
        depth = len(stack) - 1
        while stack[depth].tag != tag:
            depth -= 1
        cut(depth)

    def closes(tag):
        """Whether the tag's element is closed further on."""
        if ends.get(tag, at) <= at:
            found = re.compile(rf"</{tag}\b", re.I).search(page, at)
            ends[tag] = found.end() if found else len(page) + 1
        return ends[tag] <= len(page)

    def words(text):
        if text and silent is None:
            out.parts.append(text)
            if links:
                out.linked += len(text.split())

    for m in _MARK.finditer(page):
        if m.start() < at:
            continue
        words(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if silent is not None:
            # silence ends with its element, with one around it, or at a tag that cannot stand inside
            if m[1]:
                if inside[tag]:
                    inside[tag] -= 1
                    continue
                if tag == silent:
                    silent = None
                    continue
                if not (opened[tag] or tag == "a" and links):
                    continue
            elif silent == "option":
                if tag in ("option", "optgroup"):
                    continue
            elif tag not in BLOCK or tag == "hr" or silent not in BLOCKLESS or any(inside[x] for x in BLOCKLESS[silent]):
                if tag in ("script", "style"):
                    end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                    at = end.end() if end else at
                elif tag not in VOID and not m[3].rstrip().endswith("/"):
                    inside[tag] += 1
                continue
            silent = None
        if tag in BLOCK:
            out.end(stack)
        if m[1]:
            if tag == "a":
                links = max(links - 1, 0)
            if opened[tag]:
                close(tag)
            continue
        own_end = m[3].rstrip().endswith("/")
        if tag in SILENT and not own_end:
            if tag in ("script", "style", "title", "textarea", "noscript", "template", "iframe"):
                # raw content up to the end tag, whatever it holds
                end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                # the fallback of an object may be any blocks, so one that is never closed has none
                silent = None if tag == "head" or tag == "object" and not closes(tag) else tag
                inside.clear()
            continue
        if tag in VOID or own_end:
            if tag in ("br", "wbr", "img"):
                words(" ")
            continue
        if tag == "a":
            links += 1
            continue
        if tag in BLOCK and opened["p"] and tag not in ("li", "td", "th", "tr", "dd", "dt"):
            close("p")
        while tag in CLOSES and marks and stack[marks[-1]].tag in CLOSES[tag]:
            cut(marks[-1])
        above = stack[-1] if stack else _Open("", 0)
        names = {k.lower(): a or b or c for k, a, b, c in _NAME.findall(m[3])}
        role = names.get("role", "").lower()
        article = tag in ("article", "main") or role in ("main", "article")
        furniture = tag in FURNITURE or role in FURNITURE_ROLE or tag == "header" and not above.article
        named = tag not in ("html", "body", "h1") and any(FURNITURE_NAME.fullmatch(x) for k in ("class", "id") for x in names.get(k, "").split())
        number += 1
        place = above.place
        if (article or tag == "h1") and place >= 0:
            out.wrappers.add(place)
        if article or furniture or named:
            out.places.append(Place(article, named and not article and not furniture, place))
            place = len(out.places) - 1
        holder = number if tag in BLOCK and tag not in HEADINGS and tag not in ("p", "li") else above.holder
        if tag in CLOSES or tag in LISTS:
            marks.append(len(stack))
        opened[tag] += 1
        stack.append(_Open(tag, number, holder, above.heading or tag in HEADINGS, above.article or article, place))
    words(page[at:])
    out.end(stack)
    out.settle()
    return out.blocks, out.places


def score(b: Block, costs: Costs) -> float:
    """Log-odds that a block is content, from its own text."""
    n = len(b.text.split())
    s = costs.base + min(n * costs.text_per_word, costs.most_text) + costs.link_share * min(b.linked / n, 1.0)
    s += costs.sentence * (b.text.rstrip("\"'”’»)")[-1:] in ".!?…")
    return s + costs.heading * b.heading


class Cut:
    """Maximum flow by breadth-first levels and blocking flows, on arrays of edges."""

    def __init__(self, nodes: int):
        self.first: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[float] = []

    def edge(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.first[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.first[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def _levels(self, source: int) -> list[int]:
        level = [-1] * len(self.first)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.first[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        """Push flow until no path is left; the nodes still reachable from the source."""
        while True:
            level = self._levels(source)
            if level[sink] < 0:
                return [x >= 0 for x in level]
            at = [0] * len(self.first)
            path: list[int] = []
            node = source
            while True:
                if node == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    full = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    node = self.to[path[full] ^ 1]
                    del path[full:]
                    continue
                while at[node] < len(self.first[node]):
                    e = self.first[node][at[node]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[node] + 1:
                        break
                    at[node] += 1
                else:
                    if node == source:
                        break
                    node = self.to[path.pop() ^ 1]
                    at[node] += 1
                    continue
                path.append(e)
                node = self.to[e]


def edges_of(blocks: list[Block], places: list[Place], costs: Costs) -> list[tuple[int, int, float]]:
    """The smoothness edges (block, block or place, capacity); places are numbered behind the blocks."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if b.place >= 0:
            out.append((i, len(blocks) + b.place, costs.inside))
        if i:
            out.append((i - 1, i, costs.adjacency))
        if b.parent in last:
            out.append((last[b.parent], i, costs.siblings))
        last[b.parent] = i
    return out


def content(blocks: list[Block], places: list[Place] = (), costs: Costs = Costs()) -> list[bool]:
    """For each block, whether it lies on the content side of the minimum cut."""
    if not blocks:
        return []
    n, m = len(blocks), len(places)
    graph, source, sink = Cut(n + m + 2), n + m, n + m + 1
    for i, b in enumerate(blocks):
        s = score(b, costs)
        graph.edge(*((source, i, s) if s > 0 else (i, sink, -s)))
    for k in {b.place for b in blocks if b.place >= 0}:
        graph.edge(*((source, n + k, math.inf) if places[k].article else (n + k, sink, math.inf)))
    for a, b, room in edges_of(blocks, places, costs):
        graph.edge(a, b, room, room)
    return graph.source_side(source, sink)[:n]


def main_text(page: str | None, costs: Costs = Costs()) -> str:
    """The page's content blocks, one per line."""
    blocks, places = blocks_of(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, content(blocks, places, costs)) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", costs: Costs = Costs()) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Null or empty html gives an empty text. Null and repeated ids and urls
    stay; other columns are not read; an empty table gives an empty result.
    A block on neither side by cost (a tie) goes to boilerplate."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low in range(0, b.num_rows, 200):
                part = b.slice(low, 200)
                texts = [main_text(x, costs) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = rows.schema["page_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"page_id {kind}, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
