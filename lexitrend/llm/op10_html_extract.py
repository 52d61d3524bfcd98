"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks with the path of elements above each. A linear classifier
turns a block's path and text into a cost for either label; these costs are the capacities to
the two terminals. Neighbouring blocks, and blocks that follow each other under one parent
element, are joined by smoothness edges that are the stronger the closer the two stand in the
tree. Max-flow separates content from boilerplate; content blocks are joined by one newline.
One page is one task's work: no shuffle, no state, and a page's memory follows its size.

Results that are fixed here:

- null, empty or text-free html gives an empty text and ``n_chars`` 0;
- every row of the input gives one row, repeated ids too; null ids and urls stay null;
- character references are decoded, white space inside a block becomes one space, blocks are
  trimmed, empty blocks are left out; ``br`` is white space inside its block;
- malformed html is read leniently: unclosed elements end with their parent, stray end tags are
  ignored, an unclosed comment, script or style runs to the end;
- formulas are inline text of their block; boilerplate words on ``body``, ``html``, on wrappers of the
  main article, on headings and paragraphs, and in ids of an article's sections do not count; an
  ``address`` inside an article is part of it;
- blocks whose costs tie count as boilerplate; an empty table gives an empty result; other
  columns of the input are ignored.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, out_batch, slices, texts_of

# --- fixed values: element and cue lists ----------------------------------------------------
RAW = {"script", "style", "title", "textarea", "iframe", "noframes", "noembed", "xmp"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav",
    "noscript", "object", "ol", "option", "p", "pre", "section", "select", "summary", "svg", "table",
    "tbody", "td", "template", "tfoot", "th", "thead", "tr", "ul", "audio", "video", "canvas",
}
#: A start tag of the key ends an open element of the values (not past the given scope).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPE = {"ul", "ol", "dl", "table", "select", "menu"}
#: Never text of the page.
DROPPED = {"head", "noscript", "template", "svg", "select", "option", "button", "object", "audio",
           "video", "canvas"}
BOILER_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "address"}
BOILER_WORDS = {
    "ad", "ads", "adv", "advert", "advertisement", "advertising", "adslot", "adbox", "sponsor", "sponsored",
    "promo", "promotion", "banner", "menu", "nav", "navbar", "navigation", "sidebar", "footer", "foot",
    "masthead", "topbar", "toolbar", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "gdpr",
    "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "subscribe", "subscription",
    "newsletter", "signup", "login", "share", "sharing", "social", "related", "recommended",
    "recommendations", "comment", "comments", "commentlist", "disqus", "discussion", "reply", "replies",
    "respond", "responses", "widget", "pagination", "pager", "copyright", "legal", "skip", "search", "hidden",
    "complementary", "contentinfo",
}
#: Names (class, id, role) of these say nothing about boilerplate: headings often carry ids of their text.
TEXT_TAGS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "blockquote", "pre"}
CONTENT_TAGS = {"article", "main"}
CONTENT_WORDS = {"article", "content", "post", "entry", "story", "main", "articlebody", "text"}

# --- classifier weights (log-odds of content against boilerplate) ---------------------------
W_START = -0.6
W_DROPPED, W_BOILER_TAG, W_BOILER_WORD, W_HEADER = -30.0, -9.0, -9.0, -6.0
W_CONTENT_TAG, W_CONTENT_WORD = 5.0, 1.5
W_LINKS = -4.0            # times the share of linked characters
W_WORDS, WORDS_FULL = 2.0, 25   # times the words, up to the full number
W_SENTENCE = 0.8          # ends like a sentence
W_HEADING = 0.6
#: Smoothness: of neighbours with one parent, then less for each step between their parents.
SMOOTH, SMOOTH_DECAY = 0.8, 0.5

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<(?=[/a-zA-Z])[^>]*+$", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "parent", "depth", "weight", "boiler", "article", "out")

    def __init__(self, tag: str, attrs: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        #: The outermost article or main around this, and whether something above leaves this out.
        self.article = parent.article if parent else None
        boiler_tag = tag in BOILER_TAGS and not (tag == "address" and self.article)
        self.out = bool(parent and parent.out) or tag in DROPPED or boiler_tag
        #: Its own part; ``weigh`` adds the boilerplate words and the parent's weight.
        self.weight, self.boiler = 0.0, False
        if tag in DROPPED:
            self.weight += W_DROPPED
        elif boiler_tag:
            self.weight += W_BOILER_TAG
        elif tag == "header" and not self.article:
            self.weight += W_HEADER
        elif tag in CONTENT_TAGS and not self.article:
            self.weight += W_CONTENT_TAG
            self.article = self
        if attrs:
            self._cues(attrs)

    def _cues(self, attrs: str) -> None:
        words: set[str] = set()
        # A heading's or paragraph's names describe its text, and so does a section's id in an article.
        text = self.tag in TEXT_TAGS
        own_id = text or self.tag == "section" and self.article is not None and self.article is not self
        for name, value in _ATTR.findall(attrs):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" \
                    or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                self.weight += W_DROPPED
                self.out = True
            elif name in ("class", "role") and not text or name == "id" and not own_id:
                words.update(w.lower() for w in _NAME.findall(value))
        self.boiler = bool(words & BOILER_WORDS) and self.tag not in ("body", "html")
        if words & CONTENT_WORDS and not self.boiler and self.tag not in ("body", "html"):
            self.weight += W_CONTENT_WORD
        if "header" in words and not self.article and self.tag not in ("body", "html"):
            self.weight += W_HEADER


class Block:
    __slots__ = ("text", "parent", "net")

    def __init__(self, text: str, linked: int, parent: Element):
        self.text, self.parent = text, parent
        words = text.count(" ") + 1
        self.net = (W_LINKS * min(1.0, linked / max(1, len(text)))
                    + W_WORDS * min(1.0, words / WORDS_FULL)
                    + (W_SENTENCE if text[-1] in ".!?…。:;\"”»" else 0.0)
                    + (W_HEADING if parent.tag in ("h1", "h2", "h3", "h4", "h5", "h6") else 0.0))


def weigh(elements: list[Element], blocks: list[Block]) -> None:
    """Weights from the root on. Boilerplate words of a wrapper (an element around the page's main
    elements, or else around its longest article that is not boilerplate itself) say nothing."""
    size: dict[Element, int] = {}
    for b in blocks:
        top = b.parent.article
        if top and not top.out and not top.boiler:
            size[top] = size.get(top, 0) + len(b.text)
    inner = [e for e in size if e.tag == "main"] or sorted(size, key=size.get)[-1:]
    wrappers: set[Element] = set()
    for e in inner:
        while e.parent and e.parent not in wrappers:
            e = e.parent
            wrappers.add(e)
    elements[0].weight = W_START
    for e in elements[1:]:      # parents come before their children
        e.weight += e.parent.weight + (W_BOILER_WORD if e.boiler and e not in wrappers else 0.0)
    for b in blocks:
        b.net += b.parent.weight


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    here = root = Element("#root", "", None)
    elements = [root]
    out: list[Block] = []
    parts: list[str] = []
    linked, link_at = 0, None

    #: Open elements by tag, innermost last: ends are found without walking up the tree.
    opened: dict[str, list[Element]] = {}

    def enter(e: Element) -> Element:
        elements.append(e)
        opened.setdefault(e.tag, []).append(e)
        return e

    def leave(e: Element) -> Element:
        """Close ``e`` and all that is open inside it."""
        at = here
        while at is not e.parent:
            opened[at.tag].pop()
            at = at.parent
        return at

    def innermost(tags) -> Element | None:
        return max((opened[t][-1] for t in tags if opened.get(t)), key=lambda e: e.depth, default=None)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, here))
            parts.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        stop = token.start() if token else end
        if stop > at:
            text = html.unescape(page[at:stop])
            parts.append(text)
            if link_at is not None:
                linked += len(text.strip())
        if not token:
            break
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing, attrs = token[1] or token[4], token[3] or token[6] or ""
        if name in RAW and not closing:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = found.start() if found else end
            continue
        if name == "a":
            link_at = None if closing else here.depth
            continue
        if name == "br":
            parts.append(" ")
        if name not in BLOCK:
            continue
        flush()
        if closing:
            if opened.get(name):
                here = leave(opened[name][-1])
        elif name != "hr":
            if here.tag == "p":
                here = leave(here)
            for _ in range(2 if name in ENDS else 0):  # a cell and its row at most
                ended = innermost(ENDS[name] | SCOPE)
                if ended and ended.tag in ENDS[name]:
                    here = leave(ended)
            if not attrs.rstrip().endswith("/") or name != "svg":
                here = enter(Element(name, attrs, here))
        if link_at is not None and here.depth < link_at:
            link_at = None
    flush()
    weigh(elements, out)
    return out


#: Steps between two parents beyond which an edge would weigh next to nothing.
FAR = 12


def _distance(a: Element, b: Element) -> int:
    steps = 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(blocks: list[Block]) -> list[dict[int, float]]:
    """Edges: neighbours in page order, and blocks that follow each other under one container."""
    edges: list[dict[int, float]] = [{} for _ in blocks]
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        box = id(b.parent.parent or b.parent)
        for j in {i - 1, last.get(box, -1)}:
            if j >= 0:
                steps = max(0, _distance(b.parent, blocks[j].parent) - 2)  # siblings are two steps apart
                w = SMOOTH * SMOOTH_DECAY ** steps
                if w > 1e-3:
                    edges[i][j] = edges[j][i] = w
        last[box] = i
    return edges


EPS = 1e-9


def min_cut(net: list[float], edges: list[dict[int, float]]) -> list[bool]:
    """Labels of least total cost. ``net[i]`` above 0 is the capacity from the source, below 0
    to the sink (only the difference of the two matters); ``edges`` holds the capacities between
    blocks, both ways. Of several least cuts the one with the fewest content blocks is taken.

    A block whose own capacity outweighs all its edges has its label in every such cut; its edges then
    add to its neighbours' capacities, which may settle them too. What is left, mostly short runs of
    doubtful blocks, is solved by max-flow; the content side is what the source still reaches."""
    net, open_edges = list(net), [dict(e) for e in edges]
    label: list[bool | None] = [None] * len(net)
    todo = deque(range(len(net)))
    while todo:
        i = todo.popleft()
        if label[i] is not None:
            continue
        weight = sum(open_edges[i].values())
        if net[i] > weight + EPS or -net[i] >= weight - EPS:
            label[i] = net[i] > 0 and net[i] > weight + EPS
            for j, c in open_edges[i].items():
                net[j] += c if label[i] else -c
                del open_edges[j][i]
                todo.append(j)
            open_edges[i] = {}
    rest = [i for i, x in enumerate(label) if x is None]
    number = {i: k for k, i in enumerate(rest)}
    reached = max_flow([net[i] for i in rest], [{number[j]: c for j, c in open_edges[i].items()} for i in rest])
    for i, x in zip(rest, reached):
        label[i] = x
    return [bool(x) for x in label]


def max_flow(net: list[float], cap: list[dict[int, float]]) -> list[bool]:
    """Which blocks the source reaches after a maximum flow: level graphs from the source, and in
    each a blocking flow along paths that never look at a spent edge twice."""
    source, sink = [max(0.0, x) for x in net], [max(0.0, -x) for x in net]
    n = len(net)
    while True:
        level = [0 if source[i] > EPS else -1 for i in range(n)]
        order = deque(i for i in range(n) if level[i] == 0)
        goal = False
        while order:
            u = order.popleft()
            goal = goal or sink[u] > EPS
            for v, c in cap[u].items():
                if c > EPS and level[v] < 0:
                    level[v] = level[u] + 1
                    order.append(v)
        if not goal:
            return [x >= 0 for x in level]
        ways = [list(c) for c in cap]           # edges of each block that are still worth a look
        for start in range(n):
            while source[start] > EPS and level[start] == 0:
                path = [start]
                while path:
                    u = path[-1]
                    if sink[u] > EPS:
                        break
                    while ways[u] and not (cap[u][ways[u][-1]] > EPS and level[ways[u][-1]] == level[u] + 1):
                        ways[u].pop()
                    if ways[u]:
                        path.append(ways[u][-1])
                    else:
                        level[u] = -1           # no way on from here in this level graph
                        path.pop()
                if not path:
                    break
                flow = min(source[start], sink[path[-1]], *(cap[u][v] for u, v in zip(path, path[1:])))
                source[start] -= flow
                sink[path[-1]] -= flow
                for u, v in zip(path, path[1:]):
                    cap[u][v] -= flow
                    cap[v][u] = cap[v].get(u, 0.0) + flow


def main_text(page: str | None) -> str:
    """The content blocks of one page, joined by newlines."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    keep = min_cut([b.net for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
            url_col: str = "url") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages_ = batch.column(0), batch.column(1), batch.column(2)
            out = pa.schema([("page_id", ids.type), ("url", urls.type), ("text", pa.string()),
                             ("n_chars", pa.int64())])
            for lo, hi in slices(pages_):
                found = [main_text(t) for t in texts_of(pages_, lo, hi)]
                yield out_batch(out, {"page_id": ids.slice(lo, hi - lo), "url": urls.slice(lo, hi - lo),
                                      "text": found, "n_chars": [len(t) for t in found]})

    return map_arrow(rows, run, schema)
