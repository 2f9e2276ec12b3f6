"""Main text of HTML pages by minimum-cut labelling.

1. A page is cut into blocks of text at block-level tags; scripts, styles and
   form controls never make blocks.
2. A linear classifier scores each block from its length, links, stops and
   element, the text its container holds beside the page's other containers, its
   depth beside theirs, its neighbours' scores, and its nearest telling ancestor
   (element; class, id and role words weigh less).  A positive score is the cost
   of calling the block boilerplate (capacity from the source), a negative one
   that of calling it content (to the sink).
3. Neighbouring blocks, and the next block of the same container, are joined by
   smoothness edges that weigh more the closer they are in the DOM: within a
   container as much as a whole sentence's score, so that a short line goes with
   the paragraphs around it; across a telling element hardly anything.
4. Max-flow: blocks on the source's side of the minimum cut are the content.

Blocks in a row that share the container and the sign of their score are one
node, so a page's graph is small however long its article is.
"""

from __future__ import annotations

import html
import re
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import attach

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?",
                        re.IGNORECASE)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas select textarea button title "
                    "audio video datalist".split())
#: Of these, ones whose content is not parsed for tags.
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
                  "option p pre section summary table tbody td tfoot th thead tr ul".split())
#: An element that opens while one of these is open closes it first.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ENDS_P = BLOCK - {"li", "dt", "dd", "tr", "td", "th", "option", "body", "html"}
GOOD_TAGS, BAD_TAGS = frozenset(("article", "main")), frozenset("nav footer header aside form menu dialog".split())
GOOD_WORDS = frozenset("article content post entry story main body text prose".split())
BAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs pagination pager footer foot header masthead sidebar aside complementary "
    "contentinfo widget widgets notice notices alert cookie cookies consent gdpr privacy popup modal overlay dialog "
    "comment comments commentlist respond reply replies disqus discussion related recommended recommendations "
    "share sharing social follow newsletter subscribe subscription signup login search searchform form toolbar "
    "copyright legal disclaimer skip hidden".split())
#: Words of a class that make it a frame for everything, telling nothing.
FRAME_WORDS = frozenset("wrap wrapper container layout page site app root with has no".split())
#: What a telling element, and a telling word in its class, id or role, add to a score.
GOOD_TAG, GOOD_WORD, BAD_TAG, BAD_WORD = 2.0, 1.0, -4.0, -3.0
PARAGRAPHS = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6".split())
#: Edges: neighbours of different containers, neighbours of one, the next of a container further on.
NEAR, BESIDE, SAME = 1.0, 3.0, 1.5


def _verdict(tag: str, attributes: str) -> float:
    """Above 0: an element for content, below: for boilerplate, 0: not telling."""
    found = GOOD_TAG if tag in GOOD_TAGS else BAD_TAG if tag in BAD_TAGS else 0.0
    if not attributes or tag in ("body", "html"):
        return found
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return BAD_TAG
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                return BAD_TAG
        elif name in ("class", "id", "role"):
            words = {w.lower() for w in _WORDS.findall(value)}
            if words & FRAME_WORDS:
                continue
            if words & BAD_WORDS:
                return min(found, BAD_WORD)
            if words & GOOD_WORDS and not found:
                found = GOOD_WORD
    return found


class Blocks:
    """The text blocks of a page: (text, tag, container, verdict, depth, link share)."""

    def __init__(self, page: str):
        self.out: list[tuple] = []
        self.stack: list[tuple] = []  # (tag, container number, verdict, in an article)
        self.text: list[str] = []
        self.link = self.linked = 0  # open links; characters in links of this block
        self.containers = 0
        at, skip = 0, None
        inner: list[str] = []  # open within the skipped element
        lower = None
        for m in iter(lambda: _TAG.search(page, at), None):
            if m.start() > at and not skip:
                self.add(page[at:m.start()])
            at = m.end()
            tag = m.group(2)
            if tag is None:
                if not skip and m.group().startswith("<![CDATA["):
                    self.text.append(m.group()[9:-3])
                continue
            tag = tag.lower()
            if tag == "head":  # what may stand in it has no text; its end tag may be left out
                continue
            if skip and m.group(1):
                if tag in inner:
                    del inner[len(inner) - 1 - inner[::-1].index(tag):]
                    continue
                if tag == skip:
                    skip = None
                    continue
                if all(s[0] != tag for s in self.stack):
                    continue
                skip = None  # left open, it ends with its parent
            if skip and tag not in RAW:
                if tag not in VOID and not m.group(3).rstrip().endswith("/"):
                    inner.append(tag)
                continue
            if not m.group(1) and tag in SKIPPED:
                if tag in RAW:
                    if lower is None:
                        lower = page.lower() if len(page.lower()) == len(page) else page
                    end = lower.find(f"</{tag}", at)
                    close = page.find(">", end) if end >= 0 else -1
                    if tag == "title" and end < 0:
                        continue
                    at = close + 1 if close >= 0 else len(page)
                elif not m.group(3).rstrip().endswith("/"):
                    skip, inner = tag, []
                continue
            self.tag(tag, bool(m.group(1)), m.group(3))
        if not skip:
            self.add(page[at:])
        self.flush()

    def add(self, piece: str) -> None:
        self.text.append(piece)
        if self.link:
            self.linked += len(piece.strip())

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.text)).split())
        if text:
            tag, container, verdict, inside = "body", 0, 0.0, False
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in BLOCK:
                    tag = self.stack[i][0]
                    container = self.stack[i - 1][1] if i else 0  # unless an ancestor tells: the parent
                    break
            for depth in range(len(self.stack) - 1, -1, -1):
                s = self.stack[depth]
                if s[2]:
                    container, verdict, inside = s[1], s[2], s[3]
                    if s[0] == "header" and inside and tag in ("h1", "h2"):
                        verdict = GOOD_TAG  # an article's own heading
                    break
            links = min(1.0, self.linked / len(text))
            self.out.append((text, tag, container, verdict, len(self.stack), links))
        self.text, self.linked = [], 0

    def tag(self, tag: str, closing: bool, attributes: str) -> None:
        if tag == "br" or tag in ("img", "wbr"):
            self.text.append(" " if tag == "br" else "")
            return
        if tag in BLOCK:
            self.flush()
        if closing:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    self.link -= sum(s[0] == "a" for s in self.stack[i:])
                    del self.stack[i:]
                    break
            return
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCK and tag != "a":
            return
        closes = CLOSES.get(tag) or (("p",) if tag in _ENDS_P else ())
        while self.stack and closes:
            # inline elements that were left open end with their block
            i = len(self.stack) - 1
            while i >= 0 and self.stack[i][0] not in BLOCK:
                i -= 1
            if i < 0 or self.stack[i][0] not in closes:
                break
            self.link -= sum(s[0] == "a" for s in self.stack[i:])
            del self.stack[i:]
        self.containers += 1
        inside = bool(self.stack) and self.stack[-1][3] or tag in GOOD_TAGS
        verdict = _verdict(tag, attributes) if tag in BLOCK or attributes else 0.0
        if tag not in BLOCK and verdict > 0:
            verdict = 0.0
        self.stack.append((tag, self.containers, verdict, inside))
        self.link += tag == "a"


def own_score(text: str, tag: str, verdict: float, links: float) -> float:
    """What a block says by itself: above 0 content, below 0 boilerplate."""
    n = text.count(" ") + 1
    s = verdict + 0.02 * min(n, 60) - (1.0 if verdict > 0 else 2.5) * links
    if n >= 5 and text[-1] in ".!?:;\"')”»…":
        s += 0.8
    if tag in PARAGRAPHS:
        s += 0.5
    elif tag in ("li", "td", "th", "option", "dt", "dd"):
        s -= 0.3
    if n < 4:
        s -= 0.6
    low = text.lower()
    if verdict <= 0 and (n < 40 and low.startswith(("©", "(c)", "copyright"))
                         or n < 12 and ("©" in text or "(c)" in low or "all rights reserved" in low)):
        s -= 2.0
    return s - 0.2


def scores(blocks: list[tuple]) -> list[float]:
    """The classifier: each block by itself, in its container and among its
    neighbours.  Blocks of a boilerplate element gain nothing from the text
    around them."""
    own = [own_score(b[0], b[1], b[3], b[5]) for b in blocks]
    held: dict[int, float] = {}
    deep: dict[int, int] = {}
    text = in_paragraphs = 0.0
    for b in blocks:
        plain = len(b[0]) * (1.0 - b[5])
        text += plain
        if b[1] in PARAGRAPHS:
            in_paragraphs += plain
        if b[3] >= 0:
            held[b[2]] = held.get(b[2], 0.0) + plain
            deep.setdefault(b[2], b[4])
    main = max(held, key=held.get, default=None)  # ties: the first on the page
    out = []
    for i, b in enumerate(blocks):
        s = own[i]
        if b[3] >= 0:
            s += 0.8 * (2.0 * held[b[2]] / max(held[main], 1.0) - 1.0)
            if not b[3]:
                s -= 0.5 * min(abs(b[4] - deep[main]), 3)
                if b[1] not in PARAGRAPHS and 2.0 * in_paragraphs > text:
                    s -= 1.2  # loose text on a page of paragraphs
            for j in (i - 1, i + 1):
                if 0 <= j < len(blocks) and blocks[j][2] == b[2]:
                    s += 0.2 * max(-1.0, min(own[j], 1.0))
        out.append(s)
    return out


def min_cut(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Max-flow by level graphs: terminal[i] > 0 is a capacity from the source
    to i, < 0 one from i to the sink; edges carry both ways.  True for nodes on
    the source's side of the minimum cut (what the source reaches still)."""
    n = len(terminal)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def edge(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, t in enumerate(terminal):
        if t > 0:
            edge(source, i, t, 0.0)
        elif t < 0:
            edge(i, sink, -t, 0.0)
    for a, b, w in edges:
        edge(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        todo = deque([source])
        while todo:
            a = todo.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    todo.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while tried[a] < len(out[a]):
                e = out[a][tried[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    break
                tried[a] += 1
            else:
                if a == source:
                    break
                a = to[path.pop() ^ 1]
                tried[a] += 1
                continue
            path.append(e)
            a = to[e]


def labels(blocks: list[tuple], score: list[float]) -> list[bool]:
    """True for content: the source's side of the minimum cut."""
    node_of, nodes = [], []  # nodes: [score, container, depth, verdict]
    for b, s in zip(blocks, score, strict=True):
        if nodes and nodes[-1][1] == b[2] and (nodes[-1][0] > 0) == (s > 0):
            nodes[-1][0] += s
        else:
            nodes.append([s, b[2], b[4], b[3]])
        node_of.append(len(nodes) - 1)
    edges, last = [], {}
    for i, (_, container, depth, verdict) in enumerate(nodes):
        if i and nodes[i - 1][1] == container:
            edges.append((i - 1, i, BESIDE))
        elif i:
            far = 1 + abs(depth - nodes[i - 1][2]) if nodes[i - 1][3] == verdict else 3
            edges.append((i - 1, i, NEAR / (1 + far)))
        if last.get(container, i - 1) < i - 1:
            edges.append((last[container], i, SAME / (i - last[container])))
        last[container] = i
    side = min_cut([x[0] for x in nodes], edges) if nodes else []
    return [side[k] for k in node_of]


def main_text(page: str | None) -> str:
    """The main text of a whole page; null or no content: empty."""
    blocks = Blocks(page or "").out
    return "\n".join(b[0] for b, keep in zip(blocks, labels(blocks, scores(blocks)), strict=True) if keep)


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col`` string, the main text.  Each row by itself:
    repeated rows, ties and empty tables need nothing special; null and empty
    pages have the empty text; other columns pass through, a clashing name
    raises."""
    return attach(pages, html_col, out_col, "string", lambda: lambda ps: [main_text(p) for p in ps], rows=64)


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    return (extract(rows, "html", "text")
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
