"""Main text of web pages, by a tree-structured graphical model over the DOM.

Every element of a page is a node that is content, or around content, or apart from it.  The
model has a potential for what a node looks like (tag, words of class, id and role, length and
link density of its text), one for the root, and one for each parent and child, which depends on
the tag of the child.  All are
counted on labelled pages.  Sum-product messages, first from the leaves up and then from the
root down, give the exact marginal of every node on its whole page; the text of nodes that are
more likely content than not is the main text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import texts
from staylens.llm.html_pages import labelled_pages

# How the markup language treats its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title svg".split())
NEVER = RAW | frozenset("head button input form nav".split())
#: Nodes that stand in a line of text: they neither close a paragraph nor end its block.
PHRASING = RAW - {"title"} | frozenset("area audio button embed img input link meta param source track video".split())
#: Their text belongs to the block around them.  What separates words on the page does so in the text.
THROUGH = frozenset(
    "object canvas noscript select optgroup option picture map ruby rb rt rtc rp output meter progress slot nobr "
    "math semantics annotation annotation-xml mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded "
    "mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd".split()
)
APARTED = frozenset("img svg iframe embed input textarea audio video button object canvas select optgroup option mspace mtr mtd".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
#: An opening tag closes an open element of its own kind up to the nearest of these.
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
}
#: Blocks close an open paragraph.
SCOPES = frozenset("html body table td th ul ol dl div section article main aside nav header footer form blockquote".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z*][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")

STATES = AROUND, APART, CONTENT = 0, 1, 2
#: Added to the counts of features; one never seen in training counts nothing.
SMOOTH = 0.1


@dataclass
class Node:
    tag: str
    parent: int
    names: tuple[str, ...] = ()
    content: bool = False
    chars: int = 0
    link_chars: int = 0
    children: list[int] = field(default_factory=list)


@dataclass
class Page:
    """Nodes in page order, and blocks of text ``(node, text)`` in page order."""

    nodes: list[Node]
    blocks: list[tuple[int, str]]


def parse(source: str) -> Page:
    """The tree and its text blocks; broken, unclosed and cut-off markup is read as far as it goes.

    Inline elements are no nodes: their text belongs to the block around them.  Elements whose
    inside is no text for readers are nodes without blocks.  A button, audio or video has blocks
    of its own within a block that goes on after it.
    """
    nodes = [Node("#root", -1)]
    stack = [0]
    links = 0
    parts: list[str] = []
    blocks: list[tuple[int, str]] = []
    #: Text before an open phrasing node, by the depth of that node.
    waiting: dict[int, list[str]] = {}

    def end_block() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append((stack[-1], text))

    def say(text: str) -> None:
        parts.append(text)
        size = len(text.strip())
        nodes[stack[-1]].chars += size
        if links:
            nodes[stack[-1]].link_chars += size

    def close_to(depth: int) -> None:
        # What waits is text of a node further up: of the one that stays, it goes on.
        while len(stack) > depth:
            end_block()
            stack.pop()
            parts.extend(waiting.pop(len(stack), ()))

    at, end = 0, len(source)
    while at < end:
        token = TOKEN.search(source, at)
        if token is None:
            say(html.unescape(source[at:]))
            break
        if token.start() > at:
            say(html.unescape(source[at : token.start()]))
        at = token.end()
        if token["cdata"] is not None:
            say(token["cdata"])
        if token["name"] is None:
            continue
        name, marked = token["name"].lower(), False
        if name[0] == "*":
            name, marked = name[1:], True
        if name in APARTED:
            parts.append(" ")
        if name in THROUGH:
            continue
        if token["close"]:
            if name in INLINE:
                links -= name == "a" and links > 0
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == name:
                    close_to(depth)
                    links = links if name in PHRASING else 0
                    break
            else:
                if name not in PHRASING:
                    end_block()
            continue
        if name in INLINE:
            links += name == "a"
            if name == "br":
                parts.append(" ")
            continue
        if name not in PHRASING:
            end_block()
            closes = CLOSES.get(name, {"p"})
            for depth in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[depth]].tag
                if tag in closes:
                    close_to(depth)
                elif tag in SCOPES or tag in PHRASING:
                    break
        names = tuple(w for m in NAMES.finditer(token["rest"]) for w in WORD.findall((m[1] or m[2] or m[3] or "").lower()))
        nodes.append(Node(name, stack[-1], names, marked))
        nodes[stack[-1]].children.append(len(nodes) - 1)
        if name in VOID or token["rest"].endswith("/") and name in RAW:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*[^>]*(?:>|\Z)", re.I).search(source, at)
            at = close.end() if close else end
            continue
        if name in PHRASING:
            waiting[len(stack)] = parts[:]
            parts.clear()
        else:
            links = 0
        stack.append(len(nodes) - 1)
    close_to(1)
    end_block()
    return Page(nodes, blocks)


def looks(page: Page) -> list[tuple[str, ...]]:
    """The features of every node; lengths are those of all text below it."""
    nodes = page.nodes
    chars = [n.chars for n in nodes]
    links = [n.link_chars for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        chars[nodes[i].parent] += chars[i]
        links[nodes[i].parent] += links[i]
    found = []
    for i, node in enumerate(nodes):
        density = min(3, 4 * links[i] // chars[i]) if chars[i] else 4
        size = 0 if not chars[i] else 1 if chars[i] < 25 else 2
        found.append((f"tag {node.tag}", f"links {density}", f"size {size}", *(f"name {w}" for w in dict.fromkeys(node.names))))
    return found


@dataclass
class Model:
    """Log potentials: of a feature per state, and of a child's state after its parent's."""

    root: tuple[float, ...]
    unary: dict[str, tuple[float, ...]]
    edge: dict[str, tuple[tuple[float, ...], ...]]
    any_edge: tuple[tuple[float, ...], ...]


def states(page: Page) -> list[int]:
    """The states of a labelled page: what is marked is content, what holds some is around it."""
    found = [CONTENT if n.content else APART for n in page.nodes]
    for i in range(len(found) - 1, 0, -1):
        above = page.nodes[i].parent
        if found[i] != APART and found[above] == APART:
            found[above] = AROUND
    return found


def train(labelled: Iterable[str] | None = None) -> Model:
    """Potentials counted on pages whose content elements are marked with ``*``; by default our own."""
    seen = [Counter() for _ in STATES]
    pairs: dict[str, np.ndarray] = {}
    every = np.zeros((3, 3))
    totals = [0, 0, 0]
    roots = np.full(3, SMOOTH)
    for source in labelled_pages() if labelled is None else labelled:
        page = parse(source)
        found = states(page)
        for node, state, features in zip(page.nodes, found, looks(page), strict=True):
            totals[state] += 1
            seen[state].update(features)
            if node.parent >= 0:
                pairs.setdefault(node.tag, np.zeros((3, 3)))[found[node.parent], state] += 1
                every[found[node.parent], state] += 1
            else:
                roots[state] += 1
    unary = {
        f: tuple(math.log((seen[s][f] + SMOOTH) / (totals[s] + 2 * SMOOTH)) for s in STATES)
        for f in {*seen[0], *seen[1], *seen[2]}
    }
    # A tag borrows what all tags do; what never happens, as content in what is apart, stays rare.
    overall = (every + 0.02) / (every + 0.02).sum(axis=1, keepdims=True)
    borrowed = {t: (m + 2 * overall) / (m + 2 * overall).sum(axis=1, keepdims=True) for t, m in pairs.items()}
    logs = lambda m: tuple(tuple(math.log(x) for x in row) for row in m.tolist())
    return Model(
        tuple(math.log(x) for x in (roots / roots.sum()).tolist()), unary, {t: logs(m) for t, m in borrowed.items()}, logs(overall)
    )


def _log_sum(a: float, b: float, c: float) -> float:
    top = max(a, b, c)
    return top + math.log(math.exp(a - top) + math.exp(b - top) + math.exp(c - top))


def marginals(page: Page, model: Model) -> list[float]:
    """P(content) of every node, by messages up to the root and down again."""
    nodes = page.nodes
    below: list[list[float]] = []
    for node, features in zip(nodes, looks(page), strict=True):
        scores = [0.0, 0.0, 0.0]
        for f in features:
            known = model.unary.get(f)
            if known:
                scores[0] += known[0]
                scores[1] += known[1]
                scores[2] += known[2]
        if node.tag in NEVER:
            scores[CONTENT] -= 50.0
        below.append(scores)
    for s in STATES:
        below[0][s] += model.root[s]
    edges = [model.edge.get(n.tag, model.any_edge) for n in nodes]
    # Upward: what the subtree of a node says about the state of its parent.
    up: list[tuple[float, ...]] = [(0.0, 0.0, 0.0)] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        x, y, z = below[i]
        up[i] = tuple(_log_sum(e[0] + x, e[1] + y, e[2] + z) for e in edges[i])
        parent = below[nodes[i].parent]
        for s in STATES:
            parent[s] += up[i][s]
    # Downward: what the rest of the page says about a node.
    belief = below
    for i in range(1, len(nodes)):
        parent, e, sent = belief[nodes[i].parent], edges[i], up[i]
        x, y, z = parent[0] - sent[0], parent[1] - sent[1], parent[2] - sent[2]
        for s in STATES:
            belief[i][s] += _log_sum(x + e[0][s], y + e[1][s], z + e[2][s])
    return [math.exp(b[CONTENT] - _log_sum(*b)) for b in belief]


def main_text(source: str, model: Model) -> str:
    """The blocks of content nodes in page order, one a line."""
    page = parse(source)
    likely = marginals(page, model)
    return "\n".join(text for node, text in page.blocks if likely[node] > 0.5)


def extract(
    pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``; a null page is an empty one.

    White space inside a block becomes one space; pages without content have an empty text.
    ``n_chars`` counts code points.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            found = [main_text(t, fitted) for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
