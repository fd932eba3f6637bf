"""Main text of web pages by minimum-cut labelling.

A page becomes a line of text blocks. What a block and its surroundings say for and against
it are the capacities of its edges to the two terminals; neighbouring blocks, and blocks next
to each other under one parent, are tied by smoothness edges that weaken with their distance
in the tree. A minimum cut then parts content from boilerplate for the whole page at once.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import added, in_arrow

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|object|select|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\s+(?:[^\s\"'<>/=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?|/))*\s*/?)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|aria-label|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_SPACE = re.compile(r"\s+")

_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that end an open tag of the same family without an end tag.
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_AGAINST_TAGS = frozenset("nav footer aside form button menu dialog input".split())
_FOR_TAGS = frozenset("article main".split())
#: Words that name boilerplate, or content, as a whole class or as a part of one (``cookie-notice``).
_AGAINST = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar sidebar "
    "widget cookie cookies consent notice alert popup modal overlay subscribe newsletter signup login share sharing social comment comments reply replies respond disqus "
    "related recommended trending pagination pager copyright search form toolbar skip disclaimer gdpr".split()
)
_FOR = frozenset("article articlebody content main post entry story".split())
#: Whole classes that say what their parts do not.
_AGAINST_WHOLE, _FOR_WHOLE = frozenset("site-header siteheader side-bar".split()), frozenset("body-text".split())
#: First parts of a class that speaks of what an element lacks, has or is like, not of what it is.
_ABOUT = frozenset("no not without with has is hide show long short wide full".split())
_PART = re.compile(r"[-_]+")
_AGAINST_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

#: Capacities are whole numbers, in hundredths.
MARKED, PLAUSIBLE, PROSE, LINKS, SHORT, TIE = 900, 250, 200, 400, 60, 150


@dataclass
class Block:
    """A run of text, the share of it in links, the element around it and what that says."""

    text: str
    links: float
    place: int  # number of the element
    marked: int  # -1 boilerplate, 1 content, 0 neither


class Page(list):
    """Blocks in page order, with the parent and the depth of every element by its number."""

    def __init__(self) -> None:
        super().__init__()
        self.parent, self.depth = [0], [0]


def _said(names: list[str]) -> tuple[bool, bool]:
    """Whether classes and ids name boilerplate, and whether they name content."""
    against = wanted = False
    for name in " ".join(names).lower().split():
        parts = _PART.split(name)
        if parts[0] in _ABOUT:
            continue
        if name in _AGAINST_WHOLE or not _AGAINST.isdisjoint(parts):
            # "post-comments" is comments; "comments" decides, whatever else the class names.
            against = True
        elif name in _FOR_WHOLE or not _FOR.isdisjoint(parts):
            wanted = True
    return against, wanted


def _mark(tag: str, rest: str, above: int) -> int:
    """What an element says of the text inside; boilerplate inside content is boilerplate, and nothing inside boilerplate is content."""
    if above < 0 or tag in _AGAINST_TAGS:
        return -1
    names, role = [], ""
    if rest:
        for m in _ATTRIBUTE.finditer(rest):
            value = m[2] or m[3] or m[4] or ""
            kind = m[1].lower()
            if kind == "hidden" or kind == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return -1
            if kind == "role":
                role = value.lower()
            elif kind != "style":
                names.append(value)
    against, wanted = _said(names)
    wanted = wanted or tag in _FOR_TAGS or role in ("main", "article")
    # What holds the whole page, or is named as content as well, is no boilerplate for one of its classes.
    if role in _AGAINST_ROLES or against and not wanted and tag not in ("html", "body"):
        return -1
    if tag == "header" and above == 0:
        return -1
    return 1 if wanted and tag not in ("html", "body") else above


def blocks_of(page: str) -> Page:
    """Text blocks in page order: character references decoded, white space as one space, empty ones left out.

    The work and the memory grow with the page, however deep or broken its markup is.
    """
    out = Page()
    # Tag, mark, and the number of the innermost element that is no inline one, itself included.
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked, in_link, place, marked = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
        if text:
            out.append(Block(text, min(1.0, linked / max(1, len(text))), place, marked))
        pieces.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal in_link
        for tag, _, _ in stack[at:]:
            opened[tag] -= 1
            in_link -= tag == "a"
        del stack[at:]

    def add(text: str) -> None:
        nonlocal linked, place, marked
        if not text:
            return
        if not pieces:
            _, marked, place = stack[-1]
        pieces.append(text)
        if in_link:
            linked += len(text.strip())

    end = 0
    for m in _TOKEN.finditer(page):
        add(page[end : m.start()])
        end = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            add(" ")
            continue
        block = tag not in _INLINE
        if block:
            flush()
        if m["close"]:
            if opened[tag]:
                at = len(stack) - 1
                while stack[at][0] != tag:
                    at -= 1
                close(at)
            continue
        if block:
            ends = _ENDS.get(tag, set()) | ({"p"} if tag in _ENDS_P else set())
            at = next((i for i in range(len(stack) - 1, max(0, len(stack) - 4), -1) if stack[i][0] in ends), 0)
            if at and not any(frame[0] in ("ul", "ol", "table", "article", "div", "section") for frame in stack[at + 1 :]):
                close(at)
        if tag not in _EMPTY and not m["rest"].rstrip().endswith("/"):
            _, above, around = stack[-1]
            if block:
                out.parent.append(around)
                out.depth.append(out.depth[around] + 1)
                around = len(out.parent) - 1
            stack.append((tag, _mark(tag, m["rest"], above), around))
            opened[tag] += 1
            in_link += tag == "a"
    add(page[end:])
    flush()
    return out


def capacities(block: Block) -> tuple[int, int]:
    """What it costs to call a block boilerplate, and to call it content."""
    prose = min(1.0, len(block.text) / 120) * (1.5 if block.text[-1] in ".!?\"'»”…" else 1.0)
    boilerplate = int(PROSE * prose * (1 - block.links)) + PLAUSIBLE * (block.marked > 0) + 10
    content = int(LINKS * block.links) + SHORT * (len(block.text) < 25) + 40
    return boilerplate, content + (MARKED if block.marked < 0 else 0)


def _distance(page: Page, a: int, b: int) -> int:
    """Steps between two elements in the tree, as far as they matter for a tie."""
    steps = 0
    while a != b and steps < TIE:
        if page.depth[a] < page.depth[b]:
            a, b = b, a
        a, steps = page.parent[a], steps + 1
    return steps


def ties(blocks: Page) -> list[tuple[int, int, int]]:
    """Smoothness edges: each block and the next, and each block and the next under its parent."""
    out, last = [], {}
    for i, block in enumerate(blocks):
        if i:
            out.append((i - 1, i, TIE // (1 + _distance(blocks, blocks[i - 1].place, block.place))))
        parent = blocks.parent[block.place]
        if parent in last and last[parent] < i - 1:
            out.append((last[parent], i, TIE // 2))
        last[parent] = i
    return [edge for edge in out if edge[2]]


def source_side(n: int, terminals: list[tuple[int, int]], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut, by Dinic's algorithm.

    ``terminals`` holds each node's capacity from the source and to the sink. What flows
    straight through a node is taken off first, so only conflicts between neighbours need
    augmenting paths.
    """
    excess = [a - b for a, b in terminals]
    if all(e > 0 for e in excess) or all(e <= 0 for e in excess):
        return [e > 0 for e in excess]
    source, sink = n, n + 1
    to: list[int] = []
    left: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        left.append(forth)
        out[b].append(len(to))
        to.append(a)
        left.append(back)

    for i, e in enumerate(excess):
        if e > 0:
            link(source, i, e, 0)
        elif e < 0:
            link(i, sink, -e, 0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if left[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(left[e] for e in path)
                for e in path:
                    left[e] -= least
                    left[e ^ 1] += least
                path, a = [], source
                continue
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if left[e] and level[to[e]] == level[a] + 1:
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]
                turn[a] += 1
                continue
            path.append(e)
            a = to[e]


def extract(page: str | None) -> str:
    """The content blocks of a page, joined by line ends."""
    blocks = blocks_of(page or "")
    content = source_side(len(blocks), [capacities(b) for b in blocks], ties(blocks)) if blocks else []
    return "\n".join(b.text for b, kept in zip(blocks, content, strict=True) if kept)


def main_text(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` with ``main_text``, from the whole ``html`` of every row.

    Null and empty pages, and pages of boilerplate only, give an empty text. Unclosed tags,
    comments and scripts end with the page. Rows are read one by one, so repeated rows, null
    ids and empty tables need no rule. A column already named ``main_text`` is replaced.
    """
    pages = pages.drop("main_text")
    at = pages.columns.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([extract(page.as_py()) for page in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "main_text"])

    return in_arrow(pages, run, added(pages, main_text="string"))
