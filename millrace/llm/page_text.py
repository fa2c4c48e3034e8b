"""Main text of web pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("script style template noscript iframe object svg math title textarea select head audio video canvas".split())
# Their content is no markup: it ends at the first end tag of theirs.
RAW = frozenset("script style title textarea iframe noscript".split())
# What may stand in a select, and what ends an open drawing or formula.
IN_SELECT = INLINE | frozenset("option optgroup hr div button img legend selectedcontent script template svg".split())
ENDS_DRAWING = frozenset(
    "blockquote body br center code dd div dl dt embed h1 h2 h3 h4 h5 h6 head hr img li listing menu nobr ol p pre ruby "
    "table ul".split()
)
ISLANDS = frozenset("foreignobject desc title annotation-xml mtext".split())  # HTML inside a drawing or formula
CLOSES_P = frozenset("li td th tr dt dd p h1 h2 h3 h4 h5 h6 div article section ul ol table footer header nav aside form".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
_NAME = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
# Parts that make a name say something about another part of the page, or about a setting.
MODIFIERS = frozenset(
    "has with without no not is are hide show tag category cat format type status theme layout template columns col open closed enabled disabled count".split()
)
# Whole elements of these names are kept apart however much prose they hold.
READERS = frozenset("comment comments disqus replies reply".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

# The linear classifier: log-odds that a block is content. Words of class, id
# and role names stand for what page templates call their parts.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup "
    "promo related reply replies share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split()
)
CONTENT_NAMES = frozenset("article articlebody body content entry main post story text".split())
TAG_SCORE = {
    "article": 5.0, "main": 3.0, "nav": -9.0, "header": -4.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0,
    "button": -9.0, "dialog": -9.0, "fieldset": -9.0, "address": -2.0,
}
PAGE_PARTS = frozenset("nav header footer aside".split())
# Names by which an article is no article of the page.
ARTICLE_NAMES = frozenset("comment comments reply replies ad ads advert advertisement promo related sponsored teaser".split())
# Share of a page's prose from which an element is a frame around the page, with its main part or without.
FRAME, BARE_FRAME, PROSE_CHARS = 0.6, 0.9, 60
NAME_SCORE = {"boilerplate": -9.0, "content": 2.0}
PRIOR, PER_LOG_CHAR, SENTENCE_END, LINKED, LIST_ITEM = -1.0, 0.35, 0.6, -4.0, -0.5
NEXT_BLOCK, NEAR_IN_TREE, REACH = 0.6, 0.8, 3


@dataclass
class Element:
    """An open element: what its tag and names say about the text in it."""

    score: float = 0.0
    readers: bool = False  # comments of readers, or hidden
    main: bool = False  # names the main part of a page
    holds_main: bool = False
    holds_parts: bool = False  # a header, footer, menu or sidebar of the page
    prose: int = 0


@dataclass
class Block:
    path: tuple[int, ...]  # ids of the open elements, outermost first
    item: bool
    within: list[Element] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def names_of(value: str) -> Iterator[tuple[list[str], bool]]:
    """Parts of each name in a class, id or role, and whether it is about another part ("has-sidebar", "comment-status-open")."""
    for name in value.lower().split():
        parts = _PART.findall(name)
        if parts:
            yield parts, not MODIFIERS.isdisjoint(parts)


def element(tag: str, attributes: str) -> Element:
    """What a tag and its names say. The page's frame and its articles are judged by their tag; on an article a
    name counts only when it says whose text it is. Names of both kinds ("content sidebar-left") cancel out."""
    out = Element(TAG_SCORE.get(tag, 0.0), main=tag in ("main", "h1", "article"))
    if not attributes:
        return out
    boilerplate = content = False
    for name, value in _NAME.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "style":
            out.readers |= bool(HIDDEN.search(value))
        elif name in ("hidden", "aria-hidden"):
            out.readers |= value.lower() != "false"
        elif tag not in ("html", "body", "main"):
            for parts, about in names_of(value):
                own = parts[:1] if about else parts
                content |= not CONTENT_NAMES.isdisjoint(own) and BOILERPLATE_NAMES.isdisjoint(own)
                if not about and (tag != "article" or not ARTICLE_NAMES.isdisjoint(parts)):
                    boilerplate |= not BOILERPLATE_NAMES.isdisjoint(parts)
                    out.readers |= not READERS.isdisjoint(parts)
    out.main |= content
    if out.readers or boilerplate and not content:
        out.score += NAME_SCORE["boilerplate"]
        out.main = False
    elif content and not boilerplate:
        out.score += NAME_SCORE["content"]
    return out


def blocks(html: str) -> list[Block]:
    """Text blocks in page order. Broken markup is taken as browsers do: missing
    end tags are implied, unmatched ones are left out, an open comment, script or
    style hides the rest. Of elements without text those that stay open hide
    nothing: one that has no end tag is passed over, and one that is left open
    ends with an element around it, at a tag that cannot be inside it, or, when
    nothing else ends it, right behind its start tag."""
    out: list[Block] = []
    stack: list[tuple[str, int, Element]] = []  # tag, element number, what it says
    current: Block | None = None
    at = number = links = 0
    skip: str | None = None
    within: list[tuple[str, int]] = []  # open elements inside the skipped one, and the places behind their start tags
    skipped_at = 0  # behind its start tag
    open_tags: set[str] = set()  # elements without an end tag in the rest of the page
    passed: set[int] = set()  # places of start tags that are passed over

    def end_of(tag: str, place: int) -> re.Match | None:
        """The next end tag of an element; one search without a find serves the whole rest."""
        found = None if tag in open_tags else re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, place)
        if not found:
            open_tags.add(tag)
        return found

    def add(raw: str) -> None:
        nonlocal current
        if not raw or (current is None and raw.isspace()):
            return
        if current is None:
            item = any(t in ("li", "td", "th", "option") for t, _, _ in stack)
            current = Block(tuple(n for t, n, _ in stack if t not in INLINE), item, [e for _, _, e in stack])
            out.append(current)
        piece = unescape(raw) if "&" in raw else raw
        current.pieces.append(piece)
        if links:
            current.linked += len(piece)

    def close(tag: str) -> None:
        nonlocal links
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                links -= sum(1 for t, _, _ in stack[i:] if t == "a")
                del stack[i:]
                return
            if tag in INLINE and stack[i][0] not in INLINE:
                return

    def ends_skipped(tag: str, ends: bool) -> bool:
        """Whether a tag inside the skipped element shows that it was left open."""
        if ends:
            for i in range(len(within) - 1, -1, -1):
                if within[i][0] == tag:
                    del within[i:]
                    return False
            return tag not in INLINE and any(t == tag for t, _, _ in stack)
        if skip == "select":
            return tag not in IN_SELECT
        return skip in ("svg", "math") and tag in ENDS_DRAWING and all(t not in ISLANDS for t, _ in within)

    place = 0
    while True:
        m = _MARKUP.search(html, place)
        if not m:
            if skip is None:
                break
            # Nothing has ended it: read again from behind its start tag.
            passed.update([skipped_at, *(p for _, p in within)])
            place = at = skipped_at
            skip = None
            open_tags.clear()
            continue
        place = m.end()
        tag = m[2].lower() if m[2] else None
        if skip:
            if m[1] and tag == skip and all(t != skip for t, _ in within):
                skip, at = None, m.end()
                continue
            if tag is None or not ends_skipped(tag, bool(m[1])):
                if tag and not m[1] and tag not in VOID and not m[3].endswith("/"):
                    end = end_of(tag, place) if tag in ("script", "style") else None
                    if end:
                        place = end.end()
                    else:
                        within.append((tag, place))
                continue
            skip, at = None, m.start()
        add(html[at : m.start()])
        at = m.end()
        if tag is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if tag not in INLINE and tag not in NO_TEXT:
            current = None
        if m[1]:
            close(tag)
            continue
        if tag == "br":
            add(" ")
        if tag in VOID or m[3].endswith("/") and tag not in INLINE:
            continue
        if tag in NO_TEXT:
            if tag in RAW:
                end = end_of(tag, at)
                if end:
                    place = at = end.end()
                elif tag in ("script", "style"):
                    return out
            elif tag != "head" and at not in passed and (tag in ("select", "svg", "math") or end_of(tag, at)):
                skip, skipped_at = tag, at
                within.clear()
            continue
        if tag in CLOSES_P:
            parent = next((t for t, _, _ in reversed(stack) if t not in INLINE), None)
            if parent == "p":
                close("p")
            elif parent == tag and tag in ("li", "td", "th", "tr", "dt", "dd"):
                close(tag)
        number += 1
        stack.append((tag, number, element(tag, m[3])))
        if stack[-1][2].main or tag in PAGE_PARTS:
            for _, _, outer in stack[:-1]:
                outer.holds_main |= stack[-1][2].main
                outer.holds_parts |= tag in PAGE_PARTS
        links += tag == "a"
    rest = html[at:]
    cut = re.search(r"<[A-Za-z/!?][^>]*\Z", rest)
    add(rest[: cut.start()] if cut else rest)
    return out


def place_scores(found: list[tuple[Block, str]]) -> list[float]:
    """What the elements around each block say together.

    A penalty cannot take the page itself: an element that holds most of its
    prose and the main part, or nearly all of its prose and its menus, header or
    footer, is a frame around the page ("page-wrapping" forms, "content sidebar-left"), and its penalty does
    not count. Readers' comments and hidden elements are no frames.
    """
    whole = 0
    for b, text in found:
        n = len(text) - min(len(text), b.linked)
        if n >= PROSE_CHARS:
            whole += n
            for e in b.within:
                e.prose += n

    def score(e: Element) -> float:
        share = FRAME if e.holds_main else BARE_FRAME if e.holds_parts else None
        frame = share and whole and not e.readers and e.prose >= share * whole
        return 0.0 if frame and e.score < 0 else e.score

    return [sum(map(score, b.within)) for b, _ in found]


def content_score(block: Block, text: str, place: float) -> float:
    """Log-odds that a block is content: its place in the tree, length, links and last sign."""
    n = max(1, len(text))
    score = PRIOR + place + PER_LOG_CHAR * math.log1p(n) + LINKED * min(1.0, block.linked / n)
    return score + SENTENCE_END * (text[-1:] in ".!?…\"”") + LIST_ITEM * block.item


def smoothness(found: list[Block]) -> dict[tuple[int, int], float]:
    """Weights of edges between blocks: to the next one, and to those behind it by nearness in the tree."""
    edges: dict[tuple[int, int], float] = {}
    for i, a in enumerate(found):
        for j in range(i + 1, min(len(found), i + 1 + REACH)):
            common = 0
            for x, y in zip(a.path, found[j].path):
                if x != y:
                    break
                common += 1
            apart = len(a.path) + len(found[j].path) - 2 * common
            edges[i, j] = (NEAR_IN_TREE + NEXT_BLOCK * (j == i + 1)) / (1 + apart)
    return edges


def min_cut(scores: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Whether each node is on the source's side of a minimum cut.

    A positive score is the capacity from the source, a negative one to the
    sink. A node whose terminal outweighs all its edges is on that side in every
    minimum cut; it is settled first and its edges become capacities of its
    neighbours, until none is left to settle. Max-flow separates the others.
    """
    n = len(scores)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    unary, side = list(scores), [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is not None or abs(unary[i]) <= sum(near[i].values()) and near[i]:
            continue
        side[i] = unary[i] > 0
        for j, w in near[i].items():
            del near[j][i]
            unary[j] += w if side[i] else -w
            queue.append(j)
        near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        reached = _source_side(rest, unary, near)
        for i in rest:
            side[i] = i in reached
    return side


def _source_side(nodes: list[int], unary: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes that the source still reaches when the flow is largest (shortest augmenting paths)."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes}
    room[source], room[sink] = {}, {}
    for i in nodes:
        a, b = (source, i) if unary[i] > 0 else (i, sink)
        room[a][b], room[b][a] = abs(unary[i]), 0.0
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            a = queue.popleft()
            for b, w in room[a].items():
                if w > 1e-9 and b not in came:
                    came[b] = a
                    queue.append(b)
        if sink not in came:
            return set(came)
        path, b = [], sink
        while b != source:
            path.append((came[b], b))
            b = came[b]
        flow = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= flow
            room[b][a] = room[b].get(a, 0.0) + flow


def main_text(html: str | None) -> str:
    """Content blocks of a page, white space made single, joined by line ends; empty if there are none."""
    found = [(b, t) for b in blocks(html or "") if (t := b.text)]
    if not found:
        return ""
    scores = [content_score(b, t, place) for (b, t), place in zip(found, place_scores(found))]
    keep = min_cut(scores, smoothness([b for b, _ in found]))
    return "\n".join(t for (_, t), k in zip(found, keep) if k)


def extract_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """All other columns of ``pages`` with ``text`` and ``n_chars``, its code points.

    Pages are independent: no shuffle, one page at a time in memory. A NULL or
    empty page gives an empty text. Columns named ``text`` or ``n_chars`` are
    replaced.
    """
    others = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(len(others))]
            yield pa.record_batch(
                [*(b.column(k) for k in range(len(others))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*others, "text", "n_chars"],
            )

    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in others]
    rows = pages.select(*[F.col(f"`{c}`") for c in others], F.col(html).cast("string").alias(html))
    return rows.mapInArrow(scan, ", ".join([*fields, "text string", "n_chars bigint"]))
