"""Main text of web pages by tree scoring.

Blocks of text pass points for their length and commas to their ancestors,
fewer with each level, discounted by the share of their text in links. The
container with most points is the article, together with all beside it and its
ancestors that is not mostly links.

Class names only mark an element; whether it goes is decided on the whole tree,
so that a mark on what holds the article does not take the article with it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.texts import slices

SLICE_BYTES = 4 << 20

# fixed values: element names of HTML and their roles
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template head nav footer aside"
    " button select option datalist svg math canvas object audio video map dialog menu".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6"
    " hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul search header form".split()
) | DROPPED
CONTAINERS = frozenset("article body blockquote center details div dl fieldset figure form html main ol section table td ul".split())
# an opening tag of the first kind ends an open element of the second
ENDS = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}),
}
STOPS = {"li": frozenset({"ul", "ol", "menu"}), "dt": frozenset({"dl"}), "dd": frozenset({"dl"})}
TABLE, PARAGRAPH = frozenset({"table"}), frozenset({"p"})
#: open elements looked at when a block begins: a paragraph ends there, the others hold it
BARRIERS = CONTAINERS | DROPPED | frozenset({"p", "td", "th", "li", "header"})
ARTICLES = frozenset({"article", "main"})
# words of class or id that mark what is no part of an article
JUNK = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored outbrain taboola"
    " breadcrumb breadcrumbs pagination pager comment comments commentlist disqus replies reply respond"
    " cookie cookies consent gdpr notice notices alert popup newsletter subscribe subscription"
    " related recommended recommendations share sharing social".split()
)
# as before, but also in names of whole layouts
LAYOUT = frozenset(
    "nav navbar navigation navbox menu sidebar aside rail masthead footer colophon modal overlay".split()
)
# words that mark only what is short or mostly links
WEAK = frozenset("header search discussion login signup widget toc copyright".split())
# names with these words tell a state of the page
STATES = frozenset("has no not with without open closed enabled disabled".split())
ROLES = frozenset("navigation banner complementary contentinfo search menu menubar dialog alert".split())
KEPT, IF_SHORT, IF_SMALL, JUNKED = range(4)  # how strongly an element is marked
SHORT = 200  # characters
_JUNK_WORD = re.compile(r"[^a-z]+")
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^\s/>]*(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*?(?:>|\Z)",
    re.S,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# one attribute after the other, from left to right, so that a value is never read as a name
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")
_TESTED = frozenset("class id role hidden aria-hidden style".split())
_SPACE = re.compile(r"[\s\x00]+")


class Node:
    __slots__ = ("name", "parent", "mark", "children", "score", "own", "own_links", "text", "links", "clean", "holds")

    def __init__(self, name: str, parent: Node | None, mark: int = KEPT) -> None:
        self.name, self.parent, self.mark = name, parent, mark
        self.children: list[Node | str] = []  # a string is a finished block of text
        self.score = 0.0
        self.own = self.own_links = 0  # characters of own blocks, and of those inside links
        self.text = self.links = 0  # the same with all below
        self.clean = 0  # characters below outside links and marked elements
        self.holds = False  # whether an article is below, outside marked elements


def _hidden_and_mark(name: str, tag: str) -> tuple[bool, int]:
    """Whether a reader never sees the element, and how strongly its attributes mark it."""
    if name in DROPPED:
        return True, KEPT
    mark = IF_SMALL if name == "form" else KEPT
    if " " not in tag and "\n" not in tag and "\t" not in tag:
        return False, mark
    for key, value in _ATTRIBUTE.findall(tag[len(name) + 1 :]):
        key, value = key.lower(), value.strip("\"'").lower()
        if key not in _TESTED:
            continue
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True, KEPT
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True, KEPT
        elif name in ("html", "body"):
            continue
        elif key == "role":
            if value in ROLES:
                mark = max(mark, IF_SMALL)
        else:
            for token in value.split():
                words = _JUNK_WORD.split(token)
                if not STATES.isdisjoint(words):
                    continue
                if not JUNK.isdisjoint(words):
                    mark = JUNKED
                elif not LAYOUT.isdisjoint(words):
                    mark = max(mark, IF_SMALL)
                elif (name in CONTAINERS or name == "header") and not WEAK.isdisjoint(words):
                    mark = max(mark, IF_SHORT)
    return False, mark


class _Builder:
    """Builds the tree of a page: block elements as nodes, runs of text between them as strings."""

    def __init__(self) -> None:
        self.root = self.node = Node("html", None)
        #: open elements: name, the node around it (blocks only), whether it is dropped, whether a link
        self.stack: list[tuple[str, Node | None, bool, bool]] = []
        #: where in the stack elements of a name, blocks and barriers stand
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.barriers: list[int] = []
        self.run: list[str] = []
        self.muted = self.links = self.linked = 0

    def data(self, text: str) -> None:
        if not self.muted:
            self.run.append(text)
            if self.links:
                self.linked += len(text)

    def end_block(self) -> None:
        if self.run:
            text = _SPACE.sub(" ", html.unescape("".join(self.run))).strip()
            self.run.clear()
            if text:
                self.node.children.append(text)
                self.node.own += len(text)
                self.node.own_links += min(len(text), self.linked)
        self.linked = 0

    def _open(self, name: str) -> int:
        """Place of the innermost open element of a name, -1 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def _pop(self) -> None:
        name, around, junk, link = self.stack.pop()
        self.places[name].pop()
        if around is not None:
            self.end_block()
            self.node = around
            self.blocks.pop()
            if name in BARRIERS:
                self.barriers.pop()
        self.muted -= junk
        self.links -= link

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._pop()

    def start(self, name: str, tag: str) -> None:
        if name in VOID:
            if name == "hr":
                self.end_block()
            elif name in ("br", "img"):
                self.data(" ")
            return
        block = name in BLOCKS
        if block:
            self._end_implied(name)
            self.end_block()
        junk, mark = _hidden_and_mark(name, tag)
        if name == "header":
            inside = max(self._open("article"), self._open("main"), self._open("section")) >= 0
            junk, mark = junk or not inside, max(mark, IF_SHORT)
        elif name in ARTICLES and mark < JUNKED:
            mark = KEPT
        if mark and self._open("pre") >= 0:  # colours of code
            mark = KEPT
        place, around = len(self.stack), None
        if block:
            around = self.node
            self.node = Node(name, around, mark)
            self.blocks.append(place)
            if name in BARRIERS:
                self.barriers.append(place)
            if not (self.muted or junk):
                around.children.append(self.node)
        elif mark >= IF_SMALL:
            junk = True
        self.stack.append((name, around, junk, name == "a"))
        self.places.setdefault(name, []).append(place)
        self.muted += junk
        self.links += name == "a"

    def _end_implied(self, name: str) -> None:
        """Close what an opening tag ends unasked: a paragraph by any block, an item by the next."""
        ends = ENDS.get(name)
        if ends is None:
            while self.barriers and self.stack[self.barriers[-1]][0] in PARAGRAPH:
                self._pop_to(self.barriers[-1])
            return
        while True:
            place = max(map(self._open, ends))
            if place < 0 or place < max(map(self._open, STOPS.get(name, TABLE))):
                return
            self._pop_to(place)

    def end(self, name: str) -> None:
        block = name in BLOCKS
        if block:
            self.end_block()
        place = self._open(name)
        # an inline tag does not close the blocks opened inside it
        if place >= 0 and (block or not self.blocks or self.blocks[-1] < place):
            self._pop_to(place)


def parse(source: str) -> Node:
    builder, at = _Builder(), 0
    while at < len(source):
        token = _TOKEN.search(source, at)
        if token is None:
            builder.data(source[at:])
            break
        if token.start() > at:
            builder.data(source[at : token.start()])
        tag, at = token[0], token.end()
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        if tag[1] == "/":
            builder.end(name)
            continue
        builder.start(name, tag)
        if name in RAW:  # its content is no markup
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            at = close.start() if close else len(source)
    while builder.stack:
        builder._pop()
    builder.end_block()
    return builder.root


def _preorder(root: Node) -> list[Node]:
    todo, order = [root], []
    while todo:
        order.append(todo.pop())
        todo += [c for c in reversed(order[-1].children) if not isinstance(c, str)]
    return order


def _sum_up(order: list[Node]) -> None:
    for node in reversed(order):
        below = [c for c in node.children if not isinstance(c, str)]
        unmarked = [c for c in below if c.mark < IF_SMALL]
        node.text = node.own + sum(c.text for c in below)
        node.links = node.own_links + sum(c.links for c in below)
        node.clean = node.own - node.own_links + sum(c.clean for c in unmarked)
        node.holds = node.name in ARTICLES or any(c.holds for c in unmarked)


def _prune(root: Node) -> None:
    """Take out marked elements, but for one that holds the article.

    That is one with the page's only article element and more text than stands
    unmarked outside; by a name that may be a layout's, also one with most text
    of the page and hardly any unmarked outside.
    """
    _sum_up(_preorder(root))
    most = (root.text - root.links) / 2
    # a node, whether an article holds it, and what stands unmarked on the page: whether an article, and characters
    todo = [(root, False, root.holds, root.clean)]
    while todo:
        node, inside, found, outer = todo.pop()
        inside = inside or node.name in ARTICLES
        kept: list[Node | str] = []
        for child in node.children:
            if not isinstance(child, str):
                below = (child, inside, found, outer)
                if child.mark == IF_SHORT:
                    beside = not inside and not child.holds and (found or child.text < SHORT)
                    if beside or 2 * child.links > child.text:
                        continue
                elif child.mark:
                    alone = child.holds and not found and child.clean > outer
                    nearly_all = child.clean > max(SHORT, 10 * outer) and child.text - child.links >= most
                    if not (alone or child.mark == IF_SMALL and nearly_all):
                        continue
                    below = (child, inside, found or child.holds, outer + child.clean)
                todo.append(below)
            kept.append(child)
        node.children = kept


def _score(root: Node) -> list[Node]:
    """Give points of the blocks of nodes to them and their ancestors; the nodes in page order."""
    order = _preorder(root)
    _sum_up(order)
    for node in reversed(order):
        points = sum(1 + c.count(",") + min(len(c) // 100, 3) for c in node.children if isinstance(c, str))
        above, share = (node if node.name in CONTAINERS else node.parent or node), 1.0
        while points and above is not None and share > 0.05:
            above.score += points * share
            above = above.parent
            share = share / 2 if share == 1.0 else share * 0.6
    for node in order:
        node.score *= 1 - _density(node)
    return order


def _density(node: Node) -> float:
    return node.links / node.text if node.text else 0.0


def _blocks(node: Node) -> list[str]:
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        else:
            todo += reversed(item.children)
    return out


def main_text(source: str | None) -> str:
    """The article of a page: its blocks in page order, joined by two line ends; empty if there is none."""
    root = parse(source or "")
    _prune(root)
    best = max(_score(root), key=lambda n: (n.name in CONTAINERS, n.score))
    # the element that says it is the article holds the best container whole
    above = best
    while above is not None:
        if above.name in ARTICLES:
            best = above
        above = above.parent
    if best.parent is None or best.name in ("body", "html"):
        return "\n\n".join(_without_menus(best))
    return "\n\n".join(_around(best))


def _without_menus(body: Node) -> list[str]:
    """The blocks of a page without a container of its own for the article."""
    out: list[str] = []
    todo: list[Node | str] = [body]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.name in ("html", "body"):
            todo += reversed(item.children)
        elif item.name not in CONTAINERS or _density(item) < 0.5:
            out += _blocks(item)
    return out


def _around(best: Node) -> list[str]:
    """The blocks of ``best`` and of all beside it and its ancestors that is not mostly links, in page order."""
    before: list[list[str]] = []
    after: list[str] = []
    node = best
    while node.parent is not None:
        beside = node.parent.children
        inner = [c for c in beside if not isinstance(c, str)]
        text, links = (getattr(node.parent, n) - sum(getattr(c, n) for c in inner) for n in ("text", "links"))
        parts: list[str] = []
        for child in beside:
            if child is node:
                before.append(parts)
                parts = after
            elif isinstance(child, str):
                if links < 0.5 * text:
                    parts.append(child)
            elif _density(child) < 0.5:
                parts += _blocks(child)
        node = node.parent
    return [b for parts in reversed(before) for b in parts] + _blocks(best) + after


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``id_column``, ``url_column``, ``text`` and ``n_chars`` (code points) of each page's whole HTML.

    Null HTML is empty. Left out are menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles and comments, by element and by class, id or
    role; all else in the chosen containers stays. White space inside a block
    is one blank. Of containers with equal points the first is chosen. Rows that
    occur twice are answered twice, an empty table gives an empty one, and other
    columns, whatever their names, are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "h", SLICE_BYTES):
            texts = [main_text(h) for h in batch.column("h").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("u"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["k", "u", "text", "n_chars"],
            )

    keyed = pages.select(
        F.col(id_column).alias("k"), F.col(url_column).alias("u"), F.col(html_column).cast("string").alias("h")
    )
    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    made = keyed.mapInArrow(run, f"k {kinds['k']}, u {kinds['u']}, text string, n_chars bigint")
    return made.withColumnsRenamed({"k": id_column, "u": url_column})
