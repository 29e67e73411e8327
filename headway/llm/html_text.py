"""Main text of web pages by composite text density.

Every element gets the number of its characters, tags, link characters and link
tags; its density is characters per tag, lowered where links make up the text.
The element with the largest sum of its children's densities is the core of the
page, and the lowest density on the way from the body to it is the threshold:
what reaches the threshold is searched for its own largest sum, and that
subtree is taken whole. The body itself is not on the way, unless it is the core:
it holds the menus and notices that the threshold is to keep away.

Names of elements and classes that mark menus, notices and the like are hints: such
a part counts for nothing, but only while it holds less than ``MOST`` of the page's
characters outside links. An article in a box named after its sidebar stays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements of the HTML standard by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset(
    "script style noscript template head title button select textarea input iframe object embed svg canvas audio video".split()
)
BESIDE = frozenset("nav header footer aside form dialog menu".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)
# Words in class, id or role that mark what is not the article.
NOTICE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|"
    r"notice|alert|popup|modal|overlay|newsletter|subscribe|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|"
    r"header|footer|masthead|toolbar|pagination|pager|share|sharing|social|related|recommend(?:ed|ations)?|"
    r"comments?|commentlist|replies|reply|disqus|complementary|contentinfo|search)(?:$|[\s_-])"
)
MOST = 2 / 3  # share of the page's characters outside links from which on a hint is not believed
_ROOTS = frozenset(("html", "body", "main", "article"))


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "out", "hint")

    def __init__(self, tag: str, parent: "Node | None", out: bool):
        self.tag, self.parent, self.out, self.hint = tag, parent, out, False
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


# One piece of markup: comment, declaration, end tag, or start tag with quoted values kept whole.
_MARK = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|([a-zA-Z][^\s/>]*+)((?:[^>\"'=]|=\s*\"[^\"]*+\"|=\s*'[^']*+'|[=\"'])*+)(?:>|\Z))",
    re.S,
)
_VALUE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden)(?=[\s=/]|\Z)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg"))
_P_SCOPE = frozenset(("button", "table", "td", "th", "article", "section", "div", "body"))
_LISTS, _ROWS, _TABLES, _TERMS = (frozenset(x.split()) for x in ("ul ol menu", "table tr", "table", "dl"))


class _Tree:
    """Elements of a page, with the end tags that may be left out put in."""

    def __init__(self, text: str) -> None:
        self.root = Node("#root", None, False)
        self.open = [self.root]
        at = 0
        while True:
            mark = _MARK.search(text, at)
            end = mark.start() if mark else len(text)
            if end > at:
                data = text[at:end]
                self.open[-1].children.append(unescape(data) if "&" in data else data)
            if not mark:
                return
            at = mark.end()
            if mark[2]:
                tag = mark[2].lower()
                self._start(tag, mark[3])
                if tag in _RAW and not (mark[3] or "").endswith("/"):
                    close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(text, at)
                    at = close.start() if close else len(text)  # what is inside is no markup
            elif mark[1] and (tag := mark[1].lower()) not in VOID:
                self._pop_to(tag, frozenset())

    def _pop_to(self, tag: str, stop: frozenset[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return
            if self.open[at].tag in stop:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._pop_to("p", _P_SCOPE)
        elif tag == "li":
            self._pop_to("li", _LISTS)
        elif tag in ("td", "th"):
            for cell in ("td", "th"):
                self._pop_to(cell, _ROWS)
        elif tag == "tr":
            self._pop_to("tr", _TABLES)
        elif tag in ("dt", "dd"):
            for term in ("dt", "dd"):
                self._pop_to(term, _TERMS)
        top = self.open[-1]
        out, hint = top.out or tag in UNSEEN, tag in BESIDE
        if attributes and not out and tag not in _ROOTS:
            for name, value in _VALUE.findall(attributes):
                if name.lower() == "hidden":
                    out = True
                elif NOTICE.search(value.strip("\"'").lower()):
                    hint = True
        node = Node(tag, top, out)
        node.hint = hint
        top.children.append(node)
        if tag not in VOID:
            self.open.append(node)


def _walk(root: Node) -> list[Node]:
    """All nodes that are not left out, parents first; no recursion, pages may be deep."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node) and not c.out]
    return order


def _believe_hints(body: Node) -> None:
    """Leave out the hinted parts, from the outside in, that do not hold most of the page."""
    order = _walk(body)
    plain: dict[int, int] = {}  # characters outside links
    for node in reversed(order):
        plain[id(node)] = sum(
            sum(map(len, c.split())) if isinstance(c, str) else 0 if c.out or c.tag == "a" else plain[id(c)] for c in node.children
        )
    for node in order:
        node.out = node.out or node.parent.out or (node.hint and plain[id(node)] < MOST * max(1, plain[id(body)])) if node is not body else node.out


def _measure(body: Node) -> list[Node]:
    order = _walk(body)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.chars += sum(map(len, child.split()))
            elif not child.out:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.chars if child.tag == "a" else child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    share = body.link_chars / max(1, body.chars)
    for node in reversed(order):
        c, t = node.chars, max(1, node.tags)
        if c:
            lc, lt, rest = max(1, node.link_chars), max(1, node.link_tags), max(1, c - node.link_chars)
            base = math.log(c / rest * node.link_chars + share * c + math.e)
            node.density = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(max(base, 1.0) + math.e - 1)
        blocks = [k.density for k in node.children if isinstance(k, Node) and not k.out and k.tag not in INLINE]
        node.total = sum(blocks) if blocks else node.density
    return order


def _largest(order: list[Node]) -> Node | None:
    """The node with the largest sum; of equal ones the outermost, then the first."""
    best = None
    for node in order:
        if node.tag not in INLINE and node.chars and (best is None or node.total > best.total):
            best = node
    return best


def _core(body: Node, order: list[Node]) -> set[int]:
    """Roots of the subtrees that are the article."""
    best = _largest(order)
    if best is None:
        return set()
    threshold, node = best.density, best
    while node is not body:
        threshold = min(threshold, node.density)
        node = node.parent
    path, up = set(), best
    while up is not None:
        path.add(id(up))
        up = up.parent
    taken, todo = {id(best)}, [body]
    while todo:
        node = todo.pop()
        if node is best:
            continue
        if id(node) in path:  # what stands beside the way to the core is judged by the threshold
            todo += [c for c in node.children if isinstance(c, Node) and not c.out and c.tag not in INLINE]
        elif node.density >= threshold and node.chars:
            taken.add(id(_largest(_walk(node)) or node))
    return taken


def _blocks(root: Node, taken: set[int]) -> Iterator[str]:
    """Text block by block, in page order."""
    held: list[str] = []
    todo: list[tuple[Node | str, bool, bool]] = [(root, False, False)]
    while todo:
        item, inside, closing = todo.pop()
        if isinstance(item, str):
            if inside:
                held.append(item)
            continue
        if item.out:
            continue
        if item.tag == "br":
            held.append(" ")
            continue
        if item.tag not in INLINE:
            yield "".join(held)
            held.clear()
        if closing:
            continue
        inside = inside or id(item) in taken
        todo.append((item, inside, True))
        todo += [(child, inside, False) for child in reversed(item.children)]
    yield "".join(held)


def main_text(html: str | None, hints: bool = True) -> str:
    """The article of one page; empty for a null or empty page. Without ``hints`` by density alone."""
    if not html:
        return ""
    tree = _Tree(html)
    todo, body = [tree.root], tree.root
    while todo:
        node = todo.pop()
        if node.tag == "body":
            body = node
            break
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and c.tag in ("html", "body")]
    if hints:
        _believe_hints(body)
    taken = _core(body, _measure(body))
    return " ".join(filter(None, (" ".join(block.split()) for block in _blocks(body, taken))))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars.

    Pages are read one by one in Arrow batches, so a task holds a batch, not a
    partition. A null or empty page and one without text give an empty text. A part
    that element and class names mark as no article is left out unless it holds
    most of the page. Ids
    may be null or repeated: every row is its own page; extra columns are not read.
    """
    wanted = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    id_type = wanted.schema["page_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return wanted.mapInArrow(texts, f"page_id {id_type}, url string, text string, n_chars bigint")
