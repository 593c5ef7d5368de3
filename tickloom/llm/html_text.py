"""Main text of web pages by composite text density.

A page is read into a tree of block elements; what is inline belongs to its block. Elements that
hold no article by their kind or name (menus, footers, adverts, forms, scripts, …) or are hidden leave
the tree first. A name counts if all parts of a class, id or role are known, and never takes away a
subtree with an article, a main element or a first-level heading in it, nor one with more than half of
the page's characters unless an article or main element with text stands elsewhere: there the density
decides. The density of a node is its characters per tag, lowered by how much of it is link text; the
density sum of a node is the sum over its children. The node with the highest sum is the core of
the page. The lowest density on its path to the body is the threshold: below the body, every node
that reaches it gives the subtree with the highest sum in it, so an article in several parts is
kept whole and sparse parts go. Where the chosen parts lie in an article or main element, the author has
said where the article ends: all of it is kept but boxes and lists that are mostly links. Elsewhere the
last first-level heading before the first part is kept with it.

Forms, dialogs, buttons and objects are treated like elements with such a name, so one round the whole page
takes nothing away. A name with a word for readers' comments counts whatever its other words are.

Blocks come in page order, one per line: character references decoded, white space inside a block
turned into one space, trimmed, empty blocks left out, nothing else dropped or cut.

Defined cases: null, empty and tag-free pages are fine (a page without tags is one block); of equal
density sums the first in the page wins; a tag ends at the first `>` outside quotes, or inside them if
there is none for `TAG` characters, and what no `>` follows is text; missing end tags, unknown tags and stray end tags are taken as browsers do in the plain cases; depth is not
bounded by the interpreter's stack; every row gives one row, repeated or not; other columns of the
table are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import text_or_empty

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BOILERPLATE = frozenset(
    "head script style noscript template iframe embed svg math canvas audio video map nav footer aside "
    "select textarea input menu title".split()
)
#: Kinds that go unless the article may be in them.
DOUBTFUL = frozenset("form button dialog object".split())
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
#: An element that opens ends an open one of these kinds, unless a barrier lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: Words of a class, an id or a role that mark what is no article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "commentlist consent contentinfo cookie cookies disqus dialog footer masthead menu menus modal nav navbar "
    "navigation newsletter notice notices pagination pager popup promo promoted promotion related replies "
    "respond search share sharing sidebar sidebars signup skyscraper social sponsor sponsored subscribe "
    "toolbar widget widgets".split()
)

#: Words that may stand beside a mark in one name.
BESIDE = frozenset(
    "area bar block bottom box button buttons form icons item items left link links list main page post posts right "
    "section site slot top unit".split()
)
#: Elements that are left out of an article if they are mostly links.
BOXES = frozenset("div dl fieldset menu ol section table ul".split())
#: What an article is told by: no name takes it away.
HOLDS_ARTICLE = frozenset(("article", "main", "h1"))

#: Words for readers' comments, and words that say that there are none or some elsewhere.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
NOT_COMMENTS = frozenset("no has with without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)", re.S
)
_STOP = re.compile("[>\"']")
#: Characters of a tag in which quotes count.
TAG = 1 << 16
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """A block element: its parts are texts, (text in a link) and child nodes, in page order."""

    __slots__ = (
        "name", "parent", "parts", "children", "tags", "links", "chars", "link_chars", "density", "sum", "best", "marked"
    )

    def __init__(self, name: str, parent: Node | None):
        self.name, self.parent = name, parent
        self.parts: list = []
        self.children: list[Node] = []
        self.tags = self.links = self.chars = self.link_chars = 0
        self.density = self.sum = 0.0
        self.best = self  # of its subtree, the node with the highest density sum
        self.marked = False  # its name says that it is no article


def _attributes(raw: str) -> dict[str, str]:
    """Names in lower case and values; of repeated names the first."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), entities.unescape(value.strip("\"'")))
    return out


@lru_cache(1 << 16)
def _marks(token: str) -> bool:
    parts = [x.lower() for x in _PARTS.findall(token)]
    if not COMMENTS.isdisjoint(parts):
        return NOT_COMMENTS.isdisjoint(parts)
    return any(x in MARKS for x in parts) and all(x in MARKS or x in BESIDE for x in parts)


def _unwanted(name: str, attributes: dict[str, str], inside: Node) -> bool:
    """Whether an element goes by its kind or is hidden."""
    if name in BOILERPLATE:
        return True
    if name == "header":  # an article's own header holds its title
        node: Node | None = inside
        while node and node.name not in ("article", "main"):
            node = node.parent
        return node is None
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    return (
        "hidden" in attributes
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or _NO_DISPLAY.search(attributes.get("style", "")) is not None
    )


def _marked(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element's kind or names say that it may be no article."""
    if name in DOUBTFUL:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    return any(_marks(x) for key in ("class", "id", "role") for x in attributes.get(key, "").split())


def _prune(root: Node) -> None:
    """Takes marked nodes away, except those that may hold the article; what stays of inline ones joins its block."""
    nodes = _nodes(root)
    if not any(x.marked for x in nodes):
        return
    chars, holds = {}, {}
    for node in reversed(nodes):
        own = sum(len(_squeezed(x[0])) for x in node.parts if isinstance(x, tuple))
        chars[node] = own + sum(chars[x] for x in node.children)
        holds[node] = node.name in HOLDS_ARTICLE or any(holds[x] for x in node.children)
    # A marked node without one of these is beside them.
    elsewhere = any(x.name in ("article", "main") and chars[x] for x in nodes)

    def goes(node: Node) -> bool:
        return node.marked and not holds[node] and (elsewhere or 2 * chars[node] <= chars[root])

    for node in reversed(nodes):
        if not any(x.marked for x in node.children):
            continue
        parts, children = [], []
        for part in node.parts:
            if not isinstance(part, Node):
                parts.append(part)
            elif goes(part):
                continue
            elif part.name in INLINE:
                parts += part.parts
                children += part.children
                for child in part.children:
                    child.parent = node
                node.tags += part.tags + 1
                node.links += part.links + (part.name == "a")
            else:
                parts.append(part)
                children.append(part)
        node.parts, node.children = parts, children


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """The place of the `>` that ends a tag, given the last place of each sign; the page has one from `at` on."""
    place = at
    while (stop := _STOP.search(page, place, at + TAG)) is not None:
        sign, place = stop[0], stop.end()
        if sign == ">":
            return place - 1
        if last[sign] < place:
            break
        place = page.index(sign, place) + 1
    return page.index(">", at)


def parse(page: str) -> Node:
    """The tree of what may hold the article."""
    last = {sign: page.rfind(sign) for sign in ">\"'"}
    root = Node("", None)
    node = root
    # Open elements: name, the node to go back to, whether it is dropped.
    stack: list[tuple[str, Node, bool]] = []
    open_names: Counter[str] = Counter()
    dropped = links = 0
    at = 0

    def text(raw: str) -> None:
        if raw and not dropped:
            node.parts.append((raw, links > 0))

    def close(count: int) -> None:
        nonlocal node, dropped, links
        for _ in range(count):
            name, node, gone = stack.pop()
            open_names[name] -= 1
            dropped -= gone
            links -= name == "a"

    def close_open(names: frozenset | set, barriers: frozenset | set) -> None:
        """Ends the outermost open element of these names above the barriers."""
        if not any(open_names[name] for name in names):
            return
        found = 0
        for depth, (name, _, _) in enumerate(reversed(stack), 1):
            if name in barriers:
                break
            if name in names:
                found = depth
        close(found)

    while match := _TOKEN.search(page, at):
        name = match["name"]
        if name and match.end() > last[">"]:
            break
        text(page[at : match.start()])
        at = match.end()
        if not name:
            if match[0].startswith("<![CDATA["):
                text(entities.escape(match[0][9:-3]))
            continue
        end = _tag_end(page, at, last)
        attributes, at = page[at:end], end + 1
        name = name.lower()
        if match["end"]:
            if not open_names[name]:
                continue
            for depth, (open_name, _, _) in enumerate(reversed(stack), 1):
                if open_name == name:
                    close(depth)
                    break
            continue
        if name == "br":
            if not dropped:
                node.parts.append(None)
                node.tags += 1
            continue
        if name in CLOSES_PARAGRAPH:
            close_open({"p"}, {"table", "td", "th", "button", "object"})
        if name in ENDS:
            close_open(*ENDS[name])
        named = _attributes(attributes) if attributes else {}
        gone, marked = _unwanted(name, named, node), _marked(name, named)
        if name in VOID or attributes.endswith("/") and name not in RAW and name not in INLINE | CLOSES_PARAGRAPH:
            if not dropped and not gone and not marked:
                node.tags += 1
                if name not in INLINE:
                    node.parts.append(None)
            continue
        if name in RAW:
            ended = re.compile(rf"</{re.escape(name)}\s*/?>", re.I).search(page, at)
            at = ended.end() if ended else len(page)
            continue
        stack.append((name, node, gone))
        open_names[name] += 1
        dropped += gone
        links += name == "a"
        if dropped:
            continue
        # Inline elements with a mark are nodes until it is known whether they stay; the outermost one decides.
        if name in INLINE and (not marked or node.name in INLINE):
            node.tags += 1
            node.links += name == "a"
        else:
            child = Node(name, node)
            child.marked = marked
            node.parts.append(child)
            node.children.append(child)
            node = child
    text(page[at:])
    _prune(root)
    return root


def _nodes(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, waiting = [], [root]
    while waiting:
        out.append(node := waiting.pop())
        waiting.extend(reversed(node.children))
    return out


def _squeezed(raw: str) -> str:
    return " ".join((entities.unescape(raw) if "&" in raw else raw).split())


def _measure(nodes: list[Node], body: Node) -> None:
    """Characters, tags, densities and density sums."""
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, tuple):
                n = len(_squeezed(part[0]))
                node.chars += n
                node.link_chars += n if part[1] else 0
        for child in node.children:
            node.chars += child.chars
            node.link_chars += child.link_chars
            node.tags += child.tags + 1
            node.links += child.links
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in reversed(nodes):
        if node.chars:
            chars, tags, linked = node.chars, max(node.tags, 1), node.link_chars
            plain = max(chars / max(linked, 1) * tags / max(node.links, 1), 1.0)
            # The logarithm's base grows with the links; it is e at least, also on a page without any.
            base = math.log(chars / max(chars - linked, 1) * linked + share * chars + math.e)
            node.density = chars / tags * math.log(plain) / max(math.log(base), 1.0)
        node.sum = sum(child.density for child in node.children)
        # The first of equals.
        node.best = max([node, *(child.best for child in node.children)], key=lambda x: x.sum)


def main_nodes(root: Node) -> list[Node]:
    """The roots of the subtrees that hold the main text."""
    nodes = _nodes(root)
    body = next((x for x in nodes if x.name == "body"), root)
    _measure(nodes, body)
    core = body.best
    path, node = [], core
    while node is not None:
        path.append(node.density)
        if node is body:
            break
        node = node.parent
    threshold = min(path)
    chosen, waiting = [], [body]
    while waiting:
        node = waiting.pop()
        if node.density < threshold or not node.chars:
            continue
        best = node.best
        chosen.append(best)
        # The chosen subtree is taken whole; what lies beside it is looked at again.
        waiting.extend(x for x in node.children if x is not best and node is not best)
    return chosen


def _outer(node: Node) -> Node | None:
    """The outermost article element round a node, or else the outermost main element."""
    found = {}
    while node is not None:
        if node.name in ("article", "main"):
            found[node.name] = node
        node = node.parent
    return found.get("article") or found.get("main")


def _is_links(node: Node) -> bool:
    """Whether a box or list is mostly links."""
    return node.name in BOXES and node.links > 1 and 2 * node.link_chars > node.chars


def _title(root: Node, chosen: list[Node]) -> Node | None:
    """The last first-level heading before the first chosen node, if none is in them."""
    first, title = {id(x) for x in chosen}, None
    for node in _nodes(root):
        if id(node) in first:
            break
        if node.name == "h1" and node.chars:
            title = node
    inside = any(x.name == "h1" for node in chosen for x in _nodes(node))
    return None if inside else title


def main_text(page: str) -> str:
    """The main text of one page."""
    root = parse(page)
    chosen = main_nodes(root)
    taken = {id(x) for x in chosen}
    outer = {id(x): x for x in map(_outer, chosen) if x is not None}
    if not outer and chosen and (title := _title(root, chosen)) is not None:
        taken.add(id(title))
    lines, line = [], []

    def state(node: Node, around: int) -> int:
        """2: taken whole; 1: part of the article, unless it is mostly links; 0: not taken."""
        if around == 2 or id(node) in taken:
            return 2
        if around == 1:
            return 0 if _is_links(node) else 1
        return int(id(node) in outer)

    # Depth first with a stack of its own: (node, next part, its state).
    stack = [(root, iter(root.parts), state(root, 0))]

    def end() -> None:
        if block := _squeezed("".join(line)):
            lines.append(block)
        line.clear()

    while stack:
        _, parts, inside = stack[-1]
        part = next(parts, stack)
        if part is stack:
            end()
            stack.pop()
        elif part is None:
            end()
        elif isinstance(part, Node):
            end()
            stack.append((part, iter(part.parts), state(part, inside)))
        elif inside:
            line.append(part[0])
    return "\n".join(lines)


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    @F.pandas_udf("string")
    def article(raw: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in raw], dtype=object)

    # Not evaluated again for n_chars.
    texts = pages.select(
        F.col(id).alias("page_id"),
        F.col(url).alias("url"),
        article.asNondeterministic()(text_or_empty(html)).alias("text"),
    )
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
