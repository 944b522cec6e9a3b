"""Main text of web pages by composite text density.

The page becomes a tree of block elements. Every node has its characters, its tags, and
both within links; their ratio, adjusted for links, is its density. The sum of a node's
children's densities is largest for the element that holds the article's blocks. The lowest
density on the way from that node up to its article (or the body) is the threshold: further
subtrees at or above it belong to the text as well. Elements whose name, class or role says
that they are menus, notices, forms and the like take no part; a part of a class name says
so only of elements without most of the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the HTML standard, and usual class names of page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg canvas math nav footer aside form "
    "button select textarea input datalist menu dialog audio video title search".split()
)
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo banner "
    "cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
    "paywall sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments "
    "disqus respond replies share sharing social related recommended widget toolbar pagination pager skip".split()
)
#: Those that say so as a part of a longer name as well, however much text they hold.
COMMENTS = frozenset("comment comments disqus respond replies".split())
DOUBTED, CERTAIN = 1, 2
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: An element of the second set ends an open one of the first, up to the nearest of the third.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("table td th button object applet template html".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("name", "parent", "items", "dropped", "tags", "link_tags", "chars", "link_chars", "own", "density", "total", "marked")

    def __init__(self, name: str, parent: Node | None, dropped: bool):
        self.name, self.parent, self.dropped = name, parent, dropped
        self.items: list = []  # text, (text, True) within a link, or a block
        self.tags = self.link_tags = self.chars = self.link_chars = self.own = 0
        self.density = self.total = 0.0
        self.marked = False


def _furniture(name: str, attributes: str, in_article: bool) -> int:
    """CERTAIN for page furniture, DOUBTED where only a part of a class or id says so, or 0."""
    if name in DROPPED or name == "header" and not in_article:
        return CERTAIN
    if not attributes.strip():
        return 0
    out = 0
    for kind, value in ATTRIBUTE.findall(attributes):
        kind, value = kind.lower(), value.strip("\"'").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            return CERTAIN
        if kind == "style" and HIDDEN.search(value):
            return CERTAIN
        if kind == "role" and value in ROLES:
            return CERTAIN
        if kind in ("class", "id") and name not in ("body", "html", "article", "main"):
            for one in value.split():
                told = FURNITURE.intersection(re.split(r"[^a-z0-9]+", one))
                if one in FURNITURE or not told.isdisjoint(COMMENTS):
                    return CERTAIN
                out = DOUBTED if told else out
    return out


def parse(page: str) -> Node:
    """The tree of block elements; inline elements add to their block's figures.

    An element that only a part of its class or id calls furniture ("has-sidebar") stays if
    it holds more than half of the text that is not furniture for certain.
    """
    root, seen, doubted = _parsed(page, frozenset())
    stays = frozenset(at for at, chars in doubted if 2 * chars > seen)
    return _parsed(page, stays)[0] if stays else root


def _parsed(page: str, stays: frozenset[int]) -> tuple[Node, int, list[tuple[int, int]]]:
    """The tree, the characters of text, and where doubted elements begin with theirs."""
    root = node = Node("html", None, False)
    # open elements: name, the block around, how it is dropped, where it begins, text before
    stack: list[tuple[str, Node, int, int, int]] = []
    opened: Counter[str] = Counter()
    doubted: list[tuple[int, int]] = []
    dropped = certain = seen = 0  # open dropped elements, those for certain, characters of text
    links = articles = 0
    at, size, lower = 0, len(page), None

    def close(upto: int) -> None:
        nonlocal node, dropped, certain, links, articles
        while len(stack) > upto:
            name, node, gone, begin, before = stack.pop()
            opened[name] -= 1
            dropped -= gone > 0
            certain -= gone == CERTAIN
            if gone == DOUBTED and not certain:
                doubted.append((begin, seen - before))
            links -= name == "a"
            articles -= name in ("article", "main")

    def text(part: str) -> None:
        nonlocal seen
        seen += 0 if certain else len(part.strip())
        if dropped or not part:
            return
        part = html.unescape(part) if "&" in part else part
        node.items.append((part, True) if links else part)

    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at : found.start()])
        begin, at = found.span()
        end, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if end:
            for k in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[k][0] == name:
                    close(k)
                    break
                if stack[k][0] in SCOPE and name not in SCOPE:
                    break
            continue
        if name in BLOCK:
            if name not in ("html", "body"):  # an open paragraph ends here
                for k in range(len(stack) - 1, -1, -1) if opened["p"] else ():
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in BLOCK:
                        break
            if name in IMPLIED:
                ended, fence = IMPLIED[name]
                for k in range(len(stack) - 1, -1, -1) if any(opened[x] for x in ended) else ():
                    if stack[k][0] in ended:
                        close(k)
                        break
                    if stack[k][0] in fence:
                        break
        gone = _furniture(name, attributes, articles > 0)
        if gone == DOUBTED and begin in stays:
            gone = 0
        if not dropped and not gone:
            node.tags += 1
            node.link_tags += name == "a"
            if name == "br":
                node.items.append(" ")
        if name in VOID or attributes.endswith("/") and name not in BLOCK and name != "a":
            continue
        stack.append((name, node, gone, begin, seen))
        opened[name] += 1
        dropped += gone > 0
        certain += gone == CERTAIN
        links += name == "a"
        articles += name in ("article", "main")
        if name in BLOCK and name != "html" and not dropped:
            inner = Node(name, node, False)
            node.items.append(inner)
            node = inner
        if name in RAW:  # no markup up to its own end tag
            lower = page.lower() if lower is None else lower
            stop = lower.find("</" + name, at)
            text(page[at : stop if stop >= 0 else size])
            at = stop if stop >= 0 else size
    close(0)
    return root, seen, doubted


def _in_order(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return out


def _densities(nodes: list[Node], body: Node) -> None:
    for node in reversed(nodes):
        for x in node.items:
            if isinstance(x, Node):
                node.tags += x.tags
                node.link_tags += x.link_tags
                node.chars += x.chars
                node.link_chars += x.link_chars
            elif isinstance(x, tuple):
                n = len("".join(x[0].split()))
                node.chars += n
                node.link_chars += n
            else:
                node.own += len("".join(x.split()))
        node.chars += node.own
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        chars, tags = node.chars, max(node.tags, 1)
        plain, linked = max(chars - node.link_chars, 1), max(node.link_chars, 1)
        if chars:
            base = math.log(chars * node.link_chars / plain + share * chars + math.e)
            ratio = (chars / linked) * (tags / max(node.link_tags, 1))
            node.density = chars / tags * max(math.log(max(ratio, 1.0)) / max(base, 1.0), 1e-6)
    for node in nodes:
        node.total = sum(x.density for x in node.items if isinstance(x, Node))
        # text of its own counts as one more child
        node.total += node.density * node.own / max(node.chars, 1)


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; empty if there are none."""
    if not page:
        return ""
    nodes = _in_order(parse(page))
    body = next((n for n in nodes if n.name == "body"), nodes[0])
    _densities(nodes, body)
    nodes = [n for n in nodes if n.chars]
    if not nodes:
        return ""
    best = max(nodes, key=lambda n: n.total)  # of equal ones the first
    scope, up = None, best
    path = []
    while up is not None:
        path.append(up)
        if up.name in ("article", "main"):
            scope = up
        up = up.parent
    scope = scope or (body if body in path else path[-1])
    threshold = min(n.density for n in path[: path.index(scope) + 1])
    best.marked = True
    inside = _in_order(scope)
    top: dict[int, Node] = {}
    for node in reversed(inside):  # the node of the largest sum in each subtree
        leader = node
        for x in node.items:
            if isinstance(x, Node) and top[id(x)].total > leader.total:
                leader = top[id(x)]
        top[id(node)] = leader
    for node in inside:
        if node.chars and (node.density >= threshold or node.name in HEADINGS):
            top[id(node)].marked = True

    lines: list[str] = []
    part: list[str] = []

    def end_block() -> None:
        line = " ".join("".join(part).split())
        if line:
            lines.append(line)
        part.clear()

    todo: list = [(scope, False)]
    while todo:
        x, chosen = todo.pop()
        if isinstance(x, Node):
            end_block()
            chosen = chosen or x.marked
            todo.append((None, chosen))
            todo.extend((y, chosen) for y in reversed(x.items))
        elif x is None:
            end_block()
        elif chosen:
            part.append(x[0] if isinstance(x, tuple) else x)
    return "\n".join(lines)


def extract_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: key, address, ``text`` and ``n_chars`` (code points).

    NULL and empty pages, and pages without text, give an empty text. Every row is a page of
    its own, repeated ones too; an empty table gives an empty result; other columns are left
    out. Pages are read one at a time from Arrow batches.
    """
    told = pages.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{url}`").alias("_u"), F.col(f"`{page}`").alias("_p"))
    kinds = dict(told.dtypes)
    schema = f"_k {kinds['_k']}, _u {kinds['_u']}, text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["_k", "_u", "text", "n_chars"],
            )

    out = told.mapInArrow(run, schema)
    return out.select(F.col("_k").alias(key), F.col("_u").alias(url), "text", "n_chars")
