"""Main text of HTML pages by composite text density.

A tolerant one-pass parser builds the tree of block elements (inline markup only counts as tags of its block)
and the runs of text between them. Scripts, styles, form controls and hidden elements are no text of the page. For
every node and run, with C characters, T tags, LC link characters, LT link tags, and LCb, Cb those of the body:

    density = C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LCb / Cb * C + e))

(zero counts taken as one), and a node's density sum is the sum of its children's and runs' densities. The node
with the greatest density sum is the core of the article. The least density on its path to the body is the
threshold: from the body down, any node as dense as that also gives the part with the greatest density sum beneath
it, so an article in several parts comes out whole, and lists of links, adverts and notices don't. What lies between
the first and the last part, and, if a part is in an ``article`` element, the rest of that, belongs to the text.

*Evidence by name.* Elements that are menus, asides, footers and the like by tag, role, class or id are marked: their
characters and tags count as those of links, so their density is zero and that of what holds them is less, and they are
left out of what is taken. A mark is void on ``article`` and ``main``, on what holds one of them, and on what holds most
of the plain text of the page, or, inside an article, of the article. Negating and taxonomy names (no-, has-,
category-) don't mark.

Text is cut into blocks at block elements; character references are decoded, white space (``br`` and no-break
spaces too) in a block becomes one space, empty blocks go, and blocks are joined by one line end.

Edge cases: a null or empty html and pages without text give an empty text; text without any element is one
block; unclosed, misnested and cut-off markup is closed as a browser would; depth and length aren't limited;
repeated rows stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brandbook.llm.arrow import row_map

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Not text of the page, whatever they hold.
NEVER = frozenset("audio button canvas datalist head map noscript object select svg template video".split())
#: Marked by their tag; ``header`` is too, outside an article.
MARKED = frozenset("aside dialog footer form menu nav".split())
#: Blocks of running text: what is inside them is no element of the page's layout.
TEXT_BLOCKS = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
#: Plain characters from which an element that is marked by its name, or by its tag or role, may hold most of the text.
LEAST_NAMED, LEAST_TAGGED = 100, 200
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Parts of a class or id that name something other than the article.
NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs captcha comment comments consent cookie cookies copyright discussion disqus footer form gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommendations recommended related "
    "replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: What a start tag closes, and the elements that this doesn't reach beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"optgroup"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "thead": ({"tbody", "tfoot", "thead"}, {"table"}), "tbody": ({"tbody", "tfoot", "thead"}, {"table"}), "tfoot": ({"tbody", "tfoot", "thead"}, {"table"}),
}
FENCE = frozenset({"td", "th", "caption", "table"})
#: Comments and declarations, or a tag: a quote only counts after an equals sign, an unclosed one runs to the end.
TAG = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/[^a-zA-Z][^>]*(?:>|\Z)"""
    r"""|(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*)(?:>|\Z))""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: What a class name starts with that says what isn't there, is there too, or is the subject.
ASIDE = frozenset("cat category has no not subject tag tax taxonomy term topic with without".split())
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("article", "best", "chars", "density", "items", "link_chars", "link_tags", "links_before", "marked", "parent", "plain", "runs", "sum", "tag", "tags", "taken")

    def __init__(self, tag: str, parent: Node | None, links: int):
        self.tag, self.parent, self.links_before = tag, parent, links
        self.items: list = []
        #: of each run of text: characters, tags, link characters, link tags
        self.runs: list[list[int]] = [[0, 0, 0, 0]]
        self.chars = self.tags = self.link_chars = self.link_tags = self.plain = 0
        self.density = self.sum = 0.0
        self.best, self.taken = self, False
        #: 1 by a name, 2 by the tag or role
        self.marked = 0
        #: the outermost article element that holds this node, itself included
        self.article = parent.article if parent and parent.article else self if tag == "article" else None


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)} if "=" in raw or "hidden" in raw else {}


def _hidden(found: dict[str, str]) -> bool:
    return "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.I) is not None


def _named(found: dict[str, str], in_article: bool) -> int:
    """Whether a role (2) or a class or id (1) names something other than the article."""
    if found.get("role", "").lower() in ROLES:
        return 2
    names = set()
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        parts = [x.lower() for x in PART.findall(name)]
        if parts and not (len(parts) > 1 and parts[0] in ASIDE):
            names.update(parts)
    names &= NAMES
    return int(bool(names - {"header"} if in_article else names))


def parse(html: str) -> tuple[Node, list[Node]]:
    """The body and all nodes, parents before children; what is no text of the page is not in the tree."""
    root = Node("body", None, 0)
    nodes, here, links, at, skip = [root], root, 0, 0, None
    stack: list[str] = []  # names within a skipped element
    held: Counter = Counter()  # open elements by name

    def ended() -> None:
        """A run of text ends."""
        if any(here.runs[-1]):
            here.runs.append([0, 0, 0, 0])

    def close(node: Node) -> None:
        nonlocal here, links
        while here is not root:
            gone, here = here, here.parent
            links = gone.links_before
            held[gone.tag] -= 1
            if gone is node:
                break
        ended()

    def opened(names, stop) -> Node | None:
        node = here if any(held[n] > 0 for n in names) else root
        while node is not root and node.tag not in stop:
            if node.tag in names:
                return node
            node = node.parent
        return None

    def text(piece: str) -> None:
        if piece and skip is None:
            n = len(" ".join(piece.split()))
            here.items.append(piece)
            run = here.runs[-1]
            run[0] += n
            if links:
                run[2] += n

    while (m := TAG.search(html, at)) is not None:
        text(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if not closing and tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if skip is not None:
            if closing:
                if tag in stack:
                    while stack.pop() != tag:
                        pass
                    if not stack:
                        skip = None
                elif opened({tag}, ()):
                    # the skipped element was never closed, but what holds it is
                    stack.clear()
                    skip = None
                    close(opened({tag}, ()))
            elif tag not in VOID and not m[3].endswith("/") and not (tag in ("p", "li", "option") and stack[-1] == tag):
                stack.append(tag)
            continue
        if closing:
            if tag == "a":
                links = max(0, links - 1)
            elif (tag in BLOCKS or held[tag] > 0) and tag not in ("html", "body") and (node := opened({tag}, () if tag in ("table", "tr", "td", "th", "tbody", "thead", "tfoot") else FENCE)):
                close(node)
            continue
        if tag in ("html", "body"):
            continue
        found, inside = _attributes(m[3]), here.article is not None
        gone, named = tag in NEVER or _hidden(found), _named(found, inside)
        block = tag in BLOCKS
        if not block and (tag in VOID or tag == "a" or not (gone or named and here.tag not in TEXT_BLOCKS)):
            if tag in ("br", "wbr"):
                here.items.append(" " if tag == "br" else "")
            here.runs[-1][1] += 1
            if tag == "br":
                ended()
            elif tag == "a":
                links = 1
                here.runs[-1][3] += 1
            continue
        if not block and m[3].endswith("/"):
            continue
        if block and tag not in ("option", "optgroup") and (node := opened({"p"}, FENCE)):
            close(node)
        if tag in CLOSES:
            names, stop = CLOSES[tag]
            while node := opened(names, stop):
                close(node)
        here.items.append(None)  # a block ends here, even if what follows is left out
        ended()
        if tag == "hr":
            here.runs[-1][1] += 1
            continue
        if gone:
            skip, stack = tag, [tag]
            continue
        node = Node(tag, here, links)
        node.marked = 2 if tag in MARKED or tag == "header" and not inside else named
        here.items.append(node)
        nodes.append(node)
        here = node
        held[tag] += 1
    text(unescape(html[at:]))
    return root, nodes


def judge_marks(root: Node, nodes: list[Node]) -> None:
    """Takes void marks off: see the module's text."""
    holds = dict.fromkeys(nodes, 0)
    for node in reversed(nodes):
        node.plain += sum(run[0] - run[2] for run in node.runs)
        holds[node] += node.tag == "main" or node.tag == "article" and not node.marked
        if node.parent:
            node.parent.plain += node.plain
            holds[node.parent] += holds[node]
    for node in nodes:
        if not node.marked:
            continue
        most = node.plain >= (LEAST_NAMED if node.marked == 1 else LEAST_TAGGED) and 2 * node.plain > (node.article or root).plain
        if node.tag in ("article", "main") or holds[node] or most and (node.article or not holds[root]):
            node.marked = 0


def density(c: int, t: int, lc: int, lt: int, body_links: float) -> float:
    """Composite text density; zero for nothing but links."""
    if not c:
        return 0.0
    plain, t, lc, lt = max(1, c - lc), max(1, t), max(1, lc), max(1, lt)
    base = log(c / plain * lc + body_links * c + e)
    return c / t * log(max(1.0, c / lc * t / lt)) / log(base)


def measure(root: Node, nodes: list[Node]) -> None:
    """Counts of subtrees, densities, density sums, and the node of each subtree with the greatest sum."""
    judge_marks(root, nodes)
    for node in reversed(nodes):
        for c, t, lc, lt in node.runs:
            node.chars, node.tags, node.link_chars, node.link_tags = node.chars + c, node.tags + t, node.link_chars + lc, node.link_tags + lt
        if node.marked:
            node.link_chars, node.link_tags = node.chars, node.tags
        if up := node.parent:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + bool(node.marked)
    body_links = root.link_chars / max(1, root.chars)
    for node in reversed(nodes):
        node.density = 0.0 if node.marked else density(node.chars, node.tags, node.link_chars, node.link_tags, body_links)
        if not node.marked:
            node.sum += sum(density(*run, body_links) for run in node.runs)
        if up := node.parent:
            up.sum += node.density
        for child in node.items:
            if isinstance(child, Node) and not child.marked and child.best.sum > node.best.sum:
                node.best = child.best


def select(root: Node, nodes: list[Node]) -> None:
    """Marks the nodes whose text is the page's as taken."""
    core = root.best
    threshold, node = core.density, core
    while node is not None:
        threshold = min(threshold, node.density)
        node = node.parent
    pending = [root]
    while pending:
        node = pending.pop()
        if node.taken or node.density < threshold or not node.chars or node.marked:
            continue
        part = node.best if node.best.sum else node
        (part.article or part).taken = True
        pending += [x for x in node.items if isinstance(x, Node)]
    # what lies between the parts: among the children of the lowest node that holds them all
    whole, below = core.article or core, dict.fromkeys(nodes, 0)
    for node in reversed(nodes):
        below[node] += node.taken
        if node.parent:
            below[node.parent] += below[node]
    while below[whole] < below[root]:
        whole = whole.parent
    if not whole.taken:
        children = [x for x in whole.items if isinstance(x, Node)]
        at = [i for i, x in enumerate(children) if below[x]]
        for child in children[at[0] : at[-1]] if at else ():
            child.taken = child.taken or child.density > 0


def blocks(root: Node) -> list[str]:
    """The blocks of taken nodes without what is marked in them, in page order."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if words := " ".join("".join(run).split()):
            out.append(words)
        run.clear()

    pending: list = [(root, False)]
    while pending:
        item, inside = pending.pop()
        if isinstance(item, Node):
            inside = (inside or item.taken) and not item.marked
            flush()
            pending.append((None, inside))
            pending += [(x, inside) for x in reversed(item.items)]
        elif item is None:
            flush()
        elif inside:
            run.append(item)
    flush()
    return out


def main_text(html: bytes | str | None) -> str:
    if isinstance(html, bytes):
        html = html.decode("utf-8", "replace")
    root, nodes = parse(html or "")
    measure(root, nodes)
    select(root, nodes)
    return "\n".join(blocks(root))


def extract(pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    slim = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("binary").alias("html"))

    def one(value: bytes | None) -> tuple[str, int]:
        text = main_text(value)
        return text, len(text)

    run = row_map("html", lambda: one, ["text", "n_chars"], [pa.string(), pa.int64()])
    return slim.mapInArrow(run, f"page_id {slim.schema['page_id'].dataType.simpleString()}, url {slim.schema['url'].dataType.simpleString()}, text string, n_chars bigint")
