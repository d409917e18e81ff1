"""Main text of web pages by tree scoring.

A page becomes a tree. Every paragraph passes points (one, one for each comma,
up to three for length) to its ancestors, less with each step up; a
container's points are discounted by the share of its text that is links. The
container with the most points, and those siblings that look like part of the
article, give the text. Menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are left out before scoring.

One page is one row's work: Spark partitions the pages, nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import pieces

# Element names of HTML, by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead
tr ul""".split())
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
DROPPED = set("""script style noscript template iframe object embed svg math canvas audio video map nav footer aside form button
select option textarea input dialog menu head title""".split())
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words of class and id names that mark what is no article, and what may be one.
NOT_ARTICLE = set("""ad ads advert advertisement adverts advertising banner sponsor sponsored promo promotion menu nav navbar navigation
sidebar footer header masthead breadcrumb breadcrumbs comment comments disqus discussion replies reply respond cookie cookies consent
gdpr notice popup modal overlay share sharing social related recommended newsletter subscribe subscription signup login pager
pagination toolbar widget""".split())
ARTICLE = set("article body content entry hentry main page post story text blog".split())
# Words that turn a name such as "with-sidebar" or "comments-open" into a statement about the page.
STATES = set("with without has have no not non is free open closed enabled disabled off on hide hidden show layout".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())

#: Share of the page's paragraph text from which an element is no aside, whatever its name says.
MOST = 0.9
#: Share of linked text up to which what stands between parts of the article belongs to it.
BETWEEN = 0.5

# Attributes as HTML reads them: a quote opens a value only straight after ``=``, elsewhere it is a character like others.
ATTRIBUTES = r"(?:[\s/]|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>)))?+)*+"
TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)({ATTRIBUTES}(?=>)|[^>]*+)>|<(/?)([a-zA-Z][^\s/>]*)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)))?")
WORD = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "points", "length", "linked", "commas", "own", "article", "scored")

    def __init__(self, tag: str, attrs: str, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list = []
        self.points, self.length, self.linked, self.scored = 0.0, 0, 0, False
        self.commas, self.own, self.article = 0, (0, 0), False


class Stack:
    """Open elements, and for each name the depths at which it is open: an end tag costs what it closes, not the depth."""

    def __init__(self, root: Node):
        self.nodes, self.depths = [root], {}

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def last(self, names) -> int:
        """The greatest depth at which one of ``names`` is open, 0 if none is."""
        return max((d[-1] for name in names if (d := self.depths.get(name))), default=0)

    def first_after(self, names, depth: int) -> int:
        """The least depth beyond ``depth`` at which one of ``names`` is open, 0 if none is."""
        found = [d[k] for name in names if (d := self.depths.get(name)) and (k := bisect_right(d, depth)) < len(d)]
        return min(found, default=0)

    def close(self, depth: int) -> None:
        while len(self.nodes) > depth:
            self.depths[self.nodes.pop().tag].pop()


BARRIERS = ("article", "main", "body", "table", "td", "th")
P_STOPS = ("table", "td", "th", "button", "object", "div", "section", "article", "li")


def tree(html: str) -> Node:
    """A forgiving parse: unknown ends are skipped, open elements end where HTML implies it; a tag whose
    quoted value never closes ends at its next ``>``."""
    root = Node("#root", "", None)
    stack = Stack(root)
    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if m is None:
            stack.nodes[-1].children.append(html[at:])
            break
        if m.start() > at:
            stack.nodes[-1].children.append(html[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group(5) is not None:  # a tag without any > to end it: the rest is no text
                break
            continue
        name = name.lower()
        if m.group(1):
            open_ = stack.last([name])
            if open_ and (name in BLOCK or open_ >= stack.last(BARRIERS)):
                stack.close(open_)
            continue
        if name in CLOSES_P:
            open_ = stack.last(["p"])
            if open_ > stack.last(P_STOPS):
                stack.close(open_)
        if name in SAME:
            closes, stops = SAME[name]
            open_ = stack.first_after(closes, stack.last(stops))
            if open_:
                stack.close(open_)
        here = stack.nodes[-1]
        node = Node(name, m.group(3), here)
        here.children.append(node)
        if name in RAW:
            end = _raw_end(html, name, at)
            node.children.append(html[at:end[0]])
            at = end[1]
        elif name not in VOID and (name in BLOCK or not m.group(3).rstrip().endswith("/")):
            stack.push(node)
    return root


_ENDS: dict[str, re.Pattern] = {}


def _raw_end(html: str, name: str, at: int) -> tuple[int, int]:
    if name not in _ENDS:
        _ENDS[name] = re.compile(rf"</{name}[^>]*>", re.I)
    m = _ENDS[name].search(html, at)
    return (m.start(), m.end()) if m else (len(html), len(html))


def left_out(node: Node, inside: bool, paragraphs: int) -> bool:
    """Whether an element is no part of any article; ``inside``: it stands in an article or main element.

    What holds an article or main element, or nearly all of the page's
    ``paragraphs`` characters, is never left out for its name, nor is a form around it.
    """
    tag = node.tag
    whole = node.article or node.length > MOST * paragraphs > 0
    if tag in DROPPED:
        return not (tag == "form" and whole)
    if tag == "header" and not inside:
        return True
    if not node.attrs.strip() or tag in ("html", "body", "article", "main"):
        return False
    attrs = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTRIBUTE.findall(node.attrs)}
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if whole:
        return False
    if attrs.get("role", "").lower() in ROLES:
        return True
    if tag in ("span", "a", "b", "i", "em", "strong", "h1", "h2", "h3", "blockquote", "pre"):
        return False
    words: set[str] = set()
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        own = set(WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()))
        if not (own & STATES and own & NOT_ARTICLE):
            words |= own
    if tag == "header" or words & ARTICLE and not words & {"comment", "comments", "ad", "ads", "sidebar", "related", "footer", "nav", "menu"}:
        return False
    return bool(words & NOT_ARTICLE)


def prune(root: Node, nodes: list[Node]) -> None:
    """Take out what is no part of an article; ``nodes`` are measured."""
    for node in reversed(nodes):
        node.article = any(not isinstance(c, str) and (c.article or c.tag in ("article", "main")) for c in node.children)
    # text of plain elements only: scripts, menus and the like say nothing on what the page is about
    plain, stack = 0, [root]
    while stack:
        node = stack.pop()
        if node.tag not in DROPPED or node.tag == "form":
            plain += node.own[0]
            stack += [c for c in node.children if not isinstance(c, str)]
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main")
        node.children = [c for c in node.children if isinstance(c, str) or not left_out(c, inside, plain)]
        stack += [(c, inside) for c in node.children if not isinstance(c, str)]


def in_order(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if not isinstance(c, str)]
    return out


def measure(nodes: list[Node]) -> None:
    """Length of text, of linked text and commas of every node, children before parents."""
    for node in reversed(nodes):
        texts = [SPACE.sub(" ", c).strip() for c in node.children if isinstance(c, str)]
        below = [c for c in node.children if not isinstance(c, str)]
        node.own = (sum(map(len, texts)), sum(t.count(",") for t in texts))
        node.length = node.own[0] + sum(c.length for c in below)
        node.commas = node.own[1] + sum(c.commas for c in below)
        node.linked = node.length if node.tag == "a" else sum(c.linked for c in below)


def is_paragraph(node: Node) -> bool:
    """A paragraph element, or another block that holds text and no blocks."""
    if node.tag in ("p", "pre", "td", "blockquote"):
        return not any(not isinstance(c, str) and c.tag in BLOCK for c in node.children) or node.tag == "p"
    return (node.tag in ("div", "section", "article", "main", "li", "dd", "body", "#root") and any(isinstance(c, str) and c.strip() for c in node.children))


def score(nodes: list[Node], shortest: int) -> None:
    """Points of all containers in one climb: a paragraph's go whole to the nearest, half to the next, a ninth
    to the third and three quarters of what came to the one before to each further one."""
    first: dict[int, float] = {}  # points that reach a node at its first, second and later steps
    second: dict[int, float] = {}
    later: dict[int, float] = {}
    add = lambda to, node, points: to.__setitem__(id(node), to.get(id(node), 0.0) + points)
    for node in reversed(nodes):
        if is_paragraph(node):
            own = node.tag in ("p", "pre", "td", "blockquote")
            length, commas = (node.length, node.commas) if own else node.own
            if length >= max(shortest, 1):
                container = node.parent if own else node
                if container is not None:
                    add(first, container, 1 + commas + min(length / 100, 3))
        up = node.parent
        a, b, c = (d.get(id(node), 0.0) for d in (first, second, later))
        if a or b or c:
            node.scored = True
            node.points = weight(node) + a + b / 2 + c
            if up is not None:
                add(second, up, a)
                add(later, up, b / 9 + c * 3 / 4)


def texts_of(node: Node) -> list[str]:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            if x.tag == "br":
                out.append(" ")
            stack += reversed(x.children)
    return out


def weight(node: Node) -> float:
    """Points that a container starts with, by its name."""
    start = {"article": 10.0, "main": 8.0, "div": 5.0, "section": 4.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "address": -3.0,
             "ol": -3.0, "ul": -3.0, "dl": -3.0, "li": -3.0, "th": -5.0}.get(node.tag, 0.0)
    if node.attrs and set(WORD.findall(node.attrs.lower())) & ARTICLE:
        start += 5
    return start


def density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks below ``nodes``, in page order, white space made one space."""
    out: list[str] = []
    open_text: list[str] = []

    def close():
        text = SPACE.sub(" ", unescape("".join(open_text))).strip()
        if text:
            out.append(text)
        open_text.clear()

    stack: list = []
    for node in reversed(nodes):
        stack.append(node)
    while stack:
        x = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            open_text.append(x)
        elif x.tag in BLOCK or x.tag == "#root":
            close()
            stack.append(None)
            stack += reversed(x.children)
        elif x.tag == "br":
            open_text.append(" ")
        else:
            stack += reversed(x.children)
    close()
    return out


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by an empty line; empty if there is none."""
    if not html:
        return ""
    root = tree(html)
    nodes = in_order(root)
    measure(nodes)
    prune(root, nodes)
    nodes = in_order(root)
    measure(nodes)
    if not root.length:
        return ""
    for shortest in (25, 1):
        score(nodes, shortest)
        scored = [n for n in nodes if n.scored]
        if scored:
            break
    else:
        return "\n\n".join(blocks([root]))
    for n in scored:
        n.points *= 1 - density(n)
    best = max(scored, key=lambda n: n.points)
    up = best
    while up is not None and up.tag != "article":
        up = up.parent
    best = up or best
    if best.parent is None:
        return "\n\n".join(blocks([best]))
    return "\n\n".join(blocks(siblings(best)))


def siblings(best: Node) -> list:
    """The best container, its siblings that look like part of the article, and what stands between those.

    Between two parts, headings, lists, tables, bare text and the like stay
    unless they are mostly links; so do headings just before the first part.
    """
    around = best.parent.children
    least = max(10.0, 0.2 * best.points)
    part = [_is_part(c, best, least) for c in around]
    lo, hi = part.index(True), len(part) - 1 - part[::-1].index(True)
    while lo and (_is_heading(around[lo - 1]) or isinstance(around[lo - 1], str) and not around[lo - 1].strip()):
        lo -= 1
    return [c for k, c in enumerate(around[lo:hi + 1], lo) if part[k] or isinstance(c, str) or density(c) <= BETWEEN]


def _is_heading(c) -> bool:
    return not isinstance(c, str) and c.tag in HEADINGS and density(c) <= BETWEEN


def _is_part(c, best: Node, least: float) -> bool:
    if c is best:
        return True
    if isinstance(c, str):
        return False
    if c.scored and c.points >= least and c.tag not in ("ul", "ol"):
        return True
    if c.tag != "p":
        return False
    text = SPACE.sub(" ", "".join(texts_of(c))).strip()
    return len(text) > 80 and density(c) < 0.25 or 0 < len(text) <= 80 and not c.linked and bool(re.search(r"[.!?…。]$", text))


def extract(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row, repeated rows and null ids included.

    A null or empty page, or one without an article, gives the empty text.
    Broken markup is read as far as it goes. Other columns are not read.
    """
    def run(batches):
        for piece in pieces(batches, 2):
            texts = [main_text(h) for h in piece.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
