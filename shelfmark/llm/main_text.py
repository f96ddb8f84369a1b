"""Main text of web pages by composite text density.

A page becomes a tree of elements without those that never hold an article (menus, headers, footers, sidebars, forms, scripts, notices,
adverts and reader comments, by element name, role, or words of class and id).  Each node gets its characters per tag, adjusted by the share
of characters and tags that are links:

    density = C/T * log(C/LC * T/LT) / log(log(C/notLC * LC + LCb/Cb * C + e))

with C characters and T tags below the node, LC and LT those in links, notLC those outside, and b the body; every divisor is at least 1.  A
node's sum is that of its children's densities, its own text counting as one more child.  The node of the greatest sum is the article; the
smallest density on its path to the body is the threshold.  From the body down, wherever a node reaches the threshold, the subtree with the
greatest sum in it is content, and so on among the children outside of it.  A page that marks its article (``article``, else ``main``) is searched
there alone, and content is widened to that element, so that a short paragraph or a heading beside the densest part is not lost.

Blocks (paragraphs, headings, list items, cells, lines broken by ``br``) are joined by one space, white space inside one is one space, and
character references are decoded.  A null or empty page, or one without text, gives an empty text.  Pages are handled one by one inside the
task that reads them and nothing is shuffled; a page's tree is as large as the page.  Repeated rows are rows of their own; further columns and
tables without rows pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base link meta noscript script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
NEVER = frozenset("head nav footer aside form script style noscript template iframe object embed svg math canvas audio video button select "
                  "option textarea input dialog menu map title xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
ARTICLE = ("article", "main")

# Words of class and id that name a part that is no article.
_ASIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|newsletters?|"
    r"subscribe|subscription|sidebars?|menus?|nav|navbar|navigation|breadcrumbs?|footers?|headers?|masthead|topbar|share|sharing|social|related|"
    r"recommended|comments?|respond|replies|disqus|widgets?|popups?|modal|overlay|login|signup|search|pagination|pager|toolbar)(?=$|[\s_-])", re.I)

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# What a start tag closes, and the element that such a search does not leave.
_BLOCKS_CLOSE_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                            "h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_P = frozenset(["p"])
_CLOSES = {"li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
           "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])), "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
           "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
           "tbody": (frozenset(["tr", "td", "th", "thead", "tbody", "tfoot"]), frozenset(["table"])),
           "tfoot": (frozenset(["tr", "td", "th", "thead", "tbody"]), frozenset(["table"])),
           "option": (frozenset(["option"]), frozenset(["select"]))}
_FENCE = frozenset("table td th caption button object template body html article section main aside nav footer header form div blockquote li ul ol dl dd".split())


class Node:
    __slots__ = ("tag", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "own", "density", "total")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.parts = tag, parent, []  # parts: texts and nodes, in page order


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _aside(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element is left out with all below it."""
    if tag in NEVER or tag == "header" and not in_article:
        return True
    if not attrs:
        return False
    a = _attributes(attrs)
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in ROLES or _HIDDEN.search(a.get("style", "")):
        return True
    return tag not in ARTICLE and any(_ASIDE.search(a[k]) is not None for k in ("class", "id") if k in a)


def _close(open_: list[str], names: frozenset[str], fence: frozenset[str]) -> int:
    """How many elements stay open when the topmost of `names` within `fence` is closed."""
    for i in range(len(open_) - 1, 0, -1):
        if open_[i] in names:
            return i
        if open_[i] in fence:
            break
    return len(open_)


def tree(page: str) -> Node:
    """The body without parts that are no article."""
    root = Node("body", None)
    open_, nodes = ["body"], [root]  # element names and their nodes; None below a part that is left out
    count: Counter[str] = Counter()  # of open elements by name
    at, n = 0, len(page)

    def close(i: int) -> None:
        for name in open_[i:]:
            count[name] -= 1
        del open_[i:], nodes[i:]

    def text(lo: int, hi: int) -> None:
        if lo < hi and nodes[-1] is not None:
            s = page[lo:hi]
            nodes[-1].parts.append(html.unescape(s) if "&" in s else s)

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if count["head"] and not (tag == "head" or tag in HEAD):  # the head ends where something stands that cannot be in it
            close(open_.index("head"))
        if tag in ("html", "body"):
            continue
        if m[1]:
            if tag == "br":
                if nodes[-1] is not None:
                    nodes[-1].parts.append(Node("br", nodes[-1]))
            elif count[tag]:
                i = len(open_) - 1
                # An inline end tag does not close the block it stands in.
                while open_[i] != tag and (tag not in INLINE or open_[i] in INLINE):
                    i -= 1
                if open_[i] == tag:
                    close(i)
            continue
        if tag in _BLOCKS_CLOSE_P:
            close(_close(open_, _P, _FENCE))
        if tag in _CLOSES:
            close(_close(open_, *_CLOSES[tag]))
        parent = nodes[-1]
        node = None
        if parent is not None and not _aside(tag, m[3], any(count[t] for t in ARTICLE)):
            node = Node(tag, parent)
            parent.parts.append(node)
        elif parent is not None and tag not in INLINE:
            parent.parts.append(Node("br", parent))  # the place of a part left out still parts its neighbours
        if tag in VOID or m[3].endswith("/") and tag not in RAW and tag not in INLINE and tag not in _BLOCKS_CLOSE_P:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        open_.append(tag)
        nodes.append(node)
        count[tag] += 1
    return root


def _order(root: Node) -> list[Node]:
    """All nodes, each before those below it."""
    out = [root]
    for node in out:
        out.extend(p for p in node.parts if p.__class__ is Node)
    return out


def weigh(root: Node) -> list[Node]:
    """Sets counts, densities and sums of all nodes; returns them, parents first."""
    order = _order(root)
    links = {id(root): False}
    for node in order[1:]:
        links[id(node)] = node.tag == "a" or links[id(node.parent)]
    for node in reversed(order):
        own = sum(len("".join(p.split())) for p in node.parts if p.__class__ is str)
        below = [p for p in node.parts if p.__class__ is Node]
        node.own = own
        node.chars = own + sum(p.chars for p in below)
        node.tags = sum(p.tags + 1 for p in below)
        in_link = links[id(node)]
        node.link_chars = node.chars if in_link else sum(p.link_chars for p in below)
        node.link_tags = sum(p.link_tags + (p.tag == "a") for p in below)
    share = root.link_chars / max(root.chars, 1)

    def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
        if not chars:
            return 0.0
        tags, in_links = max(tags, 1), max(link_chars, 1)
        base = log(chars / max(chars - link_chars, 1) * in_links + share * chars + e)
        return chars / tags * log(max(chars / in_links * tags / max(link_tags, 1), 1.0)) / log(base)

    for node in reversed(order):
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
        node.total = density(node.own, 1, node.own if links[id(node)] else 0, 0) + sum(p.density for p in node.parts if p.__class__ is Node)
    return order


def content(root: Node) -> list[Node]:
    """The subtrees that hold the main text, in no order; none within another."""
    order = weigh(root)
    marks = next((found for tag in ARTICLE if (found := [x for x in order if x.tag == tag and x.chars])), [])
    within = {id(x) for x in marks}
    for node in order:  # parents first
        if node.parent is not None and id(node.parent) in within:
            within.add(id(node))
    best = max((x for x in order if id(x) in within or not marks), key=lambda x: x.total)
    if not best.chars:
        return []
    threshold, up = best.density, best
    while up is not None:
        threshold, up = min(threshold, up.density), up.parent
    # The greatest sum in each subtree, from below; of equal ones the topmost.
    top: dict[int, Node] = {}
    for node in reversed(order):
        own = top.get(id(node))
        top[id(node)] = node if own is None or node.total >= own.total else own
        if node.parent is not None:
            mine, there = top[id(node)], top.get(id(node.parent))
            top[id(node.parent)] = mine if there is None or mine.total >= there.total else there
    marked: dict[int, Node] = {}
    queue = [x for x in marks if id(x.parent) not in within] or [root]
    while queue:
        node = queue.pop()
        if id(node) in marked or node.density < threshold or not node.chars:
            continue
        pick = top[id(node)]
        marked[id(pick)] = pick
        queue.extend(p for p in node.parts if p.__class__ is Node)
    out: dict[int, Node] = {}
    for node in marked.values():
        wide, up = node, node
        while up is not None:
            if id(up) in within and (up.tag == marks[0].tag or id(up) in marked) or not marks and id(up) in marked:
                wide = up
            up = up.parent
        out[id(wide)] = wide
    return list(out.values())


def text_of(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root = tree(page)
    kept = {id(x) for x in content(root)}
    out: list[str] = []
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        part, inside = stack.pop()
        if part.__class__ is str:
            if inside:
                out.append(part)
            continue
        inside = inside or id(part) in kept
        block = part.tag not in INLINE
        if block and inside:
            out.append(" ")
            stack.append((" ", inside))
        stack.extend((p, inside) for p in reversed(part.parts))
    return " ".join("".join(out).split())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([text_of(p) for p in batch.column("html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), texts], names=["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row; n_chars counts code points."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_texts, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
