"""Main text of web pages by composite text density.

The page is parsed into a tree with the end tags that HTML leaves out. Parts that are never text go first: scripts,
styles, buttons, fields. Tags such as nav, footer and form, and names of class, id and role such as "comments" or
"sidebar", are hints at parts outside the article, which the page has to confirm: a hinted part goes only if it holds no
<article> or <main> and no large share of the page's text outside links; ambiguous names need many links as well, or a
small container outside any <article>; readers' comments go whatever their size where other text remains. On the rest, every node gets a composite text density: characters per tag, weighed down
by the share of link characters and link tags against the share in the whole body. A node's density sum adds the
densities of its children. The node with the largest density sum is the centre of the article; the least density on
its path to the body is the threshold, and the topmost nodes that reach the threshold and lie on or beside that path
are searched for their own maximum-sum subtree, whose text is kept. Text is cut into blocks at block elements.

Defined results: a null, empty or textless page gives an empty text; a page without a body counts as all body; broken
references and tags are kept as text as browsers do; pages are independent, so repeated rows repeat; other columns
are ignored. One regular expression walks the page once and no step recurses, so depth and length are no limit.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?>\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>",
    re.DOTALL,
)
CUT_TAG = re.compile(r"<(?:[/!?]?[a-zA-Z!?-][^>]*|/)?\Z")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
DROPPED = frozenset(
    "script style template noscript iframe object embed svg math canvas audio video head title "
    "button select option textarea input noframes noembed".split()
)
#: Tags that hint at parts outside the article; those of forms also wrap whole pages.
OUTSIDE_TAGS = frozenset("nav footer aside menu dialog".split())
FORM_TAGS = frozenset("form fieldset label".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
LINKS = frozenset(("a", "button", "select", "input", "textarea"))
#: What a new element ends when it is open, and what keeps the search for it inside.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
P_ENDS = BLOCK - frozenset(("html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"))
P_ENDS |= frozenset(("li", "dd", "dt"))
#: Names in class, id and role that hint at parts outside the article; fixed values. A name counts as a whole, or if all
#: of its hyphened parts are such names or ``FRAME`` words: "cookie-notice", "comment-list", but not "with-sidebar".
OUTSIDE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored "
    "nav navbar navigation menubar breadcrumb breadcrumbs pagination pager masthead topbar footer colophon "
    "sidebar aside complementary contentinfo cookie cookies gdpr newsletter subscribe "
    "comment comments disqus respond replies".split()
)
#: Names that parts of an article have, too.
AMBIGUOUS = frozenset(
    "banner promo promotion menu toc copyright legal side related recommended widget widgets consent notice alert popup "
    "modal overlay subscription signup login share sharing social reply discussion search form skip".split()
)
FRAME = frozenset("area bar block box container inner item items list section site wrap wrapper".split())
#: "header" does not count where these stand beside it: it is then the article's own. Beside them other names are
#: ambiguous.
ARTICLE_WORDS = frozenset("article post entry content story body main".split())
WORDS = re.compile(r"[a-z]+")
#: Those of the names above that mean what readers say.
REMARK_WORDS = frozenset("comment comments disqus respond replies".split())
#: Strength of a hint: none, ambiguous name, form tag, clear name or tag, name of readers' comments.
NONE, MAYBE, FORM, CLEAR, REMARKS = range(5)
#: Shares of the page's text outside links above which a hinted part stays.
LARGE = {MAYBE: 0.1, FORM: 0.1, CLEAR: 0.5, REMARKS: 0.5}
#: Text outside hinted parts, headings and links beside which comments go however long they are: so many characters,
#: and this share of the comments'. Beside any such text they go if they are mostly a list of items built alike.
REST_CHARS, REST_SHARE = 40, 0.01
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Share of link characters from which an ambiguous name is confirmed.
LINKED = 1 / 3
#: Elements that an ambiguous name alone can take out, if they are small and stand outside any <article>.
CONTAINERS = frozenset("div section ul ol dl table".split())
#: Text outside links of an <article> or <main> beside which a clearly named part goes even if it is the larger one; a
#: part of less text than this goes beside any <article> or <main> with text.
ARTICLE_CHARS = 250


class Node:
    """An element; ``parts`` holds text and child elements in page order."""

    __slots__ = ("tag", "parent", "in_article", "hint", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.hint = NONE
        self.in_article = tag == "article" or (parent is not None and parent.in_article)
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0

    def children(self) -> Iterator[Node]:
        return (p for p in self.parts if type(p) is Node)


def named_outside(name: str) -> int:
    """The hint of one name of a class, id or role."""
    if name in REMARK_WORDS:
        return REMARKS
    if name in OUTSIDE:
        return CLEAR
    if name in AMBIGUOUS:
        return MAYBE
    words = [w for w in WORDS.findall(name) if w not in FRAME]
    if not words or not all(w in OUTSIDE or w in AMBIGUOUS for w in words):
        return NONE
    if not REMARK_WORDS.isdisjoint(words):
        return REMARKS
    return CLEAR if any(w in OUTSIDE for w in words) else MAYBE


def hinted(tag: str, attributes: str, in_article: bool) -> int:
    """How strongly tag, class, id, role or being hidden hint at a part outside the article."""
    if tag in ("html", "body", "article", "main"):
        return NONE
    hint = NONE
    if tag in OUTSIDE_TAGS or (tag == "header" and not in_article):
        hint = CLEAR
    elif tag in FORM_TAGS:
        hint = FORM
    for name, a, b, c in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "style" and "display:none" in "".join(value.split())):
            return CLEAR
        if name not in ("class", "id", "role"):
            continue
        names = value.split()
        words = WORDS.findall(value)
        found = max(map(named_outside, names), default=NONE)
        own = not ARTICLE_WORDS.isdisjoint(words)
        if "header" in words and not in_article and not own and all(w == "header" or w in FRAME for w in words):
            found = CLEAR
        hint = max(hint, min(found, MAYBE) if own else found)
    return hint


def parse(page: str) -> Node:
    """The tree below a root, without the parts that are never text; parts that may lie outside the article are hinted."""
    root = node = Node("#root", None)
    outside: Node | None = None  # the dropped element that is open, if any
    opened: Counter[str] = Counter()  # how many elements of each tag are open
    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if found is None:
            text = CUT_TAG.sub("", text)
        if text and outside is None:
            node.parts.append(html.unescape(text) if "&" in text else text)
        if found is None:
            break
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["end"] or found["end2"]:
            if opened[tag]:
                top = node
                while top.tag != tag:
                    top = top.parent
                node, outside = _ended(node, top, opened, outside)
            elif tag == "p" and outside is None:
                node.parts.append(Node("p", node))
            elif tag == "br" and outside is None:
                node.parts.append(Node("br", node))
            continue
        attributes = found["attributes"] or found["attributes2"] or ""
        if tag in VOID:
            if outside is None and tag not in DROPPED:
                node.parts.append(Node(tag, node))
            continue
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*/?>", re.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        node, outside = _implied_ends(node, tag, opened, outside)
        child = Node(tag, node)
        if outside is None:
            if tag in DROPPED:
                outside = child
            else:
                child.hint = hinted(tag, attributes, node.in_article)
                node.parts.append(child)
        if not (attributes.endswith("/") and tag in RAW):
            node = child
            opened[tag] += 1
    return root


def _ended(node: Node, top: Node, opened: Counter, outside: Node | None) -> tuple[Node, Node | None]:
    """Ends the open elements from ``node`` up to ``top``; the open element that is left, and the dropped one."""
    while True:
        opened[node.tag] -= 1
        if node is outside:
            outside = None
        if node is top:
            return node.parent, outside
        node = node.parent


def _implied_ends(node: Node, tag: str, opened: Counter, outside: Node | None) -> tuple[Node, Node | None]:
    """Ends the elements that ``tag`` ends when it begins."""
    ended, scope = CLOSES.get(tag, ((), ()))
    if tag in P_ENDS:
        ended, scope = (*ended, "p"), (*scope, "td", "th", "table", "button", "object")
    if not any(opened[t] for t in ended):
        return node, outside
    top, walk = None, node
    while walk is not None and walk.tag not in scope:
        if walk.tag in ended:
            top = walk
        walk = walk.parent
    return (node, outside) if top is None else _ended(node, top, opened, outside)


def in_order(root: Node) -> list[Node]:
    """Nodes with parents before children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed(list(node.children())))
    return order


def count(order: list[Node]) -> None:
    """Characters, tags and links of all nodes."""
    for node in reversed(order):
        node.tags = node.link_chars = node.link_tags = 0
        node.chars = sum(len("".join(p.split())) for p in node.parts if type(p) is str)
        for child in node.children():
            node.chars += child.chars
            node.tags += child.tags + 1
            node.link_chars += child.link_chars
            node.link_tags += child.link_tags + (child.tag in LINKS)
        if node.tag in LINKS:
            node.link_chars, node.link_tags = node.chars, node.tags


def without_outside(root: Node) -> None:
    """Takes out the hinted parts that the page's texts and links confirm."""
    order = in_order(root)
    if all(node.hint == NONE for node in order):
        return
    count(order)
    plain = root.chars - root.link_chars
    held: dict[int, int] = {}  # text outside links in the outermost <article> and <main> elements of a subtree
    for node in reversed(order):
        inside = [held[id(c)] for c in node.children() if id(c) in held]
        if node.tag in ("article", "main"):
            held[id(node)] = node.chars - node.link_chars
        elif inside:
            held[id(node)] = sum(inside)
    rest = text_elsewhere(root, held)
    stack = [root]
    while stack:
        node = stack.pop()
        gone = {
            id(c) for c in node.children() if c.hint and id(c) not in held and is_outside(c, plain, held.get(id(root), 0), rest)
        }
        if gone:
            node.parts = [p for p in node.parts if id(p) not in gone]
        stack.extend(node.children())


def text_elsewhere(root: Node, held: dict[int, int]) -> int:
    """Characters outside links, headings, and clearly hinted parts that hold no <article> or <main>."""
    total, stack = 0, [root]
    while stack:
        node = stack.pop()
        if node.tag in LINKS or node.tag in HEADINGS or (node.hint >= CLEAR and id(node) not in held):
            continue
        total += sum(len("".join(p.split())) for p in node.parts if type(p) is str)
        stack.extend(node.children())
    return total


def is_list(node: Node) -> bool:
    """Whether at least half of a part's text stands in neighbouring elements of one tag that hold the same tags."""
    stack = [node]
    while stack:
        parent = stack.pop()
        groups: Counter = Counter()
        alike: Counter = Counter()
        for child in parent.children():
            inner = tuple(c.tag for c in child.children())[:4]
            if inner and child.tag != "p":
                groups[child.tag, inner[0]] += child.chars
                alike[child.tag, inner[0]] += 1
        if any(2 * chars >= node.chars and alike[key] > 1 for key, chars in groups.items()):
            return True
        stack.extend(c for c in parent.children() if 2 * c.chars >= node.chars)
    return False


def is_outside(node: Node, page_plain: int, article_plain: int, rest: int) -> bool:
    """Whether a hinted part without <article> or <main> lies outside the article; ``rest``: see ``text_elsewhere``."""
    plain = node.chars - node.link_chars
    if node.hint == REMARKS and rest and (rest >= max(REST_CHARS, REST_SHARE * plain) or is_list(node)):
        return True
    if plain > LARGE[node.hint] * page_plain:
        least = min(ARTICLE_CHARS, page_plain / 4) if plain > ARTICLE_CHARS else 1
        if node.hint < CLEAR or node.in_article or article_plain < least:
            return False
    if node.hint != MAYBE or node.link_chars >= LINKED * node.chars:
        return True
    return node.tag in CONTAINERS and not node.in_article


def measure(root: Node) -> list[Node]:
    """Counts and densities of all nodes; returns them with parents first."""
    order = in_order(root)
    count(order)
    body = root
    link_share = body.link_chars / max(1, body.chars)
    for node in order:
        node.density = composite_density(node, link_share)
    for node in reversed(order):
        node.total = sum(child.density for child in node.children())
    return order


def composite_density(node: Node, link_share: float) -> float:
    """Characters per tag, times a logarithm whose base grows and whose argument falls with the node's links."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
    plain = max(1, node.chars - node.link_chars)
    base = math.log(node.chars / plain * links + link_share * node.chars + math.e)
    return node.chars / tags * math.log(max(1.0, node.chars / links * (tags / link_tags))) / math.log(base)


def selected(root: Node) -> set[int]:
    """The ids of the subtrees that hold the article."""
    order = measure(root)
    if not root.chars:
        return set()
    centre = max(order, key=lambda n: n.total)  # of equal sums the first in page order that is outermost
    path, walk = [], centre
    while walk is not None:
        path.append(walk)
        walk = walk.parent
    inner = [n for n in path if n.tag not in ("html", "body", "#root")]
    threshold = min(n.density for n in path if n.tag not in ("html", "#root") or n is centre)
    # the outermost node on the path below the page's frame that reaches the threshold bounds the search
    outer = next((n for n in reversed(inner) if n.density >= threshold), centre)
    best = max(in_order(outer), key=lambda n: n.total)
    walk = best
    while walk is not None and walk.tag != "article":
        walk = walk.parent
    best = walk or best
    out, walk = {id(best)} | lone_title(order, best), best
    while walk is not outer and walk.parent is not None:  # what stands beside the path and is as dense
        out.update(id(c) for c in walk.parent.children() if c is not walk and c.density >= threshold)
        walk = walk.parent
    return out


def lone_title(order: list[Node], best: Node) -> set[int]:
    """The page's only <h1>, if it has text, stands before the article and neither it nor what holds it is hinted."""
    titles = [n for n in order if n.tag == "h1" and n.chars > n.link_chars]
    if len(titles) != 1 or order.index(titles[0]) > order.index(best) or best.in_article:
        return set()
    walk = titles[0]
    while walk is not None:
        if walk.hint or walk is best:
            return set()
        walk = walk.parent
    return {id(titles[0])}


def main_text(page: str | None) -> str:
    """The article's blocks, joined by two line ends."""
    if not page:
        return ""
    root = parse(page)
    without_outside(root)
    wanted = selected(root)
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    # entries: (node, whether inside a wanted subtree) to open, text to add, or None to end a block
    stack: list = [(root, False)]
    while stack:
        entry = stack.pop()
        if entry is None:
            end_block()
        elif type(entry) is str:
            line.append(entry)
        else:
            node, inside = entry
            starts = not inside and id(node) in wanted
            inside = inside or starts
            edge = node.tag in BLOCK or starts
            if node.tag == "br":
                stack.append(" ")
            if edge:
                end_block()
                stack.append(None)
            for part in reversed(node.parts):
                if type(part) is Node:
                    stack.append((part, inside))
                elif inside:
                    stack.append(part)
    end_block()
    return "\n\n".join(blocks)


def extracted(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    schema = "page_id long, url string, text string, n_chars long"
    narrow = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))

    def extract(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h) for h in batch.pop("html")]
            yield batch.assign(text=texts, n_chars=[len(t) for t in texts])

    return narrow.mapInPandas(extract, schema)
