"""HTML extraction by composite text density.

Every DOM node gets its characters per tag, adjusted for link characters; inline tags are not counted,
so marked words do not thin a paragraph.  The densities of a node's children are summed.  The threshold is
the smallest density on the path from the body to the densest node; every node at or above it marks the node
of maximum sum below it.  A marked node grows to the article (or main) element around it, or where there is
none, up through parents as long as these add less link text than plain text, so headings and short paragraphs
beside it stay.  All parts are put out in page order.  Parts that are never main text (navigation, headers and
footers of the page, forms, comments of readers, notices, adverts, hidden parts) are left out first, by
element name and by the names in class, id and role; names that main parts have too (``related``, ``side``
and the like) count only for parts that hold less than half of the page's text.

Defined cases: null and empty pages give an empty text; a page without markup is its text; broken
nesting is closed as browsers do for paragraphs, list items and cells; end tags without a start are ignored;
marked sections are comments up to the next ``>``; time grows with the length of a page, however deep its
nesting; repeated rows are extracted each; an empty table gives an empty result; a column of texts is made, so
other columns are the caller's.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style noscript template iframe object svg canvas head title nav aside footer form button select textarea dialog menu".split())
BLOCK = frozenset("address article blockquote body caption dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul br".split()) - {"br"}
INLINE = frozenset("abbr b bdi bdo big br cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}}
STOPS = frozenset("table ul ol dl article section div body html main aside nav header footer".split())
def _named(names: str) -> re.Pattern:
    return re.compile(rf"(?:^|[\s_-])(?:{'|'.join(names.split())})(?:$|[\s_-])")


#: Names that mark parts beside the main text, and names that small parts beside it have.
ASIDE = _named("ad ads advert advertisement breadcrumbs? comments? cookies? consent footer masthead nav navbar navigation newsletter pagination popup sidebar sponsored subscribe disqus replies contentinfo complementary")
SMALL = _named("banner header menu notice promo related search share sharing side social toolbar widget")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "kids", "skip", "small", "depth", "open", "chars", "tags", "links", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, skip: bool, small: bool = False):
        self.tag, self.parent, self.kids, self.skip, self.small = tag, parent, [], skip, small
        self.depth = parent.depth + 1 if parent else 0
        #: Outermost open element of each kind that others close, up to the next boundary.
        self.open = {} if parent is None or tag in STOPS else parent.open
        if tag in CLOSES and tag not in self.open:
            self.open = {**self.open, tag: self}


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None, False)
        self.opened = Counter()

    def parse_html_declaration(self, i):
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def _leave(self, node: Node) -> None:
        """``node`` and all inside it are closed."""
        while self.at is not node:
            self.opened[self.at.tag] -= 1
            self.at = self.at.parent
        self.opened[node.tag] -= 1
        self.at = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in BLOCK or tag in CLOSES:
            found = [self.at.open[t] for t in CLOSES.get(tag, {"p"}) if t in self.at.open]
            if found:
                self._leave(min(found, key=lambda n: n.depth))
        named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()
        hidden = any(k == "hidden" or (k == "style" and "display:none" in (v or "").replace(" ", "").lower()) for k, v in attrs)
        page_header = tag == "header" and not self.opened["article"]
        main = tag in ("article", "main")
        node = Node(tag, self.at, self.at.skip or hidden or page_header or tag in SKIP or (not main and bool(ASIDE.search(named))), not main and bool(SMALL.search(named)))
        self.at.kids.append(node)
        if tag not in VOID:
            self.opened[tag] += 1
            self.at = node

    def handle_endtag(self, tag):
        if self.opened[tag] > 0:
            n = self.at
            while n.tag != tag:
                n = n.parent
            self._leave(n)

    def handle_data(self, data):
        self.at.kids.append(data)


def _without_small(root: Node) -> None:
    """Leaves out parts named as small ones that hold less than half of the text."""
    nodes, held = _ordered(root), {}
    for n in reversed(nodes):
        held[n] = sum(len(k.strip()) if isinstance(k, str) else held.get(k, 0) for k in n.kids)
    for n in nodes:
        n.skip = n.skip or (n.small and 2 * held[n] < held[root])


def _ordered(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(k for k in reversed(n.kids) if isinstance(k, Node) and not k.skip)
    return out


def _measure(nodes: list[Node]) -> None:
    for n in reversed(nodes):
        kids = [k for k in n.kids if isinstance(k, Node) and not k.skip]
        n.chars = sum(len(SPACE.sub(" ", k).strip()) for k in n.kids if isinstance(k, str)) + sum(k.chars for k in kids)
        n.tags = sum((k.tag not in INLINE) + k.tags for k in kids)
        n.links = n.chars if n.tag == "a" else sum(k.links for k in kids)
        n.link_tags = n.tags + 1 if n.tag == "a" else sum(k.link_tags for k in kids)
    body = nodes[0]
    share = body.links / max(1, body.chars)
    for n in reversed(nodes):
        plain, links, tags, link_tags = max(1, n.chars - n.links), n.links or 1, n.tags or 1, n.link_tags or 1
        base = math.log(n.chars / plain * links + share * n.chars + math.e)
        n.density = n.chars / tags * math.log(max(1.0, n.chars / links * tags / link_tags) + 1e-9, max(base, 1.0001)) if n.chars else 0.0
        n.total = sum(k.total if k.tag in INLINE else k.density for k in n.kids if isinstance(k, Node) and not k.skip)


def _grown(nodes: list[Node]) -> dict[Node, Node]:
    """The main part around each node, parents first."""
    article, main, grown = {}, {}, {}
    for n in nodes:
        article[n] = article.get(n.parent) or (n if n.tag == "article" else None)
        main[n] = main.get(n.parent) or (n if n.tag == "main" else None)
        plain = n.parent is not None and (n.tag not in BLOCK or 2 * (n.parent.links - n.links) <= n.parent.chars - n.chars)
        grown[n] = grown[n.parent] if plain else n
    return {n: article[n] or main[n] or grown[n] for n in nodes}


def _main(nodes: list[Node]) -> list[Node]:
    """The main parts in page order, none inside another."""
    n = max(nodes, key=lambda x: x.density)
    threshold = n.density
    while n is not None:
        threshold, n = min(threshold, n.density), n.parent
    best, marked, around = {}, {}, _grown(nodes)
    for n in reversed(nodes):
        top = n
        for k in n.kids:
            if isinstance(k, Node) and not k.skip and best[k].total > top.total:
                top = best[k]
        best[n] = top
        if n.chars and n.density >= threshold:
            marked[top] = None
    parts, inside, out = {around[n] for n in marked}, set(), []
    for n in nodes:
        if n.parent in inside:
            inside.add(n)
        elif n in parts:
            inside.add(n)
            out.append(n)
    return out


def blocks(root: Node) -> list[str]:
    out, now = [], []

    def flush():
        text = SPACE.sub(" ", "".join(now)).strip()
        now.clear()
        if text:
            out.append(text)

    todo = [(root, False)]
    while todo:
        n, leaving = todo.pop()
        if isinstance(n, str):
            now.append(n)
        elif leaving:
            flush()
        elif not n.skip:
            if n.tag == "br":
                now.append(" ")
            if n.tag in BLOCK:
                flush()
                todo.append((n, True))
            todo.extend((k, False) for k in reversed(n.kids))
    flush()
    return out


def extract(html: str | None) -> str:
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    _without_small(tree.root)
    nodes = _ordered(tree.root)
    _measure(nodes)
    return "\n\n".join(b for part in _main(nodes) for b in blocks(part))


def main_text(html: Column) -> Column:
    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([extract(h.as_py()) for h in batch], pa.string())

    return texts(html)
