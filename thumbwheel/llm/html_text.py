"""Main text of web pages by composite text density.

A page becomes a tree of its block elements; inline markup belongs to the block
around it. Every node gets its characters per tag, lowered where much of the
text is links, and the node whose children's densities add up to most is the
centre of the article. The lowest density on the way from there to the body is
the threshold that other subtrees must reach to count as content; ``article``
and ``main`` elements are held back where they fall below it.
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

from thumbwheel.llm.words import map_batches

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "thead": ("tr", "td", "th", "thead", "tbody"), "tbody": ("tr", "td", "th", "thead", "tbody"),
}
SCOPES = frozenset("ul ol dl table body html article section div td th".split())
BOILERPLATE_TAGS = frozenset(
    "head nav footer aside form noscript template svg button select dialog menu object canvas".split()
)
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "aside menu menubar nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus "
    "reply replies cookie cookies consent gdpr notice notices newsletter subscribe subscription signup "
    "login share sharing social related recommended popup modal overlay widget toolbar pagination "
    "pager copyright masthead topbar complementary contentinfo search".split()
)
HEADER_NAMES = frozenset("header".split())
ARTICLE_TAGS = frozenset(("article", "main"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?P<key>class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s>]+)))?", re.I)
NAME_PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """Block elements in page order with their text; node 0 is the document."""

    def __init__(self) -> None:
        self.tag = ["#document"]
        self.parent = [0]
        self.last = [0]
        self.named = [False]  # boilerplate by its class, id or role only
        self.dropped = [False]  # boilerplate by its tag, or hidden
        self.pieces: list[tuple[int, str | None, bool]] = []  # node, text or a break, inside a link
        self.links: list[int] = []

    def add(self, tag: str, parent: int, named: bool, dropped: bool) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.last.append(0)
        self.named.append(named)
        self.dropped.append(dropped)
        return len(self.tag) - 1


def _marks(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is boilerplate by its names, and by its tag or because it is hidden."""
    dropped = tag in BOILERPLATE_TAGS or (tag == "header" and not in_article)
    named = False
    if attrs and tag not in ("html", "body"):
        for m in ATTRIBUTE.finditer(attrs):
            key, given = m["key"].lower(), m["a"] or m["b"] or m["c"] or ""
            if key in ("class", "id", "role"):
                parts = set(NAME_PARTS.findall(CAMEL.sub(" ", given).lower()))
                named |= bool(parts & BOILERPLATE_NAMES) or (not in_article and bool(parts & HEADER_NAMES))
            elif key == "hidden" and not given:
                dropped = True
            elif key == "aria-hidden":
                dropped |= given.lower() == "true"
            elif key == "style":
                dropped |= "display:none" in given.replace(" ", "").lower()
    return named, dropped


def parse(source: str) -> Page:
    """A forgiving parse: missing end tags, stray end tags and cut-off pages are all fine."""
    page = Page()
    stack: list[tuple[str, int]] = [("#document", 0)]  # open elements with their block
    # How often each element is open: what is not open is not looked for, however deep the stack.
    opened: Counter[str] = Counter()
    links = 0
    at = 0

    def text(until: int) -> None:
        if until > at:
            piece = source[at:until]
            page.pieces.append((stack[-1][1], html.unescape(piece) if "&" in piece else piece, links > 0))

    def close(k: int) -> None:
        """Close the elements from position k of the stack on."""
        nonlocal links
        for tag, block in reversed(stack[k:]):
            opened[tag] -= 1
            if tag == "a":
                links = max(0, links - 1)
            elif tag not in INLINE:
                page.last[block] = len(page.tag) - 1
                page.pieces.append((page.parent[block], None, False))
        del stack[k:]

    while m := TOKEN.search(source, at):
        text(m.start())
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if not opened[name]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
                if name not in INLINE and name in ("p", "li") and stack[k][0] in SCOPES:
                    break
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        block = stack[-1][1]
        if name in RAW:
            ending = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = ending.end() if ending else len(source)
            continue
        if name in INLINE:
            if name == "a":
                links += 1
                page.links.append(block)
            if name not in VOID and not attrs.endswith("/"):
                stack.append((name, block))
                opened[name] += 1
            continue
        if name in VOID:
            page.pieces.append((block, None, False))
            continue
        ended = ("p", *CLOSES_ITSELF.get(name, ()))
        if any(opened[t] for t in ended):
            for k in range(len(stack) - 1, 0, -1):
                tag = stack[k][0]
                if tag in ended:
                    close(k)
                    break
                if tag in SCOPES:
                    break
        parent = stack[-1][1]
        in_article = any(opened[t] for t in ARTICLE_TAGS)
        node = page.add(name, parent, *_marks(name, attrs, in_article))
        page.pieces.append((parent, None, False))
        stack.append((name, node))
        opened[name] += 1
    text(len(source))
    close(0)
    page.last[0] = len(page.tag) - 1
    return page


def _boilerplate(page: Page) -> list[bool]:
    """Nodes that are boilerplate or lie inside some; a name never drops the article itself."""
    n = len(page.tag)
    # Beside an article without such a name, one called comment or teaser is what its name says.
    articles = [v for v in range(n) if page.tag[v] in ARTICLE_TAGS]
    plain = any(not page.named[v] for v in articles)
    holds = [t == "h1" or (t in ARTICLE_TAGS and not (plain and name)) for t, name in zip(page.tag, page.named)]
    for v in range(n - 1, 0, -1):
        if holds[v]:
            holds[page.parent[v]] = True
    out = [False] * n
    for v in range(1, n):
        own = page.dropped[v] or (page.named[v] and not holds[v])
        out[v] = own or out[page.parent[v]]
    return out


def densities(page: Page, out: list[bool]) -> tuple[list[float], list[float]]:
    """Composite text density of every node, and the sum over its children."""
    n = len(page.tag)
    chars, link_chars, tags, link_tags = ([0] * n for _ in range(4))
    for node, piece, linked in page.pieces:
        if piece and not out[node]:
            size = len(piece) - piece.count(" ") - piece.count("\n") - piece.count("\t")
            chars[node] += size
            link_chars[node] += size * linked
    for node in page.links:
        link_tags[node] += not out[node]
    for v in range(n - 1, 0, -1):
        p = page.parent[v]
        if not out[v]:
            chars[p] += chars[v]
            link_chars[p] += link_chars[v]
            tags[p] += tags[v] + 1
            link_tags[p] += link_tags[v]
    share = link_chars[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for v in range(n - 1, -1, -1):
        if out[v] or not chars[v]:
            continue
        c, lc = chars[v], max(link_chars[v], 1)
        t, lt = max(tags[v] + link_tags[v], 1), max(link_tags[v], 1)
        base = math.log(c / max(c - link_chars[v], 1) * link_chars[v] + share * c + math.e)
        ratio = max(c / lc * t / lt, 1.0)
        density[v] = c / t * (math.log(ratio) / math.log(base) if base > 1 else math.log(ratio))
        if v:
            total[page.parent[v]] += density[v]
    return density, total


def _content_roots(page: Page, out: list[bool]) -> list[int]:
    """Roots of the subtrees that make up the main text, in page order and disjoint.

    The threshold of the path chooses among all subtrees. Outermost ``article`` and
    ``main`` elements with text are held back whole, also those below it; no other element
    is chosen for its tag.
    """
    density, total = densities(page, out)
    n = len(page.tag)
    best = max(range(n), key=lambda v: (total[v], -v))
    path = [best]
    while path[-1]:
        path.append(page.parent[path[-1]])
    limit = min((density[v] for v in path if page.tag[v] not in ("#document", "html")), default=0.0)
    centre = list(range(n))  # of each subtree, the node with the largest sum
    for v in range(n - 1, 0, -1):
        p = page.parent[v]
        if total[centre[v]] > total[centre[p]]:
            centre[p] = centre[v]
    on_path = set(path)
    holds = [t in ARTICLE_TAGS for t in page.tag]
    for v in range(n - 1, 0, -1):
        holds[page.parent[v]] |= holds[v]
    roots, v = [], 1
    while v < n:
        if page.tag[v] in ARTICLE_TAGS and not out[v] and density[v]:
            roots.append(v)
            v = page.last[v] + 1
            continue
        if out[v] or density[v] < limit or not density[v]:
            v = v + 1 if v in on_path or holds[v] else page.last[v] + 1
            continue
        if centre[v] == v and not holds[v]:
            roots.append(v)
            v = page.last[v] + 1
        else:
            v += 1
    return roots or [best]


def main_text(source: str | None) -> str:
    """The article of one page; empty for null or empty pages and for pages without text."""
    if not source:
        return ""
    page = parse(source)
    out = _boilerplate(page)
    roots = _content_roots(page, out)
    keep = [False] * len(page.tag)
    for r in roots:
        for v in range(r, page.last[r] + 1):
            keep[v] = not out[v]
    parts = [" " if piece is None else piece for node, piece, _ in page.pieces if piece is None or keep[node]]
    return " ".join("".join(parts).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``, from the whole html.

    Null html counts as empty and gives an empty text. Repeated rows are
    extracted alike; null ids and urls pass through; other columns are not read.
    """

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [main_text(s) for s in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    return map_batches(
        pages.select(F.col("page_id").cast("long"), "url", "html"), extract,
        "page_id long, url string, text string, n_chars long",
    )
