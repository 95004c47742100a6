"""HTML main-text extraction (operator 7) by tree scoring.

A page is read into a small tree. Paragraphs with text get points for their length and commas, discounted by the share
of their text that stands in links, and pass them to their ancestors: all to the parent, half to the grandparent, less
further up. The best container wins; if it stands in an article or main element, that element is taken. Its siblings
are kept when they score well or are plain paragraphs or headings. From what is kept, menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments are left out, and the rest is cut into blocks. A class, an id, a
role or a form is loose evidence: such an element stays when the article or most of the page's points stand in it.
Reading takes time in proportion to the page, however its tags are nested or broken.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names as HTML defines them, and words in class, id and role that mark what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
JUNK_TAGS = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input iframe object embed svg canvas annotation annotation-xml menu dialog audio video map title".split()
)
JUNK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside rail widget footer header masthead topbar toolbar " "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login share sharing social follow related recommended recommendations trending outbrain taboola comment comments respond replies disqus pagination pager skip".split()
)
#: Words that mark junk only alone, or beside words that all speak of the page's layout: "social-links", not "social-science".
WEAK_WORDS = frozenset("ad aside alert banner follow followed header login masthead notice notices overlay promotion rail related response responses share sharing skip social subscription trending widget".split())
LAYOUT_WORDS = frozenset(
    "area bar block blocks bottom box btn button buttons col column container content footer form group head holder icon icons inner item items left link links list main middle mobile outer page panel region right row section side site slot text top unit us wrap wrapper zone".split()
)
JUNK_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar toolbar note".split()
)
#: Elements whose start ends an open element of the second list.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"),
}
#: Only these, and what stands in them, can close themselves.
FOREIGN = ("svg", "math")
BARRIER = frozenset("table ul ol dl td th div section article main body html blockquote".split())
SCORED = frozenset("p pre blockquote td li dd h2 h3 h4 h5 h6 div section article".split())
HEADINGS = frozenset("h1 h2 h3".split())

#: A comment, a declaration, or the beginning of a tag; a tag with its quoted values whole.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)", re.S)
_ATTRS = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)")
#: One attribute, its value with it, so that nothing within a name or a value is taken for another attribute.
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Words of a name: "article-header", "shareLinks".
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: What readers write, in one word or several: "commentlist", "comments-area", "user_comments"; not a commentary.
_COMMENTS = re.compile(r"comments?(?!ar)|disqus", re.I)
#: A class that tells what a page has or lacks beside the element: "has-sidebar", "no-sidebar", "with-banner".
_BESIDE = re.compile(r"(?:has|no|with|without)[-_]")
#: Kinds of junk. SOFT: a form, or a class of what stands beside. NAMED: a junk word within a longer class or id. EXACT:
#: the class, id or role itself. HARD: by the element's name, or hidden.
SOFT, NAMED, EXACT, HARD = 1, 2, 3, 4
_RIGHTS = re.compile(r"(?:\u00a9|\(c\)|copyright|all rights reserved)", re.I)
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "mark", "junk", "points")

    def __init__(self, tag: str, parent: Node | None, mark: int = 0):
        self.tag, self.parent, self.children, self.mark, self.points = tag, parent, [], mark, 0.0
        self.junk = 0 if tag in ("html", "body", "article", "main") else mark


@lru_cache(1 << 14)
def _name_kind(token: str) -> int:
    """The kind of junk that one name of a class or id speaks of, or 0."""
    low = token.lower()
    if low in JUNK_WORDS:
        return EXACT
    words = [w.lower() for w in _WORDS.findall(token)]
    cut = []
    for w in words:
        # "sidebarwrap", "adslot": a word of junk and one of layout, written as one.
        halves = [(w[:i], w[i:]) for i in range(2, len(w) - 1) if w not in JUNK_WORDS]
        both = next((h for h in halves if h[0] in JUNK_WORDS and h[1] in LAYOUT_WORDS or h[1] in JUNK_WORDS and h[0] in LAYOUT_WORDS), (w,))
        cut += both
    junk = JUNK_WORDS.intersection(cut)
    if _COMMENTS.search(token):
        junk |= {"comments"}
    if not junk or junk <= WEAK_WORDS and not all(w in JUNK_WORDS or w in LAYOUT_WORDS or len(w) == 1 for w in cut):
        return 0
    return SOFT if _BESIDE.match(low) else NAMED


def _mark(tag: str, attrs: str) -> int:
    """The kind of junk that an element looks like by its name and attributes, or 0."""
    if tag in JUNK_TAGS and tag != "form":
        return HARD
    found = SOFT if tag == "form" else 0
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NONE.search(value):
            return HARD
        if name == "role" and value.lower() in JUNK_ROLES:
            found = max(found, SOFT if value.lower() == "form" else EXACT)
        elif name in ("class", "id"):
            found = max([found, *map(_name_kind, value.split())])
    return found


class Open:
    """The open elements, with the places of each name and of those that hold others apart."""

    def __init__(self, root: Node):
        self.nodes, self.at, self.barriers = [root], {}, []

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BARRIER:
            self.barriers.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        """End the elements from the place `at` on."""
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.at[node.tag].pop()
            if node.tag in BARRIER:
                self.barriers.pop()

    def last(self, tag: str) -> int:
        """The innermost place of a name, or 0."""
        places = self.at.get(tag)
        return places[-1] if places else 0

    def barrier(self) -> int:
        return self.barriers[-1] if self.barriers else 0

    def close(self, tags: tuple) -> None:
        """End the open elements of these names, up to the nearest element that holds them apart."""
        while (at := max(map(self.last, tags))) and at >= self.barrier():
            self.cut(at)
            if len(tags) == 1:
                return


def parse(page: str) -> Node:
    """The page as a tree; children are nodes and decoded strings. Comments and raw elements are left out. After a quote
    that nothing closes tags end at their next ">"."""
    root = Node("#root", None)
    open_, at, n, quotes = Open(root), 0, len(page), True
    while at < n:
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else n]
        if text:
            open_.nodes[-1].children.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        closing, tag = m[1], m[2]
        if not tag:
            continue
        tag, rest = tag.lower(), _ATTRS.match(page, at) if quotes else None
        if rest:
            attrs, at = rest[1], rest.end()
        else:
            quotes, end = False, page.find(">", at)
            attrs, at = page[at : n if end < 0 else end], n if end < 0 else end + 1
        if closing:
            place = open_.last(tag)
            if place and (tag in BLOCK or place >= open_.barrier()):
                open_.cut(place)
            continue
        if tag in BLOCK:
            open_.close(("p",))
        if tag in CLOSES:
            open_.close(CLOSES[tag])
        node = Node(tag, open_.nodes[-1], _mark(tag, attrs))
        open_.nodes[-1].children.append(node)
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not (attrs.endswith("/") and any(map(open_.last, FOREIGN)) or tag in FOREIGN and attrs.endswith("/")):
            open_.push(node)
    return root


@lru_cache(16)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I)


def _seen(root: Node, least: int = SOFT) -> list[Node]:
    """Elements in page order, without those that are junk of the kind `least` or a surer one, and all below them."""
    seen: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node.junk < least:
            seen.append(node)
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return seen


def _paragraph(node: Node) -> float | None:
    """The points of a node's own text, or None where it is no paragraph."""
    if node.tag not in SCORED:
        return None
    own, linked = _own_text(node)
    size = len(own)
    return None if size < 25 else (
        1 + own.count(",") + own.count("،") + own.count("、") + min(size / 100, 3)
    ) * (1 - linked / size)


def _spare(root: Node) -> None:
    """Clear elements that are junk by loose evidence only: those around the article or main elements that stand in the
    fewest of them, SOFT ones that hold most of the page's points, and NAMED ones that hold all of them."""
    seen = _seen(root, HARD)
    loose = [x for x in seen if x.junk]
    if not loose:
        return
    held, depth, anchors = {}, {}, []
    for x in seen:
        depth[id(x)] = (depth[id(x.parent)] if x.parent else 0) + (x.junk > 0)
        if x.tag in ("article", "main") and not x.mark:
            anchors.append(x)
    for x in reversed(seen):
        held[id(x)] = held.get(id(x), 0.0) + (_paragraph(x) or 0.0)
        if x.parent:
            held[id(x.parent)] = held.get(id(x.parent), 0.0) + held[id(x)]
    total, least = held[id(root)], min((depth[id(x)] for x in anchors), default=0)
    around: set[int] = set()
    for up in (x for x in anchors if depth[id(x)] == least):
        while up is not None and id(up) not in around:
            around.add(id(up))
            up = up.parent
    for x in loose:
        if id(x) in around or total and held[id(x)] > {SOFT: 0.5, NAMED: 0.999}.get(x.junk, 1.1) * total:
            x.junk = 0


def _score(root: Node) -> Node | None:
    """Give points; the best container, or None where no paragraph has text."""
    best: Node | None = None
    scored: dict[int, Node] = {}
    for node in _seen(root):
        points = _paragraph(node)
        if points is None:
            continue
        up, depth = node.parent if node.tag not in ("div", "section", "article") else node, 0
        while up is not None and depth < 6:
            up.points += points if depth == 0 else points / 2 if depth == 1 else points / (3 * depth)
            scored[id(up)] = up
            up, depth = up.parent, depth + 1
    for node in scored.values():
        if node.tag not in ("#root", "html") and (best is None or node.points > best.points):
            best = node
    return best


def _own_text(node: Node) -> tuple[str, int]:
    """Text of a node outside of blocks within it, and how many characters of it stand in links."""
    out: list[str] = []
    linked = 0
    stack = [(c, node.tag == "a") for c in reversed(node.children)]
    while stack:
        c, link = stack.pop()
        if isinstance(c, str):
            c = " ".join(c.split())
            out.append(c)
            linked += len(c) * link
        elif not c.junk and c.tag not in BLOCK:
            stack += [(x, link or c.tag == "a") for x in reversed(c.children)]
    text = " ".join(x for x in out if x)
    return text, min(linked, len(text))


def _blocks(node: Node, out: list[str]) -> None:
    """Append the blocks of text of a node, in page order; junk is left out."""
    held: list[str] = []

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                out.append(text)

    stack: list = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            held.append(x)
        elif x is None:
            flush()
        elif not x.junk or x is node:
            if x.tag in ("br", "wbr"):
                held.append(" " if x.tag == "br" else "")
                continue
            block = x.tag in BLOCK or x.tag == "#root"
            if block:
                flush()
                stack.append(None)
            stack += reversed(x.children)
    flush()


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks joined by line feeds; empty for a null, empty or textless page."""
    if not page:
        return ""
    root = parse(page)
    _spare(root)
    best = _score(root)
    out: list[str] = []
    if best is None:
        _blocks(root, out)
        return "\n".join(out)
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    best = up or best
    if best.tag == "body" or best.parent is None:
        _blocks(best, out)
        return "\n".join(out)
    floor = max(10.0, 0.2 * best.points)
    before = True
    held: list[str] = []

    def bare() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    for x in best.parent.children:
        if x is best:
            bare()
            _blocks(x, out)
            before = False
        elif isinstance(x, str) or x.tag not in BLOCK and not x.junk:
            if isinstance(x, Node) and x.tag == "br":
                held.append(" ")
            else:
                held.append(x if isinstance(x, str) else _inline(x))
        elif not x.junk:
            bare()
            if x.points >= floor or _plain(x) or before and x.tag in HEADINGS and best.tag not in ("article", "main"):
                _blocks(x, out)
    bare()
    return "\n".join(out)


def _inline(node: Node) -> str:
    """The text of an inline element that stands among blocks; none where it is a link, or holds little else."""
    text, linked = _own_text(node)
    return text if linked < 0.25 * len(text) else ""


def _plain(node: Node) -> bool:
    """Whether a block beside the best container reads like text: it has some, few links, and is no line of rights."""
    size = linked = 0
    head = ""
    stack: list = [(node, node.tag == "a")]
    while stack:
        x, link = stack.pop()
        if isinstance(x, str):
            text = " ".join(x.split())
            head = head or text
            size += len(text)
            linked += len(text) * link
        elif not x.junk or x is node:
            stack += [(c, link or x.tag == "a") for c in reversed(x.children)]
    return size > 0 and linked < 0.25 * size and not _RIGHTS.match(head)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 1000):
            piece = batch.slice(at, 1000)
            texts = [main_text(x) for x in piece.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("page_id"),
                    piece.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of `pages` (page_id, url, html; other columns are left out). Null html gives
    an empty text; rows that repeat an id or have none are each extracted; very long pages are read whole; an empty table
    gives an empty result."""
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint"
    )


def op7_html_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
