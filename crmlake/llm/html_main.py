"""Main text of web pages by scores in the tag tree.

Blocks of text pass points for their length and commas to the elements around them, less the higher
these are and the more of the block is links; an element's points are discounted by the share of links
in all its text. The element with most points is the container of the article. It is widened to the
<article> or <main> around it, and siblings with a good part of its points, headings and long unlinked text
beside it are kept as well. Menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments,
known by tag, role or by a word of their class or id, are left out before. Such a word does not condemn
an element around the page's largest article or main or, on a page without one outside such elements,
around most of its unlinked text; it only lowers that element's points. A form is weighed in the same way if
paragraphs are in it, and left out otherwise. When nothing is left, the page is scored again without the words.

Pages are parsed leniently: unclosed and stray tags are allowed, a block element ends an open
paragraph. References are decoded, white space inside a block becomes one space, blocks are joined by
an empty line.

Defined cases: a null or empty page, or one without text, gives an empty text; a page of any size is
read whole; equal scores go to the outer, then the earlier element; plain text without tags is one
block; repeated rows get equal rows; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    # a quote counts behind "=" only; elsewhere, as in an unquoted value, it is a character like others
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>=]++|=)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split())
DROPPED_TAGS = frozenset(
    "nav footer aside button select option input menu dialog template svg math object embed head "
    "script style textarea title noscript iframe canvas audio video map".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar "
                          "toolbar form".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos "
    "promotion promoted banner sidebar sidebars side aside rail nav navbar navigation menu menus topbar toolbar "
    "breadcrumb breadcrumbs footer foot masthead cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations widget widgets pagination pager skip comment comments disqus discussion reply replies respond "
    "copyright disclaimer".split())
#: Words that do not condemn the elements that hold whole pages.
PAGE_TAGS = frozenset("html body main article".split())
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
BESIDE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos "
    "promotion promoted".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SAME = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_SCOPE = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select"}


#: The share of a page's unlinked text that saves an element with a word of DROPPED_WORDS or with "header";
#: one with a word of comments or adverts, which can outgrow the text; and what an article needs to save those around it.
MOST, MOST_BESIDE, LEAST_ARTICLE = 0.5, 0.8, 0.25
#: What a saved element keeps of its points.
SAVED = 0.75


class Node:
    __slots__ = ("tag", "parent", "drop", "header", "points", "size", "linked", "order", "depth", "word", "titled", "factor")

    def __init__(self, tag: str, parent: "Node | None", drop: bool, header: bool, order: int):
        self.tag, self.parent, self.drop, self.header, self.order = tag, parent, drop, header, order
        self.points = self.size = self.linked = 0.0
        self.word, self.titled, self.factor = 0.0, False, 1.0
        self.depth = parent.depth + 1 if parent else 0


class Block:
    __slots__ = ("node", "parts", "linked")

    def __init__(self, node: Node):
        self.node, self.parts, self.linked = node, [], 0


def _judge(tag: str, attributes: str) -> tuple[bool, bool, float, bool]:
    """(left out, a header) from tag and attributes, and from words of class or id (the share of text that
    saves it, 0 without such a word; called a header)."""
    drop, header, word, titled = tag in DROPPED_TAGS, tag == "header", 0.0, False
    if not attributes or drop:
        return drop, header, word, titled
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            words = {w.lower() for w in _WORD.findall(value)}
            if tag not in PAGE_TAGS and not words.isdisjoint(DROPPED_WORDS):
                word = max(word, MOST)
            beside = COMMENT_WORDS if tag == "article" else frozenset() if tag in PAGE_TAGS else BESIDE_WORDS
            if not words.isdisjoint(beside):
                word = MOST_BESIDE
            titled |= tag not in PAGE_TAGS and "header" in words
        elif name == "role":
            drop |= value.lower() in DROPPED_ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            drop = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            drop = True
    return drop, header, word, titled


def _settle(nodes: list[Node], found: list[Block]) -> None:
    """Words of class and id are weighed against the text; what they leave out is taken from nodes and blocks."""
    text = [0] * len(nodes)
    for b in found:
        for node, piece, link in b.parts:
            text[node.order] += 0 if link else len(piece.strip())
    prose = [n.tag in ("p", "article", "main") for n in nodes]
    for node in reversed(nodes[1:]):
        text[node.parent.order] += text[node.order]
        prose[node.parent.order] |= prose[node.order]
    saved, free, within = set(), False, [False] * len(nodes)
    for node in nodes[1:]:
        within[node.order] = within[node.parent.order] or node.word > 0 or node.titled
    for tag in ("article", "main"):
        best = max((n for n in nodes if n.tag == tag and not n.drop and not n.word), key=lambda n: (text[n.order], -n.order), default=None)
        if best is not None and text[best.order] >= LEAST_ARTICLE * text[0] > 0:
            saved.update(x.order for x in _up(best))
        free |= any(n.tag == tag and not n.drop and text[n.order] > 0 and not within[n.order] for n in nodes)
    for node in nodes[1:]:  # what is around an element comes before it
        least = max(node.word, MOST if node.titled else 0.0)
        keep = node.order in saved or not (free or saved) and text[node.order] > least * text[0]
        if node.tag == "form":  # one without a paragraph is a form, however little else there is
            keep &= prose[node.order]
        if least and keep:
            node.factor = SAVED
        node.drop |= node.parent.drop or node.word > 0 and not keep
        node.header |= node.parent.header or node.titled and not keep
    for b in found:
        parts = [x for x in b.parts if not x[0].drop]
        b.parts = [piece for _, piece, _ in parts]
        b.linked = sum(len(piece.strip()) for _, piece, link in parts if link)


def blocks(page: str, by_words: bool = True) -> list[Block]:
    """The blocks of text of a page in order; those in parts that are left out are not among them."""
    root = Node("html", None, False, False, 0)
    stack, links, nodes = [root], 0, [root]
    opened: dict[str, int] = defaultdict(int)  # elements on the stack by name, so that no search is in vain
    out: list[Block] = []
    current: Block | None = None

    def text(piece: str) -> None:
        nonlocal current
        if stack[-1].drop or not piece:
            return
        if current is None:
            if not piece.strip():
                return
            owner = stack[-1]
            while owner.tag in INLINE and owner.parent is not None:
                owner = owner.parent
            current = Block(owner)
            out.append(current)
        current.parts.append((stack[-1], piece, links > 0))

    def pop_to(k: int) -> None:
        nonlocal links
        for node in stack[k:]:
            links -= node.tag == "a"
            opened[node.tag] -= 1
        del stack[k:]

    at, n = 0, len(page)
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue  # inside raw content
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # an end tag closes the nearest open element of its name
            for k in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[k].tag == tag:
                    if any(x.tag not in INLINE for x in stack[k:]):
                        current = None
                    pop_to(k)
                    break
            continue
        if tag == "br":
            text(" ")
            continue
        if tag not in INLINE:
            current = None
            scope = _SCOPE.get(tag, "").split()
            ends = _SAME.get(tag, "").split() + ["p"]
            for k in range(len(stack) - 1 if any(opened[t] for t in ends) else 0, 0, -1):
                if stack[k].tag in scope:
                    break
                if stack[k].tag in ends:
                    pop_to(k)
                    if not scope:
                        break
                elif not scope and stack[k].tag not in INLINE:
                    break
        if tag in VOID:
            continue
        if tag in RAW:  # skipped whole; what closes it is looked for from here
            end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        drop, header, word, titled = _judge(tag, m[3])
        if tag == "form":  # a form around the page is weighed like one that a word condemns
            word, drop = max(word, MOST), drop or not by_words
        parent = stack[-1]
        if m[3].endswith("/") and tag in ("svg", "path", "use"):
            continue
        node = Node(tag, parent, drop or parent.drop, header or parent.header, len(nodes))
        if by_words:
            node.word, node.titled = word, titled
        nodes.append(node)
        stack.append(node)
        opened[tag] += 1
        links += tag == "a"
    text(page[at:])
    _settle(nodes, out)
    return [b for b in out if b.parts]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return _main_text(page, True) or _main_text(page, False)


def _main_text(page: str, by_words: bool) -> str:
    found = []
    for b in blocks(page, by_words):
        words = " ".join(html.unescape("".join(b.parts)).split())
        if words:
            found.append((b, words))
    # a header outside the article is left out; in it, only its headings stay
    found = [(b, t) for b, t in found if not b.node.header or b.node.tag in HEADINGS and _inside(b.node, ("article", "main"))]
    if not found:
        return ""
    nodes: dict[int, Node] = {}
    for b, t in found:
        density = min(1.0, b.linked / len(t))
        points = 0.0
        if b.node.tag not in HEADINGS:
            commas = sum(t.count(c) for c in ",،、，")
            points = (1 + commas + len(t) / 100) * (1 - density)
        # a block element of its own passes to what is around it; text set directly in a container stays there
        node = b.node.parent if b.node.tag in ("p", "pre", "blockquote", "li", "td", "dd", "dt", *HEADINGS) and b.node.parent else b.node
        node.size += len(t)
        node.linked += b.linked
        share, level, above = 1.0, 0, node
        while above is not None and level < 5:
            above.points += points * share
            level += 1
            share = 0.5 if level == 1 else 1 / (2 * level)
            above = above.parent
        while node is not None and node.order not in nodes:
            nodes[node.order] = node
            node = node.parent
    for node in sorted(nodes.values(), key=lambda x: -x.order):  # what is inside an element comes after it
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.linked += node.linked
    value = lambda x: x.factor * x.points * (1 - min(1.0, x.linked / max(1.0, x.size)))
    best = max(nodes.values(), key=lambda x: (round(value(x), 9), -x.depth, -x.order))
    if value(best) <= 0:
        best = min(nodes.values(), key=lambda x: x.depth)
    outer, wide = best, best
    while outer is not None:
        if outer.tag in ("article", "main"):
            wide = outer
            if outer.tag == "article":
                break
        outer = outer.parent
    least = max(10.0, 0.2 * value(best))
    kept = {wide.order}
    if wide.parent is not None and wide.tag not in ("article", "main", "body", "html"):
        for x in nodes.values():
            if x.parent is wide.parent and value(x) >= least:
                kept.add(x.order)
    within: dict[int, bool] = {}
    for node in sorted(nodes.values(), key=lambda x: x.order):
        within[node.order] = node.order in kept or node.parent is not None and within[node.parent.order]
    out = []
    for b, t in found:
        inside = b.node.order in kept or within[b.node.order if b.node.order in within else b.node.parent.order]
        if not inside and wide.tag not in ("article", "main", "html", "body") and b.node.parent is wide.parent:
            inside = b.node.tag in HEADINGS or len(t) > 80 and b.linked < 0.25 * len(t)
        if inside and not _is_menu(b, nodes):
            out.append(t)
    return "\n\n".join(out)


def _up(node: Node | None):
    while node is not None:
        yield node
        node = node.parent


def _inside(node: Node, tags: tuple[str, ...]) -> bool:
    return any(x.tag in tags for x in _up(node))


def _is_menu(b: Block, nodes: dict[int, Node]) -> bool:
    """A list that is nearly all links."""
    holder = b.node.parent if b.node.tag == "li" else None
    return holder is not None and holder.order in nodes and holder.linked >= 0.8 * holder.size > 0


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page. Pages are independent: no shuffle."""
    rows = pages.select(F.col(f"`{id_column}`").cast("long").alias("page_id"),
                        F.col(f"`{url_column}`").cast("string").alias("url"),
                        F.col(f"`{html_column}`").cast("string").alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
