"""Main text of web pages by tree scoring.

The page is parsed to a tree (tolerant of missing and stray end tags). Elements that are never main text (scripts,
styles, forms, navigation, and elements whose class, id or role names a menu, header, footer, sidebar, notice, advert
or comment section) are cut. A name counts only as a whole: all parts of a class token must say so (``cookie-banner``,
``main-nav``), so ``has-sidebar`` or ``comments-open`` name nothing. Articles, headings and whatever holds an article are
not judged by their names, and inside an article ids, which are anchors there, are not. Then paragraphs give points to their ancestors: one for being there, one for each comma,
one for each 100 characters up to three; the parent gets all of them, the grandparent half, and further ancestors a
share that falls with their distance. A container's score is discounted by its link density. The best container is
kept, with those siblings that score well or are plain paragraphs. Outside articles, lists of links inside it are dropped.

The text of a page is its blocks in page order: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one space. A null, empty or unparsable page, or one without main text, has the
empty string. Pages are handled one by one and whole; a page costs time and memory linear in its length. Repeated rows
give repeated results, any column may be null, extra columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NAMES = "[a-zA-Z][^\\s/>]*"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|</(?P<end>" + _NAMES + r")[^>]*(?:>|$)"
    r"|<(?P<start>" + _NAMES + r")(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|$)"
    r"|(?P<text>[^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr keygen".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_SKIPPED = frozenset(("script style textarea title xmp iframe noembed noframes noscript head template svg math canvas object "
                      "audio video select button form fieldset nav aside footer dialog menu").split())
_BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
                    "tbody td tfoot th thead tr ul caption").split())
_FORMAT = frozenset("a abbr b big cite code em font i mark q s small span strike strong sub sup tt u label kbd var".split())
#: A start tag of the key ends open elements of the value, up to the nearest container.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
         "tfoot": {"thead", "tbody", "tr", "td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
_TABLE_SCOPE = {"table"}
_UNLIKELY = frozenset((
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox newsletter subscribe "
    "subscription signup login signin register comment comments commentlist disqus reply replies respond discussion "
    "sidebar sidenav sidepanel rail widget widgets related recommended recommendation recommendations share sharing "
    "social follow menu navbar navigation nav breadcrumb breadcrumbs footer masthead topbar toolbar pagination "
    "pager paging tagcloud skip hidden offscreen search searchbox disclaimer copyright outbrain taboola shoutbox").split())
_HEADS = frozenset("header heading".split())
_COMMENT = frozenset("comment comments reply replies body".split())
_STRONG = frozenset("comment comments sidebar related footer nav ad ads".split())
#: Words that say nothing by themselves, beside one that does.
_NEUTRAL = frozenset((
    "site page main top bottom left right area list box bar container wrapper wrap section block inner outer primary secondary "
    "global local item items group row panel module unit link links button buttons form icon icons title text tag tags field "
    "mobile desktop small large big fixed sticky bg js is c l u o the my content").split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
_GOOD = frozenset("article articlebody body content entry main page post text blog story hentry prose".split())
_BASE = {"article": 10.0, "main": 10.0, "section": 3.0, "div": 5.0, "pre": 3.0, "td": 3.0, "blockquote": 3.0, "ul": -3.0,
         "ol": -3.0, "dl": -3.0, "address": -3.0, "h1": -5.0, "h2": -5.0, "h3": -5.0, "h4": -5.0, "th": -5.0}
_COMMAS = re.compile("[,،、，]")


class Node:
    __slots__ = ("tag", "words", "attributes", "parent", "children", "cut", "score", "chars", "links", "n_links", "block",
                 "holds")

    def __init__(self, tag: str, attributes: dict | None, parent: "Node | None"):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list = []
        self.cut, self.score, self.chars, self.links, self.n_links = False, 0.0, 0, 0, 0
        self.block = False
        self.holds = False      # an article or main element, below


def parse(html: str) -> Node:
    """The tree of a page. Children are nodes and strings (decoded text)."""
    root = here = Node("#root", None, None)
    open_ = [root]
    count: dict[str, int] = {}      # open elements by tag: a stray end tag costs nothing

    def close_from(i: int) -> None:
        for x in open_[i:]:
            count[x.tag] -= 1
        del open_[i:]

    at, end_ = 0, len(html)
    match = _TOKEN.match
    while at < end_:
        m = match(html, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "text" or kind == "cdata":
            text = m.group(kind)
            here.children.append(unescape(text) if "&" in text else text)
        elif kind == "attributes" or kind == "start":
            tag = m.group("start").lower()
            given = m.group("attributes")
            attributes = None
            if given and "=" in given or given and "hidden" in given:
                attributes = {a.lower(): unescape(x or y or z) for a, x, y, z in _ATTRIBUTE.findall(given)}
            if tag in _BLOCK:
                for i in range(len(open_) - 1, 0, -1):      # a block ends an open paragraph
                    t = open_[i].tag
                    if t == "p":
                        close_from(i)
                        break
                    if t in _BLOCK:
                        break
            if tag in _ENDS:
                ends, scope = _ENDS[tag], _SCOPE.get(tag, _TABLE_SCOPE)
                cut = 0
                for i in range(len(open_) - 1, 0, -1):
                    t = open_[i].tag
                    if t in scope:
                        break
                    if t in ends:
                        cut = i
                        if t == tag:
                            break
                if cut:
                    close_from(cut)
            here = open_[-1]
            node = Node(tag, attributes, here)
            here.children.append(node)
            if tag in _RAW:
                close = re.compile("</" + re.escape(tag) + r"\s*(?:/?>|\s[^>]*>|$)", re.I).search(html, at)
                at = close.end() if close else end_
            elif tag not in _VOID and not (given or "").endswith("/"):
                open_.append(node)
                count[tag] = count.get(tag, 0) + 1
                if tag in ("article", "main"):
                    up = here
                    while up is not None and not up.holds:
                        up.holds, up = True, up.parent
                here = node
        elif kind == "end":
            tag = m.group("end").lower()
            for i in range(len(open_) - 1 if count.get(tag) else 0, 0, -1):
                t = open_[i].tag
                if t == tag:
                    close_from(i)
                    here = open_[-1]
                    break
                if tag in _FORMAT and t in _BLOCK:      # inline end tags do not close blocks
                    break
                if t in ("table", "body", "html") and tag not in ("body", "html"):
                    break
    return root


def _words(attributes: dict | None) -> set[str]:
    if not attributes:
        return set()
    named = " ".join(filter(None, (attributes.get("class"), attributes.get("id"))))
    return {w.lower() for w in _WORD.findall(named)} | {w for w in named.lower().split()}


def _inside(node: Node, tags: set[str]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def _cut(node: Node) -> bool:
    """Whether an element is never main text."""
    if node.tag in _SKIPPED:
        return True
    a = node.attributes
    if node.tag == "header" and not _inside(node.parent, {"article", "main"}):
        return True
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(
            r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style") or "", re.I):
        return True
    if (a.get("role") or "").lower() in _ROLES:
        return True
    if node.tag in ("html", "body", "main") or node.tag in _HEADINGS:
        return False
    if node.tag == "article":
        return bool(_naming(a, True, _COMMENT, _COMMENT) - {"body"})
    if node.holds:
        return False
    inside = _inside(node.parent, {"article"})
    words = _naming(a, inside, _UNLIKELY, _UNLIKELY | _NEUTRAL)
    if words:
        return not (_words(a) & _GOOD and not words & _STRONG)
    return (not inside and not _inside(node.parent, {"main"}) and not _words(a) & _GOOD
            and bool(_naming(a, False, _HEADS, _HEADS | _NEUTRAL)))


def _naming(attributes: dict, class_only: bool, some: frozenset, every: frozenset) -> set[str]:
    """Of the class tokens and the id whose parts are all in ``every``: the parts in ``some``."""
    tokens = (attributes.get("class") or "").split()
    if not class_only and attributes.get("id"):
        tokens.append(attributes["id"])
    found: set[str] = set()
    for token in tokens:
        parts = {w.lower() for w in _WORD.findall(token) if not w.isdigit()}
        if parts and (parts <= every or token.lower() in some):
            found |= (parts | {token.lower()}) & some
    return found


def _weight(node: Node) -> float:
    return _BASE.get(node.tag, 0.0) + (25.0 if _words(node.attributes) & _GOOD else 0.0)


def _length(text: str) -> int:
    return len(" ".join(text.split()))


def measure(root: Node) -> list[Node]:
    """Cut what is never main text, and fill chars, links and block in one pass from the leaves up.

    Returns the elements left, each after those below it."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        for child in node.children:
            if type(child) is not str:
                if _cut(child):
                    child.cut = True
                else:
                    stack.append(child)
    order.reverse()
    for node in order:
        for child in node.children:
            if type(child) is str:
                node.chars += _length(child)
            elif not child.cut:
                node.chars += child.chars
                node.links += child.chars if child.tag == "a" else child.links
                node.n_links += child.n_links + (child.tag == "a")
                node.block = node.block or child.tag in _BLOCK or child.block
    return order


def own_text(node: Node) -> str:
    """Text of an element without the parts that are cut."""
    parts, stack = [], [node]
    while stack:
        x = stack.pop()
        if type(x) is str:
            parts.append(x)
            continue
        if x.tag in _BLOCK or x.tag == "br":
            parts.append(" ")
            if x is not node:
                stack.append(" ")
        stack.extend(c for c in reversed(x.children) if type(c) is str or not c.cut)
    return "".join(parts)


def _density(node: Node) -> float:
    return min(1.0, node.links / node.chars) if node.chars else 0.0


def best_container(order: list[Node]) -> Node | None:
    """Score the containers and pick the best; an article or main element around it takes its place."""
    scored: set[Node] = set()
    for node in order:
        plain = node.tag in ("p", "pre", "td", "blockquote", "li") or \
            node.tag in ("div", "section", "article", "main", "body", "#root") and not node.block
        if not plain or node.block and node.tag != "p" or node.chars < 25 or node.parent is None and node.block:
            continue
        points = (1.0 + len(_COMMAS.findall(own_text(node))) + min(node.chars // 100, 3)) * (1 - _density(node))
        up, level = node.parent or node, 0
        while up is not None and level < 6:
            if up not in scored:
                scored.add(up)
                up.score += _weight(up)
            up.score += points / (1 if level == 0 else 2 if level == 1 else level * 3)
            up, level = up.parent, level + 1
    best = max((n for n in order if n in scored), key=lambda n: n.score * (1 - _density(n)), default=None)
    if best is None:
        whole = ("article", "main"), ("body",), ("#root",)
        return next((n for tags in whole for n in order if n.tag in tags and n.chars), None)
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    return best


def _kept(best: Node) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    if best.parent is None or best.tag in ("article", "main", "body", "#root"):
        return [best]
    bar = max(10.0, 0.2 * best.score)
    out = []
    for x in best.parent.children:
        if x is best:
            out.append(x)
        elif type(x) is not str and not x.cut and x.chars:
            bonus = 0.2 * best.score if x.attributes and best.attributes and \
                x.attributes.get("class") and x.attributes.get("class") == best.attributes.get("class") else 0.0
            density = _density(x)
            if x.score * (1 - density) + bonus >= bar or x.tag == "p" and (
                    x.chars > 80 and density < 0.25 or density == 0 and re.search(r"[.!?。]\s*$", own_text(x))) \
                    or x.tag in ("h1", "h2") and density < 0.5:
                out.append(x)
    return out


def _drop_link_lists(node: Node) -> None:
    stack = [node]
    while stack:
        x = stack.pop()
        for child in x.children:
            if type(child) is not str and not child.cut:
                if child.tag in ("ul", "ol", "dl", "div", "section", "table") and child.n_links >= 3 and _density(child) > 0.6:
                    child.cut = True
                else:
                    stack.append(child)


def main_text(html: str | None) -> str:
    """The main text of one page, or the empty string."""
    if not html:
        return ""
    order = measure(parse(html))
    best = best_container(order)
    if best is None:
        return ""
    kept = _kept(best)
    for node in kept:
        if not node.holds and not _inside(node, {"article"}):
            _drop_link_lists(node)
    return " ".join(" ".join(own_text(n) for n in kept).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url").cast(pa.string()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=schema)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
