"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from math import exp, sqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_by_value

ship_by_value(__name__)

# Fixed values of HTML: what is never text, what stands alone, what breaks a line, what closes an open peer.
_SILENT = frozenset("head script style noscript template iframe object svg math canvas audio video select textarea button title".split())
_RAW = frozenset("script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_PEERS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SCOPES = frozenset("table ul ol dl td th body html article section div select".split())
# Parts of a page that are not its article: by element, by role, and by words of class or id.
_PARTS = frozenset("nav header footer aside form dialog menu".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion sidebar sidenav menu menubar nav navbar
    navigation breadcrumb breadcrumbs header masthead footer comment comments commentlist disqus replies respond cookie cookies consent gdpr
    notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing sharebar social related
    recommended recommendations widget toolbar pagination pager copyright legal skip search form""".split()
)
_MENUS = frozenset("nav menu navigation menubar".split())  # elements and roles that are never text
_BESIDE = frozenset("li dt dd td th caption figcaption pre".split()) | _HEADINGS  # short parts that stay beside content
# Words of class or id that say where an element stands or what it is made of, not what it holds.
_SHAPES = frozenset(
    """area bar block body bottom box button center col column container content element entry fixed group holder inner item items left link links
    list main outer page panel position primary row secondary section site slot small large static sticky text title top unit wide wrap wrapper
    right zone post posts article articles default global mobile desktop""".split()
)
LOWERED = 0.1  # what a path's characters count for under each element that names call foreign
FURNITURE = 25  # an element of fewer characters per block is furniture
_ROOTS = frozenset("html body main".split())
_ARTICLES_OUT = frozenset("ad advert advertisement sponsored promo related comment comments reply replies".split())

_TOKEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_REMARK = re.compile(r"<[!?]")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"\b(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|\b(hidden)\b", re.I)
_NEGATED = re.compile(r"\b(?:has|with|no|without)[-_]\w+")
_PUNCT = re.compile(r"[.,;:!?。，！？،؟]")


def _words(value: str, known: frozenset) -> tuple[set[str], set[str]]:
    """The ``known`` words that names of class or id end in, apart from shapes and numbers, and those at other places."""
    surely, maybe = set(), set()
    for name in _NEGATED.sub(" ", value).split():
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w and not w.isdigit() and (w in known or w not in _SHAPES)]
        surely.update(w for w in words[-1:] if w in known)
        maybe.update(w for w in words[:-1] if w in known)
    return surely, maybe


def _foreign(tag: str, attrs: str, inside: bool) -> tuple[bool, int, bool, bool, str]:
    """Whether an element is a menu or hidden, whether names call it something other than the article (2: elements
    and roles made for that), whether they do so for sure, whether it may head an article, and its label on the tag path.
    """
    label, menu, surely, maybe = tag, tag in _MENUS, set(), set()
    part = tag in _PARTS
    if attrs:
        for key, a, b, c, hidden in _ATTR.findall(attrs):
            value, key = (a or b or c).lower(), key.lower()
            if key == "class":
                label = f"{tag}.{value}"
            if hidden or key == "style" and "display:none" in value.replace(" ", "") or key == "role" and value in _MENUS:
                menu = True
            elif key == "role" and value in _ROLES:
                part = True
            elif key in ("class", "id") and tag not in _ROOTS:
                for names, found in zip((surely, maybe), _words(value, _ARTICLES_OUT if tag == "article" else _WORDS), strict=True):
                    names |= found - ({"header"} if inside else set())
    heads = (inside if tag == "header" else not part) and surely | maybe <= {"header"}
    return menu, 2 if part and tag != "form" else int(part or bool(surely or maybe)), part or bool(surely), heads, label


def _tag_end(page: str, at: int, dead: set[int]) -> int:
    """Where the ``>`` stands that ends a tag: the first outside quotes, or the first at all if quotes stay open.
    ``dead`` holds the opening quotes from which no end was found, so that a page is read a fixed number of times.
    """
    seen, i = [], at
    while m := _STOP.search(page, i):
        if m[0] == ">":
            return m.start()
        if m.start() in dead:
            break
        seen.append(m.start())
        i = page.find(m[0], m.end()) + 1
        if not i:
            break
    dead.update(seen)
    return page.find(">", at)


class _Page:
    """Elements and text blocks of one page; elements are numbered as they open, 0 is the page. Each has a constant
    number of entries, whatever its depth, so that the work grows with the page's length alone.
    """

    def __init__(self) -> None:
        self.parent, self.tag, self.path, self.beside, self.marked = [0], [""], [0], [0], [False]
        self.end = [0]  # the last element inside each
        self.paths: dict[tuple[int, str], int] = {}
        # Lists of the foreign elements around a block: the list without the innermost, and that element's number, weight and certainty.
        self.rest, self.named, self.weight, self.sure = [0], [0], [0], [True]
        self.blocks: list[tuple[int, int, str, int]] = []  # element, foreign list, text, characters in links

    def add(self, parent: int, tag: str, label: str | None) -> int:
        """A new element; without a label an inline one, which is no step of the path."""
        self.parent.append(parent)
        self.tag.append(tag)
        self.path.append(self.path[parent] if label is None else self.paths.setdefault((self.path[parent], label), len(self.paths) + 1))
        self.beside.append(self.beside[parent] + (tag in _BESIDE))
        self.marked.append(self.marked[parent] or tag in ("article", "main"))
        self.end.append(len(self.tag) - 1)
        return len(self.tag) - 1

    def call(self, rest: int, element: int, weight: int, sure: bool) -> int:
        self.rest.append(rest)
        self.named.append(element)
        self.weight.append(weight)
        self.sure.append(sure)
        return len(self.rest) - 1


def parse(page: str) -> _Page:
    """The elements of a page and its text blocks outside menus in page order."""
    made = _Page()
    # open elements: tag, innermost block element, menu from here on, foreign list, the same without those that may head an article, number
    stack: list[tuple[str, int, bool, int, int, int]] = [("", 0, False, 0, 0, 0)]
    at_of: dict[str, list[int]] = defaultdict(list)  # where the open elements of a tag stand on the stack
    solid = [0]  # where the open block elements stand
    text: list[str] = []
    linked = silent = 0
    dead: set[int] = set()

    def flush() -> None:
        nonlocal linked
        if text:
            if (words := " ".join("".join(text).split())) and not stack[-1][2]:
                made.blocks.append((stack[-1][1], stack[-1][3], words, linked))
            text.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal silent
        while len(stack) > to:
            tag = stack[-1][0]
            made.end[stack[-1][5]] = len(made.tag) - 1
            stack.pop()
            at_of[tag].pop()
            if tag not in _INLINE:
                solid.pop()
            silent -= tag in _SILENT

    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        m = _TOKEN.search(page, at)
        if m and m[2] and m.start() > last:  # no tag ends from here on
            m = _REMARK.search(page, at)
        stop = m.start() if m else end
        if stop > at and not silent:
            piece = html.unescape(page[at:stop])
            text.append(piece)
            linked += len(piece.strip()) if at_of["a"] else 0
        if not m:
            break
        if page.startswith("<!--", stop):
            at = page.find("-->", stop + 4) + 3
            at = end if at < 3 else at
            continue
        if page[stop + 1] in "!?":
            at = page.find(">", stop + 2) + 1 or end
            continue
        closing, tag = m[1], m[2].lower()
        close = _tag_end(page, m.end(), dead)
        attrs, at = page[m.end() : close], close + 1
        if tag not in _INLINE and not silent:
            flush()
        if closing:
            if at_of[tag] and (tag not in _INLINE or at_of[tag][-1] > solid[-1]):
                pop(at_of[tag][-1])
            continue
        if tag == "br":
            text.append(" ")
        if tag in _VOID:
            continue
        if tag not in _INLINE:  # a new block ends an open paragraph, a new item the item before it
            ends = _PEERS.get(tag, ("p",))
            if tag in ("tr", "tbody", "tfoot"):
                scope = at_of["table"][-1] if at_of["table"] else 0
                inner = [places[k] for x in ends if (places := at_of[x]) and (k := bisect_right(places, scope)) < len(places)]
                if inner:
                    pop(min(inner))
            else:
                inner = max((at_of[x][-1] for x in ends if at_of[x]), default=0)
                if inner and all(not at_of[x] or at_of[x][-1] < inner for x in _SCOPES if x not in ends):
                    pop(inner)
        if attrs.endswith("/") and tag in ("svg", "math"):
            continue
        menu, foreign, sure, heads, label = _foreign(tag, attrs, bool(at_of["article"] or at_of["main"]))
        up = stack[-1]
        number = made.add(up[1], tag, None if tag in _INLINE else label)
        # the header of an article holds its title: headings in it stay
        all_of, bare = (up[4], up[4]) if tag in _HEADINGS else up[3:5]
        if foreign:
            whole = made.call(all_of, number, foreign, sure)
            bare = bare if heads else whole if bare == all_of else made.call(bare, number, foreign, sure)
            all_of = whole
        if tag not in _INLINE:
            solid.append(len(stack))
        at_of[tag].append(len(stack))
        stack.append((tag, up[1] if tag in _INLINE else number, up[2] or menu, all_of, bare, number))
        silent += tag in _SILENT
        if tag in _RAW:  # its content is not markup
            close = re.compile(rf"</{tag}\b", re.I).search(page, at)
            at = (page.find(">", close.end()) + 1 or end) if close else end
            pop(len(stack) - 1)
    if not silent:
        flush()
    pop(1)
    made.end[0] = len(made.tag) - 1
    return made


def _own(page: _Page, share: float) -> list[tuple[int, int, str, int]]:
    """Blocks that may be the article, with the number of foreign elements that count in place of their list."""
    size = len(page.rest)
    sums = [[0, 0, 0, 0] for _ in range(size)]  # characters, in links, punctuation, blocks under each foreign list
    for _, of, text, linked in page.blocks:
        for k, n in enumerate((len(text), min(linked, len(text)), len(_PUNCT.findall(text)), 1)):
            sums[of][k] += n
    held: dict = defaultdict(lambda: [0, 0, 0, 0])
    total = sum(len(b[2]) for b in page.blocks)
    for i in range(size - 1, 0, -1):
        for k, n in enumerate(sums[i]):
            sums[page.rest[i]][k] += n if page.rest[i] else 0
            held[page.named[i]][k] += n
    out, weight = [False] * size, [0] * size
    for i in range(1, size):
        chars, links, marks, count = held[page.named[i]]
        furniture = page.sure[i] or 2 * links >= chars or marks < count or chars < FURNITURE * count
        out[i] = out[page.rest[i]] or furniture and chars < share * total
        weight[i] = weight[page.rest[i]] + (page.weight[i] if furniture and chars < (1 - share) * total else 0)
    own = [b for b in page.blocks if not out[b[1]]] or page.blocks
    return [(b[0], weight[b[1]], b[2], b[3]) for b in own]


def main_text(html_text: str | None, share: float, radius: int) -> str:
    """The article of one page; see ``extract``."""
    page = parse(html_text) if html_text else _Page()
    if not page.blocks:
        return ""
    own = _own(page, share)
    marked = [b for b in own if page.marked[b[0]]]
    if marked and 2 * sum(len(b[2]) * LOWERED ** b[1] for b in marked) >= sum(len(b[2]) * LOWERED ** b[1] for b in own):
        own = marked
    path = [page.path[b[0]] for b in own]
    count: dict = defaultdict(int)
    chars: dict = defaultdict(int)
    marks: dict = defaultdict(int)
    links: dict = defaultdict(int)
    lowered: dict = {}
    for p, (_, foreign, text, linked) in zip(path, own, strict=True):
        lowered[p] = LOWERED**foreign
        count[p] += 1
        chars[p] += len(text)
        marks[p] += len(_PUNCT.findall(text))
        links[p] += linked
    ratio = {p: lowered[p] * (chars[p] - min(links[p], chars[p])) / count[p] for p in count}
    punct = {p: (1 + marks[p]) / count[p] for p in count}
    weights = [exp(-(d * d) / 2) for d in range(-radius, radius + 1)]
    fused: dict = defaultdict(float)  # mean over the path's blocks: own and smoothed products of the two ratios
    for i, mine in enumerate(path):
        near = [(w, path[j]) for w, j in zip(weights, range(i - radius, i + radius + 1), strict=True) if 0 <= j < len(own)]
        whole = sum(w for w, _ in near)
        smooth = sum(w * ratio[p] for w, p in near) / whole * sum(w * punct[p] for w, p in near) / whole
        fused[mine] += sqrt(smooth * ratio[mine] * punct[mine]) / count[mine]
    least = share * max(fused.values())
    seeds = [b for b, p in zip(own, path, strict=True) if fused[p] >= least]
    depth = min(b[1] for b in seeds)
    # elements are numbered in page order: what holds the first and the last holds all
    first, final = min(b[0] for b in seeds), max(b[0] for b in seeds)
    common = page.parent[first] if len(seeds) == 1 else first  # the only block's own element says nothing about its neighbours
    while page.end[common] < final:
        common = page.parent[common]
    menu = {p for p in count if count[p] > 2 and links[p] >= 0.9 * chars[p]}
    near = [i for i, b in enumerate(own) if common <= b[0] <= page.end[common] and path[i] not in menu]
    kept = [fused[path[i]] >= least for i in near]
    small = [own[i][1] <= depth and page.beside[own[i][0]] > page.beside[common] for i in near]
    for order in (range(1, len(near)), range(len(near) - 2, -1, -1)):
        for k in order:
            kept[k] = kept[k] or small[k] and kept[k - order.step]
    stay = [i for i, k in zip(near, kept, strict=True) if k]
    # the only first heading of the page before its content is the title, wherever it stands
    heads = [i for i, b in enumerate(own) if page.tag[b[0]] == "h1"]
    start = next((i for i, p in enumerate(path) if fused[p] >= least), 0)
    if len(heads) == 1 and heads[0] < start and own[heads[0]][1] <= depth and heads[0] not in stay:
        stay.insert(0, heads[0])
    return "\n\n".join(own[i][2] for i in stay)


def extract(pages: DataFrame, html_col: str = "html", share: float = 0.2, radius: int = 1) -> DataFrame:
    """``pages`` with ``text``, the main text of each whole page, and ``n_chars``, its code points.

    Each page is cut into blocks of text under root-to-leaf tag paths (class names included). Menus and hidden
    elements leave. For every path the characters outside links and the punctuation marks per block are summed,
    smoothed over ``radius`` neighbours on the page and fused: the geometric mean of the products of the
    smoothed and of the path's own values. Paths with at least ``share`` of the best are content.

    Names (elements, roles and words of class or id for headers, footers, sidebars, notices, adverts, forms and reader
    comments) decide alone only about elements with less than ``share`` of the page's text, which leave unless
    nothing else is there. A class or id must end in such a word, apart from words of place or shape (``ad-slot``); where
    the word stands elsewhere in it (``related-work``), the name counts only if the element also reads like furniture: half of its characters in
    links, fewer punctuation marks than blocks, or fewer than 25 characters a block. Under larger ones a path's characters count a tenth for each such element (a hundredth for
    elements and roles like ``footer``), and elements with all but ``share`` of the text are not touched by their names, nor are headings in the header of an article.

    The text is, in page order, the content blocks and, beside these and below the innermost element that holds all content,
    headings, list items, cells, captions and preformatted blocks under no more foreign elements than the content.
    The only ``h1`` of a page stays if it comes before the content. Where ``article`` or ``main`` elements hold at
    least half of the text so counted, only blocks inside them are considered. Lists of nothing but links leave. Null, empty and
    textless pages give an empty text. Time grows with a page's length, however its elements nest or stay open; repeated
    rows are extracted alike. Columns of these names are replaced.
    """

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p, share, radius) for p in pages], dtype=object)

    seen = pages.drop("text", "n_chars").withColumn("text", texts(F.col(html_col)))
    return seen.withColumn("n_chars", F.char_length("text").cast("long"))
