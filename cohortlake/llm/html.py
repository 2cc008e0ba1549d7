"""Main text of HTML pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.texts import ROWS_AT_ONCE

#: Gaussian weights over neighbouring text nodes.
SMOOTHING = np.array([1, 4, 6, 4, 1]) / 16
#: Standard deviations of the fused scores that a content node reaches.
THRESHOLD = 0.8
#: Share of the content nodes' text that marked articles hold.
MAIN_SHARE = 0.8
#: Share of a box's text inside links from which on it is a menu, and that of a page from which on a form wraps it.
LINK_SHARE, WRAP_SHARE = 0.5, 0.6
#: Blocks in a row that make a menu, each a link without punctuation of at most so many characters.
MENU_RUN, MENU_CHARS = 3, 30

# Elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that end an open one of the named kinds.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr"), "body": ("head",),
}
SCOPES = frozenset("html body article section main div table ul ol dl select blockquote nav aside footer header".split())
NOISE = frozenset(
    "head script style noscript template iframe object svg canvas nav footer aside form button select textarea input "
    "dialog menu audio video map math datalist".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs masthead footer sidebar aside widget cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay newsletter subscribe subscription signup login search share sharing social comment comments commentlist reply "
    "replies respond discussion disqus related recommended recommendations teaser toolbar pagination pager skip disclaimer "
    "copyright form".split()
)
#: Beginnings of names that mean noise.
NOISE_STARTS = ("advert", "breadcrumb", "cookie", "navbar", "newsletter", "sidebar")
#: Names that only mean noise outside the article, and words before them that make them the article's own.
OUTER_NAMES = frozenset(("header", "topbar", "top"))
OWN = frozenset(("article", "content", "entry", "post", "story"))
ARTICLE = frozenset(("article", "main"))
#: Names of what readers wrote, which is never the article however long it is.
READERS = frozenset("comment comments commentlist reply replies respond discussion disqus".split())
#: First words of names that say what an article is about.
TOPICS = frozenset(("category", "tag", "tags", "topic", "keyword"))
#: Words before a name that make it a remark about the page's layout.
REMARKS = frozenset(("has", "with", "no", "without"))

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose own text is a menu if it is mostly links.
LINK_BOXES = frozenset(("", "html", "body", "div", "section", "main", "article", "center", "form", "ul", "ol", "table", "tr"))
#: Elements that may hold an article, and whose own text is only taken where it reaches the threshold.
BOXES = frozenset(("", "html", "body", "div", "section", "main", "article", "center", "form"))

#: A tag ends at the first ``>`` outside quotes, else at the first at all; nothing is tried twice.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?:(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|(?P<bare>[^>]*+)>)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")


@dataclass
class Element:
    tag: str
    parent: int
    noise: str  # why it is noise by itself: "" if it is not, else "kind", "form", "name" or "readers"
    root: int  # the nearest element, itself included, that is noise by itself; 0 if there is none
    path: int  # number of its tag path
    linked: bool  # a link is around
    inside: bool  # an article or main element is around


@dataclass
class Block:
    """Text between two block boundaries, the element that holds it, and the nearest noise around."""

    element: int
    root: int
    parts: list[str] = field(default_factory=list)
    links: int = 0
    nodes: list[tuple[int, int, int]] = field(default_factory=list)  # tag path, characters, punctuation


def _noise_of(tag: str, rest: str, inside: bool) -> str:
    """Why an element is noise by itself; the empty text if it is not."""
    if tag in NOISE or tag == "header" and not inside:
        return "form" if tag == "form" else "kind"
    if "=" not in rest and "hidden" not in rest:
        return ""
    values = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}
    if values.get("role", "").lower() in NOISE_ROLES or values.get("aria-hidden", "").lower() == "true":
        return "kind"
    if "display:none" in values.get("style", "").replace(" ", "").lower() or re.search(r"\shidden(?=[\s/]|\Z)", rest):
        return "kind"
    if tag in ("html", "body"):
        return ""
    found = ""
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        words = [w.lower() for w in _NAME_PARTS.findall(name)]
        if len(words) > 1 and words[0] in TOPICS:
            continue
        for k, word in enumerate(words):
            before = words[k - 1] if k else ""
            if before in REMARKS:
                continue
            if word in READERS or before + word in READERS:
                return "readers"
            if word in NOISE_NAMES or before + word in NOISE_NAMES or word.startswith(NOISE_STARTS):
                found = "name"
            if word in OUTER_NAMES and not inside and before not in OWN:
                found = "name"
    return found


def parse(page: str) -> tuple[list[Element], list[Block]]:
    """Elements and text blocks of a page, with open ends closed the way browsers do."""
    elements = [Element("", 0, "", 0, 0, False, False)]
    stack, blocks, block = [0], [], None
    paths, open_ = {}, Counter()
    at, end = 0, page.rfind(">") + 1  # no tag ends behind

    def text(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        top = stack[-1]
        if block is None:
            holder = next(e for e in reversed(stack) if elements[e].tag not in INLINE)
            block = Block(holder, elements[top].root)
            blocks.append(block)
        elif elements[top].root != block.root:  # an inline element may be noise too
            block = Block(block.element, elements[top].root)
            blocks.append(block)
        piece = html.unescape(piece)
        block.parts.append(piece)
        length = len("".join(piece.split()))
        if length:
            block.links += length if elements[top].linked else 0
            block.nodes.append((elements[top].path, length, len(_PUNCTUATION.findall(piece))))

    def close(tags: tuple[str, ...], scopes: frozenset[str]) -> None:
        if not any(open_[tag] for tag in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if elements[stack[k]].tag in tags:
                open_.subtract(elements[e].tag for e in stack[k:])
                del stack[k:]
                return
            if elements[stack[k]].tag in scopes:
                return

    while at < end:
        token = _TOKEN.search(page, at, end)
        if token is None:
            break
        text(page[at : token.start()])
        at = token.end()
        if token[0].startswith("<!--") and not token[0].endswith("-->") or token["cdata"] is not None and not token[0].endswith("]]>"):
            at = len(page)  # open to the end of the page
        if token["cdata"] is not None:
            text(html.escape(token["cdata"], quote=False))
        if token["name"] is None:
            continue
        tag = token["name"].lower()
        if tag not in INLINE:
            block = None
        if token["close"]:
            close((tag,), frozenset())
            continue
        if tag == "br" and block is not None:
            block.parts.append(" ")
        if tag not in INLINE:
            close(("p",), SCOPES - {"p"})
        if tag in CLOSES:
            close(CLOSES[tag], SCOPES - frozenset(CLOSES[tag]) - ({"table"} if tag == "body" else frozenset()))
        if tag in VOID:
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
            at = closing.end()
            continue
        around = elements[stack[-1]]
        inside = around.inside or around.tag in ARTICLE
        rest = token["bare"] if token["rest"] is None else token["rest"]
        if rest.endswith("/") and tag in ("svg", "path", "use"):
            continue
        noise, number = _noise_of(tag, rest, inside), len(elements)
        path = paths.setdefault((around.path, tag), len(paths) + 1)
        elements.append(Element(tag, stack[-1], noise, number if noise else around.root, path, around.linked or tag == "a", inside))
        stack.append(number)
        open_[tag] += 1
    text(page[at:].partition("<!--")[0])
    return elements, blocks


def _sums(elements: list[Element], blocks: list[Block], size: list[int]) -> list[int]:
    """Characters below each element; parents come before their children."""
    held = [0] * len(elements)
    for b, n in zip(blocks, size):
        held[b.element] += n
    for e in range(len(elements) - 1, 0, -1):
        held[elements[e].parent] += held[e]
    return held


def _under(elements: list[Element], around: int) -> list[bool]:
    """Which elements are this one or below it."""
    found = [False] * len(elements)
    for e, element in enumerate(elements):
        found[e] = e == around or e > 0 and found[element.parent]
    return found


def _silent(elements: list[Element], reasons: tuple[str, ...], spared: frozenset[int] = frozenset()) -> list[bool]:
    """Which elements are noise, or below some, for one of the reasons."""
    found = [False] * len(elements)
    for e, element in enumerate(elements):
        found[e] = element.noise in reasons and e not in spared or e > 0 and found[element.parent]
    return found


def _heard(elements: list[Element], blocks: list[Block]) -> list[Block]:
    """The blocks that are no noise.

    A form that holds most of the page's text wraps the page, and an element whose name alone speaks
    against it is none if it holds nearly all that the path scores take for content: names lower what a
    part of a page counts, they never remove the article. What readers wrote stays noise.
    """
    size = [sum(n for _, n, _ in b.nodes) for b in blocks]
    whole, spared = sum(size), set()
    if any(e.noise == "form" for e in elements):
        held = _sums(elements, blocks, size)
        spared |= {k for k, e in enumerate(elements) if e.noise == "form" and held[k] > WRAP_SHARE * whole}
    if any(e.noise == "name" for e in elements):
        hard = _silent(elements, ("kind", "form", "readers"), frozenset(spared))
        some = [(b, n) for b, n in zip(blocks, size) if not hard[b.root]]
        held = _sums(elements, [b for b, _ in some], [n for _, n in some])
        likely = [k for k, e in enumerate(elements) if e.noise == "name" and held[k] >= MAIN_SHARE * held[0] > 0]
        if likely:
            prose = _sums(elements, *_content([b for b, _ in some if b.nodes], elements)[:2])
            spared |= {k for k in likely if prose[k] >= MAIN_SHARE * prose[0] > 0}
    noise = _silent(elements, ("kind", "form", "name", "readers"), frozenset(spared))
    return [b for b in blocks if b.nodes and not noise[b.root]]


def _scores(blocks: list[Block]) -> list[np.ndarray]:
    """The fused and smoothed score of each text node: length and punctuation per node of its path."""
    chars, points, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in blocks:
        for path, n, p in b.nodes:
            chars[path] += n
            points[path] += p
            count[path] += 1
    fused = {path: np.sqrt(chars[path] / n * (1 + points[path] / n)) for path, n in count.items()}
    raw = np.array([fused[path] for b in blocks for path, _, _ in b.nodes])
    reach = len(SMOOTHING) // 2
    padded = np.pad(raw, reach, mode="edge") if len(raw) else raw
    smooth = np.convolve(padded, SMOOTHING, "valid") if len(raw) else raw
    return np.split(smooth, np.cumsum([len(b.nodes) for b in blocks])[:-1]) if blocks else []


def _menus(elements: list[Element], blocks: list[Block], size: list[int]) -> list[bool]:
    """Which blocks are menus: boxes of links, and runs of short blocks that are nothing but a link.

    A heading, paragraph, item or cell by itself is text, also where it is linked.
    """
    linked = [b.links > LINK_SHARE * n for b, n in zip(blocks, size)]
    menu = [x and elements[b.element].tag in LINK_BOXES for b, x in zip(blocks, linked)]
    only = [
        b.links == n <= MENU_CHARS and elements[b.element].tag not in HEADINGS and not any(p for _, _, p in b.nodes)
        for b, n in zip(blocks, size)
    ]
    at = 0
    while at < len(blocks):
        end = at
        while end < len(blocks) and only[end]:
            end += 1
        if end - at >= MENU_RUN:
            menu[at:end] = [True] * (end - at)
        at = max(end, at + 1)
    return menu


def _content(blocks: list[Block], elements: list[Element]) -> tuple[list[Block], list[int], list[np.ndarray], list[bool], float]:
    """Blocks at or over the threshold that are no menus, and their sizes; scores, menus and the threshold of all."""
    scores = _scores(blocks)
    bound = THRESHOLD * np.std(np.concatenate(scores))
    size = [sum(n for _, n, _ in b.nodes) for b in blocks]
    menu = _menus(elements, blocks, size)
    some = [k for k, s in enumerate(scores) if not menu[k] and s.mean() >= bound]
    return [blocks[k] for k in some], [size[k] for k in some], scores, menu, bound


def _main(elements: list[Element], held: list[int]) -> tuple[int, bool]:
    """The element that the text is taken from, and whether it is marked as the article.

    That is the innermost element around all marked articles (else main elements) with content, if these
    hold ``MAIN_SHARE`` of it, else the one around all content; a part of the text, as a list or a quote
    is, is no such element.
    """
    for tag in ("article", "main"):
        around = [False] * len(elements)  # is such an element around
        for e in range(1, len(elements)):
            up = elements[e].parent
            around[e] = around[up] or up > 0 and elements[up].tag == tag
        tops = [e for e in range(len(elements)) if held[e] and elements[e].tag == tag and not around[e]]
        if sum(held[e] for e in tops) >= MAIN_SHARE * held[0] > 0:
            if len(tops) == 1:
                return tops[0], True
            below = [0] * len(elements)
            for e in tops:
                below[e] = 1
            for e in range(len(elements) - 1, 0, -1):
                below[elements[e].parent] += below[e]
            return max(e for e, n in enumerate(below) if n == len(tops)), False
    around = max(e for e, n in enumerate(held) if n == held[0])  # inner elements open later
    while around and elements[around].tag not in BOXES:
        around = elements[around].parent
    return around, False


def main_text(page: str | None) -> str:
    """The article's text: blocks with one space for any white space, joined by one space."""
    if not page:
        return ""
    elements, blocks = parse(page)
    blocks = _heard(elements, blocks)
    if not blocks:
        return ""
    content, size, scores, menu, bound = _content(blocks, elements)
    if not content:
        return ""
    main, marked = _main(elements, _sums(elements, content, size))
    inside = _under(elements, main)
    kept = [
        b for b, s, m in zip(blocks, scores, menu)
        if not m and inside[b.element] and (marked or s.mean() >= bound or elements[b.element].tag not in BOXES)
    ]
    return " ".join(" ".join("".join(b.parts).split()) for b in kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``, from the whole ``html``.

    A null, empty or textless page gives an empty text of length 0. Repeated rows give equal rows; null
    ids and urls are kept. Other columns are not read; an empty table gives an empty result. Pages are
    independent, so there is no shuffle; a task holds the pages of a part of an Arrow batch.

    Text nodes are grouped by root-to-leaf tag path; text length and punctuation per node of a path are
    fused, smoothed in page order and held against a threshold. The article or main element with nearly
    all of the nodes above it is the main one, else the innermost that holds them all, and its blocks are
    the text; where it is no marked article, text that stands in a box by itself must be above, too. Elements that by their kind,
    role or name are menus, headers, footers, sidebars, notices, adverts, forms or comments are left
    out before, and menus of links after: boxes that are mostly links, and runs of short linked blocks.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, ROWS_AT_ONCE):
                rows = part.slice(at, ROWS_AT_ONCE)
                found = [main_text(page) for page in rows.column(2).to_pylist()]
                columns = [rows.column(0), rows.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return source.mapInArrow(batches, "page_id long, url string, text string, n_chars long")
