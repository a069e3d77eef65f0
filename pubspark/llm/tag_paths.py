"""Main text of web pages by tag-path ratios.

Every text node hangs from a root-to-leaf tag path (tag names with their classes). Per path, text
length and punctuation are summed over its nodes, less link text; a path's ratio is that sum per
node. Ratios are laid along the page in node order and smoothed, fused back to one value per path
(mean of its nodes' smoothed ratio, times the unlinked share), and paths at or above a threshold
are content: every block with a node of such a path is in the result, wherever it stands. The content
element, the deepest section that holds nearly all of their text, only widens it: by headings
and by blocks between content blocks, and by all its blocks if it is an ``article`` or ``main``. Headings
straight before a content block are in, too. All this is without parts that are no article text by their element or its class (menus,
headers, footers, side bars, notices, adverts, forms, comments; a class, id or role counts as a whole,
and not on an element that holds most of the text) and without blocks of links only.

Character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by two "\\n".

Defined results: null or empty html gives the empty text; markup that is cut off anywhere is read
as far as it goes; rows are judged one by one, so repeated rows give equal results; other
columns play no part; no limit on length or depth.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubspark.llm.common import as_batch, texts

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
#: Elements that are never article text, and words of a class, id or role that say the same.
OUTSIDE = frozenset(
    "head script style noscript template svg math nav footer aside form button select option "
    "textarea title iframe object canvas audio video map menu dialog label input xmp noembed "
    "noframes fieldset legend".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply "
    "replies respond disqus sidebar aside widget widgets related recommended recommendations "
    "share sharing social newsletter subscribe subscription signup login nav navbar navigation "
    "menu breadcrumb breadcrumbs pagination pager footer header masthead toolbar "
    "complementary contentinfo hidden".split())
SECTIONS = frozenset("article body center div html main section table tbody td tr".split())
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")
_WORD = re.compile(r"[a-z0-9]+")
_HEADING = re.compile(r"h[1-6]")
_TAG = re.compile(r"""<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|/?([A-Za-z][^\s/>]*)"""
                  r"""((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    """A run of text inside one element."""

    path: int
    element: int
    block: int
    text: str
    linked: bool


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    #: Elements whose class, id or role says that they are no article text.
    marked: list[bool] = field(default_factory=lambda: [False])


def _outside(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, str]:
    """Whether the element is outside the article, whether a word says so (a whole class, id or role,
    or one of such words only; ids of headings and inside an article are names of topics), and its
    label in a tag path."""
    if tag in OUTSIDE:
        return True, False, tag
    found, marked, label = False, False, tag
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "style":
            found |= _NONE.search(value) is not None
        elif name in ("hidden", "aria-hidden"):
            found |= value != "false"
        else:
            if name != "id" or not (in_article or _HEADING.fullmatch(tag)):
                marked |= any(w and OUTSIDE_WORDS.issuperset(w) for w in map(_WORD.findall, value.split()))
            if name == "class":
                label += "." + ".".join(_WORD.findall(value))
    if tag in ("html", "body", "article", "main"):
        return False, False, label
    return found, marked, label


def parse(html: str) -> Page:
    """Text nodes of the page that may be article text, in page order."""
    page = Page()
    paths: dict[tuple[int, str], int] = {}
    # open elements: tag, element, path, outside, linked
    stack: list[tuple[str, int, int, bool, bool]] = [("html", 0, 0, False, False)]
    counts: dict[str, int] = {}
    block, at, end = 0, 0, len(html)

    def text(a: int, b: int) -> None:
        _, element, path, outside, linked = stack[-1]
        if not outside and a < b:
            page.nodes.append(Node(path, element, block, html_lib.unescape(html[a:b]), linked))

    def close(tag: str) -> None:
        while True:
            top = stack.pop()[0]
            counts[top] -= 1
            if top == tag:
                return

    while at < end:
        cut = html.find("<", at)
        if cut < 0:
            text(at, end)
            break
        m = _TAG.match(html, cut)
        if not m:  # a sign, not a tag; or a tag that the page's end cuts off
            cut_off = re.compile(r"</?[A-Za-z!?]?[^<>]*\Z").match(html, cut)
            text(at, cut if cut_off and len(html) - cut > 1 and html[cut + 1] in "/!?" else cut + 1)
            at = cut + 1 if not (cut_off and html[cut + 1:cut + 2] in ("/", "!", "?")) else end
            continue
        text(at, cut)
        at = m.end()
        if m[1] is None or not m[3]:  # comment or declaration; a tag without its end is dropped
            continue
        tag = m[1].lower()
        if html[cut + 1] == "/":
            if tag in BLOCKS or tag == "br":
                block += 1
            if counts.get(tag):
                close(tag)
            continue
        if tag in BLOCKS:
            block += 1
            if counts.get("p") and tag != "option":
                close("p")
            if tag in ("li", "dd", "dt", "tr", "td", "th") and stack[-1][0] == tag:
                close(tag)
        if tag in VOID:
            if tag == "br":
                page.nodes.append(Node(stack[-1][2], stack[-1][1], block, "\n", True))
            continue
        outside, marked, label = _outside(tag, m[2], bool(counts.get("article") or counts.get("main")))
        if tag == "header":
            outside = outside or not counts.get("article")
        _, element, path, above, linked = stack[-1]
        page.parent.append(element)
        page.tag.append(tag)
        page.marked.append(marked)
        if m[2].rstrip().endswith("/") and tag in ("svg", "path", "use"):
            continue
        key = (path, label)
        stack.append((tag, len(page.tag) - 1, paths.setdefault(key, len(paths) + 1),
                      outside or above, linked or tag == "a"))
        counts[tag] = counts.get(tag, 0) + 1
        if tag in RAW:  # its content is no markup
            stop = re.compile(rf"</{tag}\b", re.I).search(html, at)
            at = stop.start() if stop else end
    return page


def without_marked(page: Page) -> list[Node]:
    """The page's nodes outside marked elements. A mark does not count on an element that holds more
    than half of the unlinked text inside ``article`` and ``main`` elements (if there is none, of all
    the unlinked text)."""
    if not any(page.marked):
        return page.nodes
    inside = [tag in ("article", "main") for tag in page.tag]
    for e in range(1, len(page.tag)):
        inside[e] |= inside[page.parent[e]]
    own, all_text = [0] * len(page.tag), [0] * len(page.tag)
    for n in page.nodes:
        if not n.linked:
            size = len(n.text.strip())
            all_text[n.element] += size
            own[n.element] += size * inside[n.element]
    weight = own if any(own) else all_text
    for e in range(len(page.tag) - 1, 0, -1):
        weight[page.parent[e]] += weight[e]
    gone = [m and 2 * w <= weight[0] for m, w in zip(page.marked, weight, strict=True)]
    for e in range(1, len(page.tag)):
        gone[e] |= gone[page.parent[e]]
    return [n for n in page.nodes if not gone[n.element]]


def smooth(values: list[float], kernel: tuple[float, ...] = (0.1, 0.2, 0.4, 0.2, 0.1)) -> list[float]:
    """``values`` weighted with their neighbours; at the ends the weights are scaled up."""
    r, n, out = len(kernel) // 2, len(values), []
    for i in range(n):
        lo, hi = max(0, i - r), min(n, i + r + 1)
        w = kernel[lo - i + r:hi - i + r]
        out.append(sum(x * y for x, y in zip(w, values[lo:hi], strict=True)) / sum(w))
    return out


def content_paths(nodes: list[Node], punctuation_weight: float = 10.0, threshold: float = 0.3) -> set[int]:
    """Paths whose fused ratio is at least ``threshold`` of the text-weighted mean ratio."""
    total: dict[int, list[float]] = {}  # path: nodes, length, linked length, punctuation
    for n in nodes:
        t = total.setdefault(n.path, [0, 0, 0, 0])
        t[0] += 1
        t[1] += len(n.text)
        t[2] += len(n.text) * n.linked
        t[3] += 0 if n.linked else len(PUNCTUATION.findall(n.text))
    ratio = {p: (length - linked + punctuation_weight * marks) / k
             for p, (k, length, linked, marks) in total.items()}
    fused: dict[int, float] = dict.fromkeys(total, 0.0)
    for n, v in zip(nodes, smooth([ratio[n.path] for n in nodes]), strict=True):
        k, length, linked, _ = total[n.path]
        fused[n.path] += v / k * (1 - linked / length)
    all_length = sum(t[1] for t in total.values())
    mean = sum(fused[p] * t[1] for p, t in total.items()) / all_length if all_length else 0.0
    return {p for p, v in fused.items() if v > 0 and v >= threshold * mean}


def content_element(page: Page, nodes: list[Node], paths: set[int], share: float = 0.8) -> int:
    """The deepest section that holds at least ``share`` of the content paths' text, not below
    an ``article`` or ``main``."""
    weight = [0] * len(page.tag)
    for n in nodes:
        if n.path in paths:
            weight[n.element] += len(n.text)
    children: dict[int, list[int]] = {}
    for e in range(len(page.tag) - 1, 0, -1):  # a child comes after its parent
        weight[page.parent[e]] += weight[e]
        if page.tag[e] in SECTIONS:
            children.setdefault(page.parent[e], []).append(e)
    at = 0
    while page.tag[at] not in ("article", "main"):
        heavy = [e for e in children.get(at, ()) if weight[e] >= share * max(weight[0], 1)]
        if not heavy:
            break
        at = heavy[0]
    return at


def main_text(html: str) -> str:
    """The article text of one page."""
    page = parse(html)
    page.nodes = without_marked(page)
    nodes = [n for n in page.nodes if n.text.strip()]
    if not nodes:
        return ""
    paths = content_paths(nodes)
    top = content_element(page, nodes, paths)
    inside, heading = [False] * len(page.tag), [_HEADING.fullmatch(t) is not None for t in page.tag]
    inside[top] = True
    for e in range(1, len(page.tag)):
        inside[e] |= inside[page.parent[e]]
        heading[e] |= heading[page.parent[e]]
    by_block: dict[int, list[Node]] = {}
    for n in page.nodes:
        by_block.setdefault(n.block, []).append(n)
    blocks = [own for own in by_block.values() if not all(n.linked or not n.text.strip() for n in own)]
    chosen = [any(n.path in paths and not n.linked and n.text.strip() for n in own) for own in blocks]
    within = [any(inside[n.element] for n in own) for own in blocks]
    named = page.tag[top] in ("article", "main")
    core = [k for k, own in enumerate(blocks) if chosen[k] and within[k]]
    out, follows = [], False  # follows: the next block that is no heading is chosen
    for k in reversed(range(len(blocks))):
        titled = any(heading[n.element] for n in blocks[k])
        widened = within[k] and (named or titled or bool(core) and core[0] < k < core[-1])
        if chosen[k] or widened or titled and follows:
            out.append(" ".join("".join(n.text for n in blocks[k]).split()))
        if not titled:
            follows = chosen[k]
    return "\n\n".join(t for t in reversed(out) if t)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``; one narrow stage."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                        ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(h) for h in texts(b, "html")]
            yield as_batch([b.column("page_id"), b.column("url"), out, list(map(len, out))], schema)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
