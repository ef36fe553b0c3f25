"""Main text of web pages by minimum-cut labelling of their blocks.

A page becomes a list of text blocks. A classifier gives each block a cost of being called content
and one of being called boilerplate; these are the capacities of its edges to the two terminals.
Blocks that follow each other, and blocks of one parent element, are tied by smoothness edges. The
minimum cut is the cheapest labelling.
"""

from __future__ import annotations

import html
import re
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.functions.text import evaluated_once
from quillsieve.llm.common import table

# Kinds of elements.
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "select", "object", "canvas"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
OUTSIDE = frozenset(("head", "nav", "footer", "aside", "button", "dialog", "menu"))
MAIN = frozenset(("article", "main"))
OUTSIDE_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar"))
#: Parts of class names and ids that hint at what isn't main text.
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising alert announcement banner breadcrumb breadcrumbs captcha comment comments commentlist consent cookie cookies disclaimer discussion disqus"
    " dropdown feedback footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain pager pagination popular popup privacy"
    " promo promoted promotion recommended related replies reply responses rail share sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola"
    " tags talkback teaser teasers toolbar topbar trending widget".split()
)
MAIN_NAMES = frozenset("article articlebody body content entry main post story text".split())

#: Costs. What an element's kind says outweighs every tie a block can have.
SURE = 40.0
LIKELY = 6.0
#: Ties of neighbouring blocks and of blocks with one parent.
NEXT_TIE = 0.6
PARENT_TIE = 0.6

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
#: One attribute, its value with it, so that nothing is looked for inside of values.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[a-z]+")


@dataclass
class _Element:
    tag: str
    number: int
    outside: bool
    main: bool
    hinted: bool
    named: tuple = ()  # (number, the same of the next one around it) of the nearest element whose name or kind hints at other text
    inner: int = 0  # open elements of the same inline tag inside that have no entry of their own


@dataclass
class Block:
    """A run of text between block borders, with what the classifier looks at."""

    text: str
    parent: int
    outside: bool
    main: bool
    hinted: bool
    tag: str
    link_chars: int
    named: tuple = ()


def _says(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """What an element's attributes say: that it isn't main text, that it is, that its name hints it isn't.

    A name with parts of both kinds, as in ``post-comments``, hints that it isn't; beside a name
    that only says it is, such a hint doesn't count.
    """
    outside = hinted = named = False
    if attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                for word in value.split():
                    parts = _NAME.findall(word)
                    if any(p in OUTSIDE_NAMES for p in parts):
                        named = True
                    elif any(p in MAIN_NAMES for p in parts):
                        hinted = True
            elif name == "role":
                outside |= value in OUTSIDE_ROLES
                hinted |= value == "main"
                named |= value == "form"
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                outside = True
            elif name == "style" and "display:none" in value.replace(" ", ""):
                outside = True
    if tag in ("body", "html"):
        outside = named = False
    return outside, hinted and not outside, named and not hinted


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; nothing of scripts, styles and comments.

    Markup need not be closed: a block element ends an open paragraph, an end tag ends all it
    encloses, one without a start is ignored, and an unfinished tag at the end is dropped. An inline
    element that is marked as not main text is a block of its own, up to its end tag.
    """
    out: list[Block] = []
    stack = [_Element("", 0, False, False, False)]
    parts: list[str] = []
    counter = links = link_chars = 0
    marked: dict[str, list[int]] = {}  # by inline tag the places of its entries in the stack

    def cut(to: int) -> None:
        """Close all elements from this place on."""
        for element in stack[to:]:
            if element.tag in INLINE:
                marked[element.tag].pop()
                if not marked[element.tag]:
                    del marked[element.tag]
        del stack[to:]

    def flush() -> None:
        nonlocal link_chars
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                out.append(Block(text, top.number, top.outside, top.main, top.hinted, top.tag, link_chars, top.named))
            parts.clear()
        link_chars = 0

    def say(raw: str) -> None:
        nonlocal link_chars
        if raw:
            parts.append(raw)
            if links:
                link_chars += len(raw)

    at, size = 0, len(page)
    search = _TOKEN.search
    while at < size:
        token = search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        tag = token[2] or token[5]
        if not tag:
            continue
        tag, attributes = tag.lower(), token[3] or token[6] or ""
        if token[1] or token[4]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in INLINE:
                i = marked.get(tag, [0])[-1]
                if not i:
                    continue
                if stack[i].inner:
                    stack[i].inner -= 1
                    continue
                flush()
                cut(i)
                continue
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    cut(i)
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "a":
            links = 1
        if tag in INLINE:
            outside, _, named = _says(tag, attributes)
            if not (outside or named) or tag in VOID or attributes.rstrip().endswith("/"):
                if tag in marked and not attributes.rstrip().endswith("/"):
                    stack[marked[tag][-1]].inner += 1
                continue
            marked.setdefault(tag, []).append(len(stack))
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    cut(i)
                    break
                if stack[i].tag not in INLINE:
                    break
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            if stack[-1].tag == tag:
                cut(len(stack) - 1)
        links = links if tag not in CLOSES_P else 0
        top = stack[-1]
        outside, hinted, named = _says(tag, attributes)
        outside |= tag in OUTSIDE or tag == "header" and not top.main
        # The main text's own element is what it is by its kind; an article inside of it may be a comment.
        named = (named and not (tag in MAIN and not top.main)) or tag == "form"
        counter += 1
        names = () if tag == "main" else (counter, top.named) if named else top.named
        stack.append(_Element(tag, counter, top.outside or outside, top.main or tag in MAIN, top.hinted or hinted, names))
    flush()
    return out


def shares(blocks: list[Block]) -> dict[int, tuple[float, float]]:
    """For each element whose name hints at other text its share of the page's text and its link density."""
    total = sum(len(b.text) for b in blocks if not b.outside)
    chars: dict[int, list[int]] = {}
    around: dict[int, int] = {}
    for block in blocks:
        if not block.outside and block.named:
            held = chars.setdefault(block.named[0], [0, 0])
            held[0] += len(block.text)
            held[1] += block.link_chars
            inner = block.named
            while inner[1] and inner[0] not in around:
                around[inner[0]] = inner[1][0]
                inner = inner[1]
    for number in sorted(around, reverse=True):  # inner elements have the larger numbers
        n, links = chars.setdefault(number, [0, 0])
        held = chars.setdefault(around[number], [0, 0])
        held[0] += n
        held[1] += links
    return {number: (n / total, min(1.0, links / n)) for number, (n, links) in chars.items()}


def costs(block: Block, page_has_main: bool, page_has_hint: bool = False, share: float = 0.0, links: float = 0.0) -> tuple[float, float]:
    """The classifier: (cost of dropping a block, cost of keeping it).

    The two flags say whether the page marks its main text anywhere, by element or by name.
    ``share`` and ``links`` are of the nearest element whose name hints at other text: the more of
    the page's text it holds and the less of that is links, the less its name counts.
    """
    if block.outside:
        return 0.0, SURE
    if block.main and not block.named:
        return SURE, 0.0
    keep, drop = 0.0, 0.0
    if block.named:
        drop += LIKELY * min(1.0, 1.5 * (1.0 - share)) * (1.0 + links)
        if block.main:
            keep += LIKELY * share**2
            page_has_main = page_has_hint = False
    length = len(block.text)
    density = min(1.0, block.link_chars / length)
    if page_has_main:
        drop += LIKELY
    if block.hinted:
        keep += LIKELY
    elif page_has_hint and block.tag != "h1":
        drop += LIKELY
    if density > 0.5:
        drop += 3.0
    if length >= 80:
        keep += 1.5 + 1.5 * (block.text.count(". ") > 0)
    elif block.tag in ("h1", "h2", "h3", "p", "blockquote", "pre"):
        keep += 1.0
    else:
        drop += 0.8
    return keep, drop


def _tie(ties: list[dict[int, float]], i: int, j: int, weight: float) -> None:
    ties[i][j] = ties[i].get(j, 0.0) + weight
    ties[j][i] = ties[j].get(i, 0.0) + weight


def minimum_cut(kept: list[float], dropped: list[float], ties: list[dict[int, float]]) -> list[bool]:
    """For each node whether it stays on the source's side of a minimum cut.

    ``kept`` are capacities from the source, ``dropped`` to the sink; ``ties`` are symmetric and
    are used up. Flow that needs no tie is sent first; the rest follows shortest paths.
    """
    rest = [a - b for a, b in zip(kept, dropped)]  # what source or sink has left after the direct flow
    n = len(rest)
    eps = 1e-9
    while True:
        came = [-2] * n
        queue = deque(i for i in range(n) if rest[i] > eps)
        for i in queue:
            came[i] = -1
        end = -1
        while queue and end < 0:
            i = queue.popleft()
            for j, room in ties[i].items():
                if room > eps and came[j] == -2:
                    came[j] = i
                    if rest[j] < -eps:
                        end = j
                        break
                    queue.append(j)
        if end < 0:
            return [c != -2 for c in came]
        path = [end]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        flow = min(rest[path[-1]], -rest[end], *(ties[b][a] for a, b in zip(path, path[1:])))
        rest[path[-1]] -= flow
        rest[end] += flow
        for a, b in zip(path, path[1:]):
            ties[b][a] -= flow
            ties[a][b] += flow


def main_text(page: str | None) -> str:
    """Main text of a page: its content blocks joined by line feeds; empty for null."""
    if not page:
        return ""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    has_main = any(b.main and not b.outside for b in blocks)
    ties: list[dict[int, float]] = [{} for _ in blocks]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            _tie(ties, i - 1, i, NEXT_TIE)
        if block.parent in last:
            _tie(ties, last[block.parent], i, PARENT_TIE)
        last[block.parent] = i
    has_hint = any(b.hinted and not b.outside for b in blocks)
    named = shares(blocks)
    pairs = [costs(b, has_main, has_hint, *(named.get(b.named[0], ()) if b.named else ())) for b in blocks]
    kept = minimum_cut([p[0] for p in pairs], [p[1] for p in pairs], ties)
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(page: Column) -> Column:
    """Main text of each page of a column of HTML; empty for null, empty and textless pages."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return evaluated_once(run)(page)


def extracted(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text of ``html_col``; an existing column is replaced.

    Each page is judged by itself on its whole markup, so repeated rows give equal texts.
    """
    return pages.withColumn(out, extract(F.col(html_col)))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op4_html_extraction": op4_html_extraction}
ORACLES: dict[str, str] = {}
