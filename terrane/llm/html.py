"""Main text of web pages: blocks are labelled content or boilerplate by a minimum cut.

A page is read into elements and blocks, the runs of text between block-level tags. Each block and each
element that holds blocks is a node. A classifier with the fixed weights below gives a node evidence for
content; the costs of either label, softplus of the evidence with either sign, are its capacities to the two
terminals. Smoothness edges tie blocks that follow each other, more when they are near in the DOM, and
every node to its parent element. The maximum flow leaves the cheapest cut: nodes on the source's side are
content. Parts whose markup says what they are (navigation, footers, forms, scripts) are tied to the sink, but not a form
around most of the page's long blocks, nor the header of an entry.

The text has character references decoded, each run of white space as one space, and one block a line. ``br``
is white space; table cells and list items are blocks. Text of buttons, labels and choices inside a block is left out of it.
Words of scripts without spaces are counted by their letters. Time and memory grow with the page, however deep its elements.

Edge cases: NULL and empty html, and pages without content give an empty text; unclosed and misplaced tags
are closed as browsers do for paragraphs, items and cells; an unclosed comment, script, style or textarea runs to the end, what
other elements without text (svg, noscript, template, iframe, head) leave open hides nothing; formulas and the
inside of ``object`` are text;
``<`` without a tag name is text. Repeated rows give repeated results.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from html import unescape

from pyspark.sql import DataFrame

from .common import map_texts

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|<[!?/][^>]*+>",
    re.S | re.I,
)
# What is inside these elements is no text; those of _ENDLESS run to the end of the page if nothing ends them.
_RAW = {x: re.compile(rf"</{x}\s*>", re.I) for x in "script style textarea noscript template iframe svg head".split()}
_ENDLESS = frozenset("script style textarea".split())
_SELF_CLOSED = re.compile(r"(?:\A|[\s\"'])/\Z|(?:\A|\s)[^\s=\"']*/\Z")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th"
    " thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag of a key closes an open element of its values, up to the nearest of _SCOPE.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol menu dl table body div section article main aside nav header footer form".split())
_SINK = frozenset("nav footer aside form menu button select dialog option label input search".split())
_INLINE = frozenset("button label select option optgroup".split())
_HEADED = frozenset("article entry post story".split())
_BAD = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright"
    " disclaimer discussion disqus feedback footer gdpr header legal login masthead menu meta modal nav navbar navigation newsletter notice"
    " notification overlay pager pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing"
    " sidebar signup social sponsor sponsored subscribe subscription tags teaser toolbar tracking widget"
    " banner complementary contentinfo form".split()
)
_GOOD = frozenset("article body content entry main post story text".split())
_PHRASES = re.compile(r"©|\(c\) \d{4}|all rights reserved|cookie|subscribe|newsletter|sign up|log in|privacy policy|terms of (?:use|service)|read more|click here", re.I)

_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_P, _H1, _HEADING, _TITLE = 1, 2, 4, 8
_UNDER = {"p": _P, "h1": _H1 | _HEADING, "title": _TITLE} | dict.fromkeys("h2 h3 h4 h5 h6".split(), _HEADING)

SMOOTH, PARENT, FAR = 0.8, 0.5, 24.0


class _Node:
    __slots__ = ("tag", "parent", "depth", "score", "sink", "suspect", "form", "chars", "prose", "titled", "above", "inside", "under", "text", "link", "words")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.score, self.sink, self.suspect, self.form = 0.0, False, False, False
        # Of the text below: its length, that of its long blocks, whether an h1 or an article holds some of it.
        self.chars, self.prose, self.titled, self.above = 0, 0, False, False
        # Of the elements above: whether one is an article, and marks of headings and paragraphs, this one included.
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.under = (parent.under if parent else 0) | _UNDER.get(tag, 0)
        self.text, self.link, self.words = "", 0, 0


def _describe(node: _Node, attrs: str) -> None:
    """Evidence from the tag and its attributes."""
    if node.tag in ("article", "main"):
        node.score += 2.5
    node.form = node.tag == "form"
    node.suspect = node.tag in _SINK and not node.form
    header = node.tag == "header" and not node.inside
    headed = False
    for name, a, b, c in _ATTRIBUTE.findall(attrs) if attrs.strip() else ():
        value = a or b or c
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value.lower() == "true") or (name.lower() == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            node.sink = True
        elif name.lower() != "style":
            named = {x.lower() for x in _NAME.findall(value)}
            bad = named & _BAD
            headed = headed or bool(named & _HEADED)
            if "header" in bad and named & _HEADED:
                bad = bad - {"header"}
            if bad and node.tag not in ("article", "main", "body", "html", "h1"):
                node.form = node.form or "form" in bad
                node.suspect = node.suspect or bad != {"form"}
            if named & _GOOD:
                node.score += 1.5
    node.suspect = node.suspect or (header and not headed)


def read(html: str) -> list[_Node]:
    """The blocks of a page, in order; parents lead to their elements."""
    now = root = _Node("html", None)
    blocks: list[_Node] = []
    parts: list[str] = []
    linked = at = links = 0
    opened = Counter()

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            owner = now
            while owner.tag in _INLINE:  # what was said before it
                owner = owner.parent
            block = _Node("#text", owner)
            block.text, block.link = text, min(linked, len(text))
            block.words = max(text.count(" ") + 1, 0 if text.isascii() else len(_UNSPACED.findall(text)) // 3)
            blocks.append(block)
        parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and now.tag in _INLINE:
            parts.append(" ")
        elif raw:
            raw = unescape(raw)
            parts.append(raw)
            if links:
                linked += len(" ".join(raw.split()))

    def close(tags: frozenset | set, scope: frozenset = frozenset()) -> None:
        """Back to the parent of the nearest open element of ``tags``, if it is in scope."""
        nonlocal now
        if not any(opened[x] for x in tags):
            return
        seek = now
        while seek is not root and seek.tag not in tags:
            if seek.tag in scope:
                return
            seek = seek.parent
        if seek is not root:
            while now is not seek.parent:
                opened[now.tag] -= 1
                now = now.parent

    unended: set[str] = set()
    while found := _TOKEN.search(html, at):
        say(html[at : found.start()])
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        ends = bool(found["end"] or found["end2"])
        if tag in _RAW and not ends and not (tag == "svg" and _SELF_CLOSED.search(found["attrs"] or "")):
            end = None if tag in unended else _RAW[tag].search(html, at)
            if end:
                at = end.end()
                continue
            unended.add(tag)
            if tag in _ENDLESS:
                at = len(html)
                break
        if tag == "a":
            links = 0 if ends else 1
            parts.append("")
        elif tag == "br":
            parts.append(" ")
        elif tag in _BLOCK or tag in _SINK or tag in _INLINE:
            if tag in _BLOCK:
                flush()
                if now.tag == "label":  # one that nothing has ended
                    close({"label"})
                links = 0
            if ends:
                close({tag})
            else:
                if tag in _BLOCK:
                    close({"p", "h1", "h2", "h3", "h4", "h5", "h6"} if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else {"p"}, _SCOPE | {"li", "td", "th", "blockquote"})
                    if tag in _CLOSES:
                        close(_CLOSES[tag], _SCOPE if tag in ("li", "dt", "dd", "option") else frozenset({"table"}))
                if tag not in _VOID:
                    now = _Node(tag, now)
                    opened[tag] += 1
                    _describe(now, found["attrs"] or "")
    say(html[at:])
    flush()
    return blocks


def _judge(blocks: list[_Node]) -> None:
    """Evidence of each block; suspect elements become sinks unless they hold most of the page or its article."""
    elements, seen = [], set()
    for b in blocks:
        b.parent.chars += len(b.text)
        b.parent.titled = b.parent.titled or b.parent.tag == "h1"
        b.parent.prose += len(b.text) if b.words >= 15 and 2 * b.link < len(b.text) else 0
        up = b.parent
        while up and id(up) not in seen:
            seen.add(id(up))
            elements.append(up)
            up = up.parent
    elements.sort(key=lambda e: e.depth)
    for e in reversed(elements[1:]):
        up = e.parent
        up.chars, up.prose = up.chars + e.chars, up.prose + e.prose
        up.titled, up.above = up.titled or e.titled, up.above or e.above or e.tag in ("article", "main")
    total, prose = (elements[0].chars, elements[0].prose) if elements else (0, 0)
    for e in elements:
        holds = (e.above and e.tag not in ("article", "main")) or (e.titled and e.tag in ("form", "div", "section"))
        most = holds and e.chars > 0.3 * total
        e.sink = e.sink or (e.parent is not None and e.parent.sink) or (e.suspect and not most) or (e.form and not most and 2 * e.prose <= prose)
    for b in blocks:
        b.sink = b.parent.sink or bool(b.under & _TITLE)
        b.score = 1.1 * math.log1p(b.words) - 2.2 - 6.0 * b.link / len(b.text)
        if b.text.rstrip("\"'”’»)")[-1:] in ".!?…:;。！？":
            b.score += 1.0
        if b.under & _P:
            b.score += 0.7
        if b.under & _H1:
            b.score += 2.0
        elif b.under & _HEADING:
            b.score += 0.8
        if b.words < 40 and _PHRASES.search(b.text):
            b.score -= 0.5 if b.inside else 2.5


def max_flow(edges: list[dict[int, float]], source: int, sink: int) -> set[int]:
    """Saturate the residual graph ``edges`` (capacities by neighbour); the nodes the source still reaches.

    Blocking flows along breadth-first levels.
    """
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue and sink not in level:
            u = queue.popleft()
            for v, c in edges[u].items():
                if c > 1e-9 and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if sink not in level:
            return set(level)
        rest = {u: iter(list(edges[u])) for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                least = min(edges[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    edges[a][b] -= least
                    edges[b][a] = edges[b].get(a, 0.0) + least
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:], strict=False)) if edges[a][b] <= 1e-9)
                del path[cut + 1:]
                continue
            for v in rest[u]:
                if edges[u][v] > 1e-9 and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
            else:
                path.pop()
                if path:
                    level[u] = -1


def content(blocks: list[_Node]) -> list[_Node]:
    """The blocks on the source's side of the minimum cut."""
    _judge(blocks)
    source, sink, number = 0, 1, {}
    edges: list[dict[int, float]] = [{}, {}]

    def node(n: _Node) -> int:
        # All nodes that the markup gives away are one with the sink.
        if n.sink:
            return sink
        if id(n) not in number:
            number[id(n)] = len(edges)
            edges.append({})
            # Costs of either label; what both have in common never changes the cut.
            if n.score > 0:
                edges[source][number[id(n)]] = n.score * (1 if n.text else 0.5)
            else:
                edges[number[id(n)]][sink] = -n.score * (1 if n.text else 0.5)
        return number[id(n)]

    def tie(a: int, b: int, weight: float) -> None:
        if a != b and source not in (a, b):
            edges[a][b] = edges[a].get(b, 0.0) + weight
            edges[b][a] = edges[b].get(a, 0.0) + weight

    last = None
    for b in blocks:
        mine = node(b)
        if last is not None:
            x, y, apart = last.parent, b.parent, 0
            while x is not y:
                if x.depth >= y.depth:
                    x = x.parent
                else:
                    y = y.parent
                apart += 1
            tie(node(last), mine, SMOOTH * 0.7 ** max(0, apart - 2))
        last = b
        child = b
        while child.parent is not None and not b.sink:
            known = id(child.parent) in number
            tie(node(child), node(child.parent), PARENT if not child.text else 2 * PARENT)
            if known:
                break
            child = child.parent
    reached = max_flow(edges, source, sink)
    return [b for b in blocks if not b.sink and number[id(b)] in reached]


def main_text(html: str | None) -> str:
    return "\n".join(b.text for b in content(read(html))) if html else ""


def extract(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``text``, the main text of each page."""
    return map_texts(pages, html, keep, "text string", lambda: lambda found: ([main_text(x) for x in found],))
