"""A small, forgiving HTML reader: tags, text blocks and their nesting.

Every step moves forward in the text, so long and broken pages take linear time.
"""

from __future__ import annotations

import html
import re

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)((?:[^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?)?)*+)>")
_ATTR = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Elements whose content is no text of the page: skipped up to their end tag.
SKIPPED = frozenset("script style title textarea iframe noscript noembed noframes xmp template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that run inside a block of text; all others begin a block of their own.
_INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby
                    s samp small span strike strong sub sup time tt u var wbr""".split())
_CLOSES_P = frozenset("""address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form
                      h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split())
#: A start tag ends an open element of these names, unless one of the second kind lies between.
_ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
         "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
         "tbody": (("thead", "tbody", "tr"), ("table",)), "option": (("option",), ("select",))}


class Node:
    """An element, or (``tag`` '#') a block of text."""

    __slots__ = ("tag", "hints", "parent", "depth", "text", "linked")

    def __init__(self, tag: str, hints: tuple[str, ...], parent: int, depth: int):
        self.tag, self.hints, self.parent, self.depth = tag, hints, parent, depth
        self.text, self.linked = "", 0


def _hints(attributes: str) -> tuple[str, ...]:
    found = []
    for m in _ATTR.finditer(attributes):
        found.extend(_WORD.findall(_CAMEL.sub(" ", m[2] or m[3] or m[4] or "").lower()))
    return tuple(found[:40])


def _skip(page: str, name: str, at: int, ends: dict[str, re.Pattern]) -> int:
    if name not in ends:
        ends[name] = re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I)
    m = ends[name].search(page, at)
    return m.end() if m else len(page)


def parse(page: str | None) -> list[Node]:
    """The elements and text blocks in page order, each after its parent (an index; the root's is -1).

    Comments, declarations and skipped elements give nothing. Inline elements give no node: their text
    belongs to the block around them, and ``linked`` counts its characters inside links. White space in a
    block becomes one space. Blocks without text are left out."""
    page = page or ""
    nodes = [Node("html", (), -1, 0)]
    stack: list[tuple[str, int]] = [("html", 0)]         # open elements; inline ones share their block's node
    counts: dict[str, int] = {"html": 1}
    pieces: list[tuple[str, bool]] = []
    ends: dict[str, re.Pattern] = {}

    def close_block() -> None:
        words = " ".join("".join(p for p, _ in pieces).split())
        if words:
            parent = stack[-1][1]
            b = Node("#", (), parent, nodes[parent].depth + 1)
            b.text = words
            b.linked = sum(len("".join(p.split())) for p, inside in pieces if inside)
            nodes.append(b)
        pieces.clear()

    def pop() -> None:
        name, _ = stack[-1]
        if name not in _INLINE:
            close_block()
        stack.pop()
        counts[name] -= 1

    def pop_to(names: tuple[str, ...], barriers: tuple[str, ...]) -> None:
        """End the innermost open element of ``names`` and what is open inside it; stop at a barrier."""
        if not any(counts.get(n) for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in barriers:
                return
            if stack[i][0] in names:
                while len(stack) > i:
                    pop()
                return

    at, size = 0, len(page)
    while at < size:
        low = page.find("<", at)
        if low < 0:
            low = size
        if low > at:
            pieces.append((html.unescape(page[at:low]), bool(counts.get("a"))))
        if low == size:
            break
        m = _TAG.match(page, low)
        if not m:
            if page.startswith("<!--", low):
                end = page.find("-->", low + 4)
                at = end + 3 if end >= 0 else size
            elif page.startswith(("<!", "<?", "</"), low):
                end = page.find(">", low)
                at = end + 1 if end >= 0 else size
            elif low + 1 < size and page[low + 1].isascii() and page[low + 1].isalpha():
                at = size                                 # a tag that the page's end cuts off
            else:
                pieces.append(("<", bool(counts.get("a"))))
                at = low + 1
            continue
        at = m.end()
        name = m[1].lower()
        if page[low + 1] == "/":
            if name == "br":
                pieces.append((" ", False))
            elif name != "html":
                pop_to((name,), () if name in ("body", "article", "main", "section", "table") else ("table",) if name in ("p", *_INLINE) else ())
            continue
        if name in SKIPPED:
            at = _skip(page, name, at, ends)
            pieces.append((" ", False))
            continue
        if name in _INLINE:
            if name in _VOID:
                pieces.append((" ", False))
            else:
                if name == "a":
                    pop_to(("a",), ("table",))
                stack.append((name, stack[-1][1]))
                counts[name] = counts.get(name, 0) + 1
            continue
        if name in ("html", "head", "body") and counts.get("body"):
            continue
        if name == "body":
            pop_to(("head",), ())
        if name in _CLOSES_P:
            pop_to(("p",), ("table", "button"))
        if name in _ENDS:
            pop_to(*_ENDS[name])
        close_block()
        if name in _VOID:
            continue
        parent = stack[-1][1]
        nodes.append(Node(name, _hints(m[2]), parent, nodes[parent].depth + 1))
        stack.append((name, len(nodes) - 1))
        counts[name] = counts.get(name, 0) + 1
    while stack:
        pop()
    return nodes
