"""Main text of web pages by a tree-structured graphical model.

Every element and every text block of a page is a binary variable: content or not. A node's own potential is a
weighted sum of its features (tag, class and id words, length, links, punctuation); each edge between a parent and its child
has a table of potentials over their two states. On a tree, sum-product message passing is exact: one
sweep from the leaves to the root and one back give every node's marginal. Blocks whose marginal is above 0.5 are the
page's text. The weights and tables are fitted by gradient ascent on the likelihood of labelled pages, whose
gradient is the features' counts less their expectations under the same marginals.

The labelled pages are written by rule (``labelled_pages``): the usual parts of web pages with the usual element
names and class words, in random order and random invented text. They hold nothing of any table.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh
from .dom import Node, parse

FIT_PAGES, FIT_STEPS, RIDGE = 500, 150, 1e-4
#: Nodes whose messages are passed at once.
FOREST_NODES = 200_000
_STOPS = ".!?;:,。！？"


def _size_bin(n: float) -> int:
    return min(12, int(n).bit_length())


def node_features(nodes: Sequence[Node]) -> list[list[str]]:
    """The names of each node's features; none depends on which words a text holds."""
    n = len(nodes)
    chars, linked, blocks, words, stops = ([0] * n for _ in range(5))
    for i in range(n - 1, -1, -1):
        d = nodes[i]
        if d.tag == "#":
            chars[i], linked[i], blocks[i], words[i] = len(d.text), d.linked, 1, d.text.count(" ") + 1
            stops[i] = sum(d.text.count(s) for s in _STOPS)
        if d.parent >= 0:
            for part in (chars, linked, blocks, words, stops):
                part[d.parent] += part[i]
    out = []
    for i, d in enumerate(nodes):
        up = nodes[d.parent] if d.parent >= 0 else None
        kind = "block" if d.tag == "#" else "element"
        share = int(4 * linked[i] / chars[i] + 0.99) if chars[i] else 0
        found = [f"{kind}", f"{kind} links {min(4, share)}", f"{kind} words {_size_bin(words[i] / max(1, blocks[i]))}",
                 f"{kind} stops {_size_bin(40 * stops[i] / max(1, words[i]))}"]
        if kind == "element":
            found.append(f"tag {d.tag}")
            found.append(f"blocks {_size_bin(blocks[i])}")
            found.extend({f"hint {h.rstrip('s')}" for h in d.hints})
        if up is not None:
            found.append(f"{kind} in {up.tag}")
            found.extend({f"{kind} in hint {h.rstrip('s')}" for h in up.hints})
        out.append(found)
    return out


class Forest:
    """The nodes of many pages as arrays."""

    def __init__(self, pages: Sequence[Sequence[Node]], place: dict[str, int]):
        parent, depth, leaf, at, ids = [], [], [], [0], []
        for nodes in pages:
            base = len(parent)
            parent.extend(d.parent + base if d.parent >= 0 else -1 for d in nodes)
            depth.extend(d.depth for d in nodes)
            leaf.extend(d.tag == "#" for d in nodes)
            for found in node_features(nodes):
                ids.extend(place[f] for f in found if f in place)
                at.append(len(ids))
        self.parent, self.leaf = np.array(parent, np.int64), np.array(leaf, bool)
        self.row = np.repeat(np.arange(len(parent)), np.diff(at))
        self.ids = np.array(ids, np.int64)
        level = np.array(depth, np.int64)
        order = np.argsort(level, kind="stable")
        self.levels = np.split(order, np.searchsorted(level[order], np.arange(1, level.max(initial=0) + 1)))
        #: Of each level but the first: its nodes, their distinct parents, and which of these each node has.
        self.steps = [(nodes, *np.unique(self.parent[nodes], return_inverse=True)) for nodes in self.levels[1:]]

    def own(self, weights: np.ndarray) -> np.ndarray:
        """The log potential of content for every node."""
        return np.bincount(self.row, weights[self.ids], len(self.parent))

    def marginals(self, own: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum-product over every tree: P(node is content), and P(parent state, child state) of each node's upper edge.

        ``edges`` has log potentials [child is a block, parent state, child state]."""
        n = len(own)
        belief = np.zeros((n, 2))
        belief[:, 1] = own
        table = edges[self.leaf.astype(np.int64)]
        up = np.zeros((n, 2))
        for nodes, low, first in reversed(self.steps):
            joint = belief[nodes, None, :] + table[nodes]
            up[nodes] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            for s in (0, 1):
                belief[low, s] += np.bincount(first, up[nodes, s], len(low))
        pairs = np.zeros((n, 2, 2))
        for nodes, _, _ in self.steps:
            above = belief[self.parent[nodes]] - up[nodes]
            joint = above[:, :, None] + table[nodes] + belief[nodes, None, :]
            down = np.logaddexp(joint[:, 0, :], joint[:, 1, :])
            joint -= np.logaddexp(down[:, 0], down[:, 1])[:, None, None]
            pairs[nodes] = np.exp(joint)
            belief[nodes] = down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500))), pairs


class TreeModel:
    """Feature weights and edge potentials."""

    def __init__(self, place: dict[str, int], weights: np.ndarray, edges: np.ndarray):
        self.place, self.weights, self.edges = place, weights, edges

    def content(self, pages: Sequence[Sequence[Node]]) -> list[np.ndarray]:
        """Every node's marginal, page by page."""
        forest = Forest(pages, self.place)
        p, _ = forest.marginals(forest.own(self.weights), self.edges)
        return np.split(p, np.cumsum([len(n) for n in pages])[:-1])

    def texts(self, pages: Sequence[str | None], limit: int = FOREST_NODES) -> Iterator[str]:
        """The main text of each page."""
        held, size = [], 0

        def flush() -> Iterator[str]:
            for nodes, p in zip(held, self.content(held)):
                yield "\n\n".join(d.text for d, x in zip(nodes, p) if d.tag == "#" and x > 0.5)
            held.clear()
        for page in pages:
            held.append(parse(page))
            size += len(held[-1])
            if size >= limit:
                yield from flush()
                size = 0
        if held:
            yield from flush()


def _labels(nodes: Sequence[Node], main: str) -> np.ndarray:
    """A block is content if the main text has it (each as often as it does); an element, if most of its text is."""
    left: dict[str, int] = {}
    for b in main.split("\n\n"):
        left[b] = left.get(b, 0) + 1
    good, every = [0] * len(nodes), [0] * len(nodes)
    for i, d in enumerate(nodes):
        if d.tag == "#":
            every[i] = len(d.text)
            if left.get(d.text, 0):
                left[d.text] -= 1
                good[i] = len(d.text)
    for i in range(len(nodes) - 1, 0, -1):
        good[nodes[i].parent] += good[i]
        every[nodes[i].parent] += every[i]
    return np.array([2 * g > e for g, e in zip(good, every)], float)


def train_extractor(labelled: Iterable[tuple[str, str]], steps: int = FIT_STEPS, ridge: float = RIDGE, least: int = 5) -> TreeModel:
    """Fit to labelled pages: (html, main text with its blocks joined by an empty line). The pages are held in
    memory; features that fewer than ``least`` nodes have are left out. The same pages give the same model."""
    pages, truth = [], []
    for page, main in labelled:
        pages.append(parse(page))
        truth.append(_labels(pages[-1], main))
    seen: dict[str, int] = {}
    for nodes in pages:
        for found in node_features(nodes):
            for f in found:
                seen[f] = seen.get(f, 0) + 1
    place = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    weights, edges = np.zeros(len(place)), np.zeros((2, 2, 2))
    if not pages:
        return TreeModel(place, weights, edges)
    forest, y = Forest(pages, place), np.concatenate(truth)
    state = y.astype(np.int64)
    inner = np.flatnonzero(forest.parent >= 0)
    kind = forest.leaf[inner].astype(np.int64)
    counted = np.zeros((2, 2, 2))
    np.add.at(counted, (kind, state[forest.parent[inner]], state[inner]), 1)
    m = [np.zeros_like(weights), np.zeros_like(edges)]
    v = [np.zeros_like(weights), np.zeros_like(edges)]
    n = len(y)
    for t in range(1, steps + 1):
        p, pairs = forest.marginals(forest.own(weights), edges)
        expected = np.stack([pairs[inner][kind == k].sum(axis=0) for k in (0, 1)])
        gradient = [np.bincount(forest.ids, (y - p)[forest.row], len(weights)) / n - ridge * weights,
                    (counted - expected) / n - ridge * edges]
        rate = 0.1 * (1 - t / (steps + 1))
        for x, g, a, b in zip((weights, edges), gradient, m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x += rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    return TreeModel(place, weights, edges)


def _rule(kind: str) -> list[str]:
    """Start tags of one kind of page part, from element names and class words in common use."""
    tags, words = _PARTS[kind]
    made = [f'<div {a}="{w}">' for w in words for a in ("class", "id")]
    made += [f'<{t} class="{w}">' for t in ("section", "ul" if kind == "menu" else "div") for w in words[:4]]
    return made + [f"<{t}>" for t in tags for _ in range(len(made) // max(1, 2 * len(tags)))]


#: Element names and class or id words that pages use for their parts.
_PARTS = {
    "header": (["header"], ["header", "site-header", "masthead", "topbar", "branding", "page-head"]),
    "menu": (["nav"], ["menu", "nav", "navigation", "navbar", "breadcrumbs", "main-menu", "site-nav", "tabs", "pagination", "toc"]),
    "notice": (["dialog"], ["notice", "cookie-notice", "cookie-banner", "consent", "alert", "newsletter", "popup", "modal", "paywall", "disclaimer"]),
    "advert": (["ins"], ["ad", "ads", "advert", "advertisement", "banner-ad", "sponsored", "promo", "promotion", "ad-slot", "commercial"]),
    "sidebar": (["aside"], ["sidebar", "side", "widget", "related", "related-posts", "more-stories", "trending", "right-column", "teaser"]),
    "social": ([], ["share", "social", "share-buttons", "tags", "tools", "follow"]),
    "meta": ([], ["byline", "meta", "author-box", "post-meta", "dateline", "published"]),
    "comments": ([], ["comments", "comment-list", "reader-comments", "discussion", "replies", "responses", "feedback", "comment"]),
    "form": (["form"], ["form", "search", "search-form", "login", "subscribe", "signup", "contact-form"]),
    "footer": (["footer"], ["footer", "site-footer", "copyright", "colophon", "bottom", "legal", "credits"]),
    "content": (["article", "main"], ["content", "article", "post", "entry", "entry-content", "article-body", "story", "story-body", "main",
                                      "main-content", "post-content", "text", "body-text"]),
}


class _Writer:
    """One page with its main text; ``say`` invents words."""

    def __init__(self, rng: random.Random):
        self.rng, self.parts, self.main = rng, [], []
        self.sloppy = rng.random() < 0.3

    def say(self, low: int, high: int, sentences: bool = True) -> str:
        r = self.rng
        out = ["".join(r.choice(("ba", "ko", "li", "mer", "tan", "os", "ver", "in", "dé", "u", "sta")) for _ in range(r.randint(1, 4)))
               for _ in range(r.randint(low, high))]
        if sentences:
            for i in range(r.randint(4, 14), len(out), r.randint(5, 16)):
                out[i] += r.choice((".", ".", ".", ",", "?", "!"))
            out[0] = out[0].capitalize()
            out[-1] = out[-1].rstrip(".,?!") + "."
        return " ".join(out)

    def open(self, kind: str) -> str:
        start = self.rng.choice(_STARTS[kind])
        self.parts.append(start)
        return f"</{start[1:].split()[0].rstrip('>')}>"

    def block(self, tag: str, text: str, main: bool, inner: str | None = None) -> None:
        end = "" if self.sloppy and tag in ("p", "li") and self.rng.random() < 0.5 else f"</{tag}>"
        self.parts.append(f"<{tag}>{inner or text}{end}")
        if main:
            self.main.append(text)

    def links(self, n: int, tag: str = "li") -> None:
        for _ in range(n):
            t = self.say(1, 4, False)
            self.block(tag, t, False, f'<a href="/{len(t)}">{t}</a>')

    def paragraph(self, main: bool, tag: str = "p") -> None:
        prose = self.rng.random() > 0.1
        text = self.say(1, 6, prose) if self.rng.random() < 0.25 else self.say(5, self.rng.choice((90, 90, 400)), prose)
        words, inner = text.split(" "), None
        if self.rng.random() < 0.3:
            i = self.rng.randrange(len(words))
            mark = self.rng.choice(('<a href="#">{}</a>', "<b>{}</b>", "<em>{}</em>", "<b>{}" if self.sloppy and tag == "p" else "<i>{}</i>"))
            inner = " ".join(mark.format(w) if j == i else w for j, w in enumerate(words))
        self.block(tag, text, main, inner)

    def part(self, kind: str) -> None:
        r, end = self.rng, self.open(kind)
        if r.random() < 0.35:                             # bare text, as short or long as any paragraph
            self.parts.append(self.say(1, r.choice((5, 15, 40, 90))))
        elif kind in ("menu", "social", "sidebar"):
            if r.random() < 0.3:
                self.block("h3", self.say(1, 3, False), False)
            self.parts.append("<ul>" if (listed := r.random() < 0.8) else "")
            self.links(r.randint(2, 9), "li" if listed else r.choice(("span", "div")))
            self.parts.append("</ul>" if listed else "")
            if kind == "sidebar" and r.random() < 0.4:
                self.paragraph(False)
        elif kind == "comments":
            if r.random() < 0.6:
                self.block("h3", self.say(1, 3, False), False)
            for _ in range(r.randint(1, 5)):
                inside = r.choice(("li", "div", "article", "p"))
                if inside == "p":
                    self.paragraph(False)
                    continue
                self.parts.append(f'<{inside} class="{r.choice(("comment", "reply", "comment-body", "response"))}">')
                self.block("span", self.say(1, 2, False), False)
                self.paragraph(False)
                self.parts.append(f"</{inside}>")
        elif kind == "form":
            for _ in range(r.randint(1, 3)):
                self.parts.append(f"<label>{self.say(1, 4, False)}</label><input name=x><select><option>{self.say(1, 2, False)}</select>")
            self.parts.append(f"<button>{self.say(1, 2, False)}</button>")
        elif kind == "header":
            self.block(r.choice(("div", "h2", "p")), self.say(1, 5, False), False)
            if r.random() < 0.5:
                self.part("menu")
        elif kind == "footer":
            self.block(r.choice(("p", "div", "span")), self.say(2, 25), False)
            if r.random() < 0.4:
                self.links(r.randint(2, 5))
        elif kind == "meta":
            self.block(r.choice(("span", "p", "div")), self.say(2, 6, False), False)
        else:                                             # notices, adverts
            for _ in range(r.randint(1, 2)):
                self.parts.append(self.say(2, 30)) if r.random() < 0.5 else self.paragraph(False)
            if r.random() < 0.3:
                self.links(1, "span")
        self.parts.append(end)

    def article(self) -> None:
        r, ends = self.rng, [self.open("content")]
        if r.random() < 0.35:
            ends.append(self.open("content"))
        if r.random() < 0.75:
            self.block("h1", self.say(2, 12, r.random() < 0.5), True)
        noise = [k for k in ("meta", "advert", "social", "sidebar", "notice", "comments", "form") if r.random() < 0.08]
        n = r.randint(1, 4) if r.random() < 0.3 else r.randint(3, 25)
        for i in range(n):
            x = r.random()
            if noise and r.random() < 0.3:
                self.part(noise.pop())
            if x < 0.08:
                self.block("h2", self.say(1, 7, False), True)
            elif x < 0.13:
                self.parts.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    self.paragraph(True, "li")
                self.parts.append("</ul>")
            elif x < 0.17:
                self.block(r.choice(("blockquote", "pre", "div")), self.say(4, 40), True)
            elif x < 0.19:
                self.parts.append("<table><tr>")
                for _ in range(r.randint(2, 6)):
                    self.block("td", self.say(1, 3, False), True)
                self.parts.append("</tr></table>")
            else:
                self.paragraph(True)
        self.parts.extend(reversed(ends))


_STARTS = {kind: _rule(kind) for kind in _PARTS}


def labelled_pages(n: int = FIT_PAGES, seed: int = 1) -> Iterator[tuple[str, str]]:
    """``n`` pages (html, main text) by rule."""
    for i in range(n):
        w = _Writer(random.Random(f"{seed} {i}"))
        r = w.rng
        before = [k for k in ("header", "menu", "notice", "advert", "form", "sidebar") if r.random() < 0.4]
        after = [k for k in ("sidebar", "comments", "advert", "social", "form", "menu", "notice") if r.random() < 0.35]
        r.shuffle(before)
        r.shuffle(after)
        wrap = r.choice(("", "", '<div id="page">', '<div class="container"><div class="row">'))
        w.parts.append(f"<!doctype html><html><head><title>{w.say(2, 6)}</title></head><body>{wrap}")
        for k in before:
            w.part(k)
        w.article()
        for k in after:
            w.part(k)
        if r.random() < 0.7:
            w.part("footer")
        w.parts.append("</div>" * wrap.count("<div") + ("" if w.sloppy else "</body></html>"))
        yield "".join(w.parts), "\n\n".join(w.main)


@functools.lru_cache(maxsize=1)
def default_model() -> TreeModel:
    return train_extractor(labelled_pages())


def extract_text(pages: DataFrame, model: TreeModel | None = None, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All columns of ``pages`` plus ``out_col``: the blocks of the main text, joined by an empty line.

    Null and empty pages give an empty text, as do pages without content; repeated rows give the same
    text; an empty table gives no rows. If ``pages`` has a column of the name ``out_col`` the new one gets underscores."""
    model = model or default_model()
    name = fresh(out_col, pages.columns)

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield pd.Series(list(model.texts(p.tolist())), dtype="object")
    return pages.withColumn(name, run(F.col(html_col).cast("string")))
