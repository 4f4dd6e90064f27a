"""Plain single-machine versions of the operators, written for clarity: every pair, every window."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash


def lower_ascii(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def exact(rows):
    """rows: (id, text) -> {index: (keep_id, group_size, kept, sha)}; ties by position."""
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, n))
    out = {}
    for body, g in groups.items():
        g.sort()
        for j, (_, _, _, n) in enumerate(g):
            out[n] = (rows[g[0][3]][0], len(g), j == 0, sha(body))
    return out


def fingerprint(t):
    w = words(lower_ascii(t or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def connected(nodes, linked):
    """Root (smallest index) of every node; ``linked`` is asked for every pair."""
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(nodes)):
        for j in range(i):
            if linked(nodes[i], nodes[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(nodes))]


def repeats(texts, length):
    """Covered flags per byte of each text."""
    seen = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags = [False] * len(t)
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                flags[s:s + length] = [True] * length
        out.append(flags)
    return out


def contamination(texts, items, window=13):
    """Per text: (n_words, n_hit, sorted item ids)."""
    def bench_words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(t or ""))
    wins = defaultdict(set)
    for i, t in items:
        w = bench_words(t)
        n = min(len(w), window)
        for s in range(len(w) - n + 1) if n else ():
            wins[tuple(w[s:s + n])].add("null" if i is None else str(i))
    out = []
    for t in texts:
        w = bench_words(t)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if ids := wins.get(tuple(w[s:s + n])):
                    hit |= set(range(s, s + n))
                    found |= ids
        out.append((len(w), len(hit), sorted(found)))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, repeats=2.0):
    """sizes: {source: words}; resharing the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if per * weight[s] > repeats * sizes[s]}
        if not over:
            out |= {s: per * weight[s] for s in open_}
            break
        for s in over:
            out[s] = repeats * sizes[s]
            left -= out[s]
        open_ -= over
    return out
