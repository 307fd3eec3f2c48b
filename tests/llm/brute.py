"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs: dict[int, str], n: int, percent: int) -> dict[int, int]:
    sets = {i: shingles(t, n) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted((i for i in docs if sets[i]), key=lambda i: len(sets[i]))
    for k, b in enumerate(order):
        for a in order[:k]:
            if 100 * len(sets[a]) >= percent * len(sets[b]):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in docs}


def repeats(docs: dict[int, str], length: int) -> tuple[dict[int, set[int]], dict[int, set[int]]]:
    """Word places inside a repeat, and inside a later copy, by document."""
    low, high = {}, {}
    split = {i: words(t) for i, t in docs.items()}
    for i, w in split.items():
        for k in range(len(w) - length + 1):
            g = tuple(w[k : k + length])
            low[g], high[g] = min(low.get(g, i), i), max(high.get(g, i), i)
    every, later = defaultdict(set), defaultdict(set)
    for i, w in split.items():
        for k in range(len(w) - length + 1):
            g = tuple(w[k : k + length])
            if low[g] < high[g]:
                every[i] |= set(range(k, k + length))
            if low[g] < i:
                later[i] |= set(range(k, k + length))
    return dict(every), dict(later)


def cut(text: str, places: set[int]) -> str:
    """The text without runs of words at these places, and what stands between them."""
    spans = [m.span() for m in WORD.finditer(text)]
    out, at, k = [], 0, 0
    while k < len(spans):
        if k in places:
            end = k
            while end + 1 in places:
                end += 1
            out.append(text[at : spans[k][0]])
            at, k = spans[end][1], end
        k += 1
    return "".join([*out, text[at:]])


def deal(children: dict, budget: float) -> dict:
    """children: name -> (capacity, weight)."""
    left, out = dict(children), {}
    while left:
        level = budget / sum(w for _, w in left.values())
        full = [k for k, (c, w) in left.items() if c <= level * w]
        if not full:
            return out | {k: level * w for k, (_, w) in left.items()}
        for k in full:
            out[k] = left.pop(k)[0]
            budget -= out[k]
    return out
