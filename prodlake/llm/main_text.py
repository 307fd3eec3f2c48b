"""Main text of HTML pages by a maximum-scoring subsequence of words and tags.

A page is a sequence of tokens: words score positive, tags negative. Weights depend on the kind of tag and,
for words, on what they stand in (a link, a heading, a list item); they are log-odds learned from labelled
pages (main_text_pages.LABELLED), whose main content is marked. One linear scan finds the contiguous region
of largest sum; nothing but the scan places it. It is widened to the blocks that it touches.

Some elements are never content: those whose tag says so (scripts, styles, forms, menus, footers, asides,
hidden ones), and those whose class, id and role words the labelled pages show to mark what is not
the article: a logistic regression over the elements of these pages weighs each word beside those that it stands
with, and a word that no labelled page has weighs nothing. What an element holds counts too: one of links alone is left out
where its words speak against it at all, one of most of the page's words, marked content among them, only where they speak
strongly. Two pages are held out to measure this (HELD_OUT).

Blocks end at block-level tags. Inside a block character references are decoded, white space becomes one
blank and the ends are trimmed; blocks are joined by one blank. Nothing else is dropped or cut.

Defined cases: null and empty html, and pages without a word outside the excluded elements, give an
empty text; a page cut off anywhere, unclosed or misnested tags and stray angle brackets are read as far
as they go, in time linear in the page whatever its depth; a slash at the end of a tag closes nothing, as
in HTML; repeated rows give equal rows; a null page_id is returned as it is; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.llm.main_text_pages import LABELLED
from prodlake.llm.session import pieces

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Never content, whatever they hold.
SKIPPED = frozenset(
    "script style noscript template head title nav aside footer form button select textarea iframe svg canvas object embed audio video dialog menu".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements that end where the next of their name begins.
REPEATED = frozenset("p li option tr td th dt dd".split())
#: What speaks for an element before its class words are read: they weigh nothing unless labelled pages have them.
PRIOR = 1.0
#: Ridge of the weights of class words; weight of an element that holds content against one that does not.
RIDGE, HOLDS = 0.1, 1.0
#: Odds under which class words alone decide against an element, and from which they speak clearly for one.
STRONG, CLEAR = -2.0, 2.0
#: Elements whose text is not markup: only their own end tag ends them.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, value): kind is text, open or close; comments and declarations are left out."""
    at, n = 0, len(page)
    while at < n:
        m = _PART.search(page, at)
        if m is None:
            yield "text", "", page[at:]
            return
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        name = m[1]
        if name is None:
            if m[0].startswith("<![CDATA["):
                yield "text", "", m[0][9:].removesuffix("]]>")
            continue
        name = name.lower()
        if page[m.start() + 1] == "/":
            yield "close", name, ""
            continue
        yield "open", name, m[2]
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            yield "text", "", page[at : end.start() if end else n]
            yield "close", name, ""
            at = end.end() if end else n


def marking_words(attributes: str) -> tuple[list[str], bool]:
    """(words of class, id and role, whether the element is hidden)."""
    words: list[str] = []
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role"):
            words += [w.lower() for w in _WORD.findall(value)]
        elif key == "hidden" or key == "style" and _HIDDEN.search(value):
            return words, True
    return words, False


def _outside(name: str, attributes: str, within_article: bool, held: Held, k: int) -> bool:
    if name in SKIPPED or name == "header" and not within_article:
        return True
    if not attributes or name in ("body", "html"):
        return False
    words, hidden = marking_words(attributes)
    if hidden or not words:
        return hidden
    odds = mark(words)
    if odds < 0:  # a wrapper of most of the page that holds marked content needs stronger words
        return odds < STRONG or not held.wraps(k)
    return odds < PRIOR and held.only_links(k)


class Held:
    """What the element that token k opens holds, from its words so far and those before its end tag."""

    def __init__(self, seen: list[tuple[str, str, str]]):
        self.end = [len(seen)] * len(seen)
        self.words, self.links, self.marks = [0], [0], [0]
        waiting: dict[str, list[int]] = {}
        anchors = 0
        for k, (kind, name, value) in enumerate(seen):
            n = links = marks = 0
            if kind == "text":
                n = len(value.split())
                links = n if anchors > 0 else 0
            elif kind == "open":
                waiting.setdefault(name, []).append(k)
                anchors += name == "a"
                marks = int(name in ("article", "main", "h1") or bool(value) and mark(marking_words(value)[0]) > CLEAR)
            else:
                anchors = max(0, anchors - (name == "a"))
                if waiting.get(name):
                    self.end[waiting[name].pop()] = k
            self.words.append(self.words[-1] + n)
            self.links.append(self.links[-1] + links)
            self.marks.append(self.marks[-1] + marks)

    def wraps(self, k: int) -> bool:
        e = self.end[k]
        return 2 * (self.words[e] - self.words[k]) > self.words[-1] and self.marks[e] > self.marks[k + 1]

    def only_links(self, k: int) -> bool:
        e = self.end[k]
        return self.words[e] - self.words[k] == self.links[e] - self.links[k] > 0


def mark(words: list[str]) -> float:
    """Log-odds that an element with these class, id and role words holds content; an unknown word weighs nothing."""
    known = class_weights()
    return PRIOR + sum(known.get(w, 0.0) for w in set(words))


def fitted(rows: list[tuple[set[str], bool]]) -> dict[str, float]:
    """Weights of words by a logistic regression over elements, by Newton steps: what a word adds beside those it stands with."""
    words = sorted(set().union(*(w for w, _ in rows)))
    place = {w: k for k, w in enumerate(words)}
    x = np.zeros((len(rows), len(words)))
    for k, (w, _) in enumerate(rows):
        x[k, [place[v] for v in w]] = 1
    y = np.array([float(holds) for _, holds in rows])
    mass = np.where(y == 1, HOLDS, 1.0)
    weight = np.zeros(len(words))
    for _ in range(25):
        p = 1 / (1 + np.exp(-(PRIOR + x @ weight)))
        grad = x.T @ (mass * (p - y)) + RIDGE * weight
        curve = (x.T * (mass * p * (1 - p))) @ x + RIDGE * np.eye(len(words))
        weight = weight - np.linalg.solve(curve, grad)
    return dict(zip(words, weight.tolist(), strict=True))


def labelled_elements(pages: list[str]) -> list[tuple[set[str], bool]]:
    """(class, id and role words, whether it holds or lies in content) of every element of labelled pages that has such words."""
    out: list[tuple[set[str], bool]] = []
    for page in pages:
        within, stack = False, []
        for kind, name, value in tokens(page):
            if name in ("x-content", "x-out"):
                within = (kind == "open") == (name == "x-content")
                for e in stack if within else []:
                    e[2] = True
            elif kind == "open" and name not in VOID:
                stack.append([name, set(marking_words(value)[0]), within])
            elif kind == "close":
                while stack:
                    top, words, holds = stack.pop()
                    if words and top not in ("body", "html"):
                        out.append((words, holds))
                    if top == name:
                        break
    return out


Event = tuple[str, str, str, str, int]


def events(page: str) -> list[Event]:
    """(kind, name, text, kind of word, number of elements around it) outside the excluded elements."""
    out: list[Event] = []
    stack: list[tuple[str, bool]] = []
    count: dict[str, int] = {}  # open elements by name
    hidden = headings = 0

    def pop() -> str:
        nonlocal hidden, headings
        top, skip = stack.pop()
        count[top] -= 1
        headings -= top in HEADINGS
        shown = not hidden
        hidden -= skip
        if shown:
            out.append(("close", top, "", "", len(stack)))
        return top

    seen = list(tokens(page))
    held = Held(seen)
    for k, (kind, name, value) in enumerate(seen):
        if kind == "open":
            if name in REPEATED and stack and stack[-1][0] == name:
                pop()  # an open paragraph, item or cell ends where the next begins
            skip = _outside(name, value, bool(count.get("article") or count.get("main") or count.get("section")), held, k)
            if name not in VOID:
                stack.append((name, skip))
                count[name] = count.get(name, 0) + 1
                headings += name in HEADINGS
                hidden += skip
            if not hidden and not skip:
                out.append(("open", name, "", "", len(stack) - (name not in VOID)))
        elif kind == "close":
            if count.get(name):
                while pop() != name:
                    pass
            elif name in BLOCKS and not hidden:
                out.append(("close", name, "", "", len(stack)))
        elif not hidden:
            word = "link" if count.get("a") else "item" if count.get("li") else "heading" if headings else "word"
            out.append(("text", "", value, word, len(stack)))
    return out


def _kind(name: str) -> str:
    if name in ("p", "a", "li", "ul", "div", "td", "br", "span"):
        return name
    if name in HEADINGS:
        return "h"
    return "block" if name in BLOCKS else "inline"


@lru_cache(maxsize=1)
def _learned() -> tuple[dict[str, float], dict[str, float]]:
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for page in LABELLED:
        within, link, item, heading = False, 0, 0, 0
        for kind, name, value in tokens(page):
            if name in ("x-content", "x-out"):
                within = (kind == "open") == (name == "x-content")
                continue
            step = 1 if kind == "open" else -1
            if kind == "text":
                key, n = "w:" + ("link" if link else "item" if item else "heading" if heading else "word"), len(value.split())
            else:
                link, item, heading = link + step * (name == "a"), item + step * (name == "li"), heading + step * (name in HEADINGS)
                key, n = "t:" + _kind(name), 1
            (inside if within else outside)[key] += n
    total_in, total_out = inside.total(), outside.total()
    table = {}
    for key in {*inside, *outside}:
        odds = math.log((inside[key] + 0.5) / (total_in + 1)) - math.log((outside[key] + 0.5) / (total_out + 1))
        table[key] = max(0.1, odds) if key[0] == "w" else min(-0.1, odds)
    return table, fitted(labelled_elements(LABELLED))


def weights() -> dict[str, float]:
    """Log-odds of each kind of token inside and outside the marked content, words at least 0.1, tags at most -0.1."""
    return _learned()[0]


def class_weights() -> dict[str, float]:
    """Log-odds that an element holds content, by each word of class, id and role in the labelled pages."""
    return _learned()[1]


def gains(seen: list[Event]) -> list[float]:
    table = weights()
    return [len(e[2].split()) * table.get("w:" + e[3], 0.5) if e[0] == "text" else table.get("t:" + _kind(e[1]), -0.3) for e in seen]


def best_region(gain: list[float]) -> tuple[int, int]:
    """First and last place of the contiguous run of largest sum, the first of equals; (0, -1) if none is above 0."""
    best, first, last = 0.0, 0, -1
    total, start = 0.0, 0
    for k, g in enumerate(gain):
        if total <= 0:
            total, start = 0.0, k
        total += g
        if total > best:
            best, first, last = total, start, k
    return first, last


def widened(seen: list[Event], first: int, last: int) -> tuple[int, int]:
    """The region with the blocks before and behind it, more text than links, of the innermost element that holds it.

    So that a last short paragraph does not get lost to the tags before it. Nothing is added if no element below
    the body holds the region.
    """
    depth = min(e[4] for e in seen[first : last + 1])
    begin, end = first - 1, last + 1
    while begin >= 0 and not (seen[begin][0] == "open" and seen[begin][4] < depth):
        begin -= 1
    if begin < 0 or seen[begin][1] in ("body", "html"):
        return first, last
    while end < len(seen) and seen[end][4] >= depth:
        end += 1
    for places in (range(begin + 1, first), range(last + 1, end)):
        plain = links = 0
        block: list[int] = []
        for k in (*places, -1):
            if k >= 0 and not _breaks(seen[k]):
                if seen[k][0] == "text" and seen[k][2].strip():
                    n = len(seen[k][2].split())
                    plain, links = plain + n * (seen[k][3] != "link"), links + n * (seen[k][3] == "link")
                    block.append(k)
                continue
            if plain > links:
                first, last = min(first, block[0]), max(last, block[-1])
            plain = links = 0
            block = []
    return first, last


def main_text(page: str | None) -> str:
    if not page:
        return ""
    seen = events(page)
    first, last = best_region(gains(seen))
    if last < first:
        return ""
    first, last = widened(seen, first, last)
    while first > 0 and not _breaks(seen[first - 1]):
        first -= 1
    while last + 1 < len(seen) and not _breaks(seen[last + 1]):
        last += 1
    out: list[str] = []
    block: list[str] = []
    for kind, name, value, _, _ in seen[first : last + 1]:
        if kind == "text":
            block.append(value)
        elif name in BLOCKS and block:
            out.append(" ".join(html.unescape("".join(block)).split()))
            block = []
    out.append(" ".join(html.unescape("".join(block)).split()))
    return " ".join(b for b in out if b)


def _breaks(event: Event) -> bool:
    return event[0] != "text" and event[1] in BLOCKS


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 2):
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """Rows (page_id, url, text, n_chars)."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
