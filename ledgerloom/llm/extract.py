"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A linear classifier over the form of a block (links, length, punctuation, kind of
element) gives log-odds of content, within bounds; the elements around it add the costs of their kind and names. Together
they are the capacities to the two terminals. Blocks next to each other and blocks under one parent are joined by edges,
stronger the closer their elements are and on the same scale, so that the neighbours decide what a block alone leaves
open: a short line between paragraphs, a sentence in a menu. The minimum cut of that graph labels the blocks; the text of
the content side is joined in page order.

The classifier is learned from the pages themselves: a bounded sample of those that mark their main content shows what
its blocks look like. It starts from fixed weights and stays near them where there is little to learn from (no rows, no
such page). The choice of the sample goes by a hash of the rows; repeated rows count once in it.

Blocks that outweigh all their edges are on their own side in every minimum cut and are settled first; maximum flow
runs over what is left. Of equally cheap cuts the one with the fewest content blocks among the unsettled is taken; equal
rows get equal texts. NULL and empty html give the empty text, empty tables no rows. Tags cut off by the end of the page
are markup. A column that is called like the new one is replaced. Elements are held by a number and their parent's, so
memory is linear in the page, however deep it is.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, deque
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: kinds of elements
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("script style title template noscript textarea svg math iframe object canvas audio video".split())
SIDE_TAGS = frozenset("nav footer aside form dialog menu button select".split())
MAIN_TAGS = frozenset("article main".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "banner alert popup modal overlay newsletter subscribe subscription signup login paywall sidebar widget related recommended "
    "recommendations trending popular share sharing social toolbar breadcrumb breadcrumbs pagination pager nav navbar navigation menu "
    "footer header masthead comment comments disqus replies respond responses discussion".split()
)
TALK_WORDS = frozenset("comment comments disqus reply replies respond responses".split())
#: A name with one of these tells what a page or wrapper has, not what it is: has-sidebar, page-with-comments.
LAYOUT_WORDS = frozenset("has with no without layout".split())
#: So does one of these beside a word for content: content-sidebar-wrap.
WRAP_WORDS = frozenset("wrap wrapper container".split())
MAIN_WORDS = frozenset("article content main post entry story body text".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)|</?\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
ATTRIBUTES = frozenset("class id role hidden aria-hidden style itemprop".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SPACE = re.compile(r"\s+")

#: Costs: of being under an element that is no content, under one that holds content, outside it where a page has one.
SIDE, MAIN, OUTSIDE = 10.5, 3.5, 4.0
#: Costs of a name that sounds like boilerplate, of one that sounds like readers' comments, and most that the first ones add up to.
NAMED, TALK, MOST_NAMED = 6.5, 9.0, 6.9
#: Edges: to the next block (over one more than the steps between their elements), to the next block under the same parent.
NEXT, SIBLING = 3.0, 0.6
#: Weights that the classifier of a block's form starts from: always, share of letters in links, length, end of a sentence,
#: heading or paragraph, item or cell, commas, copyright sign. Most that it says for or against a block.
START = (0.0, -3.5, 2.0, 0.7, 0.8, -0.3, 0.2, -2.0)
MOST_FORM = 3.0
#: Pages of the learning sample, blocks of each, and blocks that the starting weights are worth.
SAMPLE_PAGES, SAMPLE_BLOCKS, TRUST = 512, 64, 200.0

PROSE_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
ITEM_TAGS = frozenset("li dt dd td th option".split())


class Block(NamedTuple):
    """Text, element (number and name), bias of the elements around it, whether inside main content, share of letters in links."""

    text: str
    element: int
    tag: str
    bias: float
    inside: bool
    linked: float


def element_bias(name: str, rest: str, bias: float, inside: bool) -> tuple[float, bool]:
    """Bias of what stands in an element, and whether it holds main content. A side element stays one all the way down;
    names in class and id only cost, and the outermost main element below them starts anew."""
    # 2: main content wherever it stands, 1: but not among comments
    main = 1 if name == "article" else 2 if name in MAIN_TAGS else 0
    side = name in SIDE_TAGS or name == "header" and not inside
    words: list[set[str]] = []
    if "=" in rest or "hidden" in rest.lower():
        for found in ATTRIBUTE.finditer(rest):
            attribute, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if attribute not in ATTRIBUTES:
                continue
            if attribute == "hidden" or attribute == "aria-hidden" and value.lower() == "true":
                side = True
            elif attribute == "style":
                side = side or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif attribute == "role":
                main = 2 if value.lower() == "main" else main
                side = side or value.lower() in SIDE_ROLES
            elif attribute == "itemprop":
                main = 2 if value == "articleBody" else main
            elif attribute in ("class", "id") and name not in ("html", "body"):
                words += [{w.lower() for w in WORD.findall(token)} for token in value.split()]
    if bias <= -SIDE or side:
        return -SIDE, inside
    words = [w for w in words if not (w & LAYOUT_WORDS or w & WRAP_WORDS and w & MAIN_WORDS)]
    talk = any(w & TALK_WORDS for w in words)
    if main and not inside and not talk and (main > 1 or bias > -TALK):
        return MAIN, True
    if talk:
        return max(1 - SIDE, bias - TALK), inside
    if not main and any(w & SIDE_WORDS for w in words):
        # a heading or paragraph is often named after what it tells
        return min(bias, max(-MOST_NAMED, bias - (NAMED / 2 if name in PROSE_TAGS else NAMED))), inside
    if bias >= 0 and (main or any(w & MAIN_WORDS for w in words)):
        return max(bias, MAIN if main else 1.5), inside
    return bias, inside


def blocks_of(page: str) -> tuple[list[Block], list[int], list[int]]:
    """Blocks in page order; parent and depth of every block element."""
    found: list[Block] = []
    parents, depths, names = [0], [0], [""]
    # open elements: name, bias, inside main content, number of the innermost block element
    stack: list[tuple[str, float, bool, int]] = [("", 0.0, False, 0)]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked = 0
    place, size = 0, len(page)

    def close() -> None:
        nonlocal linked
        text = SPACE.sub(" ", references.unescape("".join(parts))).strip()
        if text:
            _, bias, inside, element = stack[-1]
            found.append(Block(text, element, names[element], bias, inside, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def leave(depth: int) -> None:
        """End all open elements from that place of the stack on."""
        opened.subtract(e[0] for e in stack[depth:])
        del stack[depth:]

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if opened["a"] > 0:
            linked += len(text)

    while place < size:
        tag = TAG.search(page, place)
        if tag is None:
            add(page[place:])
            break
        if tag.start() > place:
            add(page[place : tag.start()])
        place = tag.end()
        name = (tag["name"] or tag["name2"] or "").lower()
        if not name:
            continue
        rest = tag["rest"] if tag["name"] else tag["rest2"]
        if tag["end"] or tag["end2"]:
            if name in BLOCK_TAGS:
                close()
            if opened[name] > 0:
                leave(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth][0] == name))
            continue
        if name in SILENT_TAGS:
            if not rest.endswith("/"):
                over = re.compile(f"</{re.escape(name)}\\b[^>]*>?", re.I).search(page, place)
                place = over.end() if over else size
            continue
        if name in BLOCK_TAGS:
            close()
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                closes = ("li",) if name == "li" else ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
                for depth in range(len(stack) - 1, 0, -1) if any(opened[c] > 0 for c in closes) else ():
                    if stack[depth][0] in closes:
                        leave(depth)
                        break
                    if stack[depth][0] in BLOCK_TAGS and stack[depth][0] not in ("p", "td", "th"):
                        break
        elif name == "br":
            parts.append(" ")
        if name in VOID_TAGS or rest.endswith("/"):
            continue
        _, bias, inside, element = stack[-1]
        bias, inside = element_bias(name, rest, bias, inside)
        if name in BLOCK_TAGS:
            parents.append(element)
            depths.append(depths[element] + 1)
            names.append(name)
            element = len(names) - 1
        stack.append((name, bias, inside, element))
        opened[name] += 1
    close()
    return found, parents, depths


def form(block: Block) -> tuple[float, ...]:
    """What the classifier looks at, every number from 0 to 1."""
    text, words = block.text, block.text.count(" ") + 1
    return (
        1.0,
        block.linked,
        min(1.0, words / 40),
        float(text[-1] in ".!?…\"'”»"),
        float(block.tag in PROSE_TAGS),
        float(block.tag in ITEM_TAGS),
        min(1.0, 5 * text.count(",") / words),
        float("©" in text[:40]),
    )


def leaning(block: Block, has_main: bool, weights: Sequence[float] = START) -> float:
    """Cost of calling the block boilerplate less the cost of calling it content."""
    odds = sum(w * x for w, x in zip(weights, form(block)))
    return block.bias - (OUTSIDE if has_main and not block.inside else 0.0) + max(-MOST_FORM, min(MOST_FORM, odds))


def steps_between(a: int, b: int, parents: list[int], depths: list[int]) -> int:
    """Steps from one element to another through their lowest common ancestor."""
    steps = 0
    while a != b:
        if depths[a] >= depths[b]:
            a = parents[a]
        else:
            b = parents[b]
        steps += 1
    return steps


def edges_of(blocks: list[Block], parents: list[int], depths: list[int]) -> list[tuple[int, int, float]]:
    """Smoothness edges: to the next block, by the steps between the elements (one more if they are of different kinds), and
    to the next block under the same parent. From block to block every element is left or entered once: linear in the page."""
    edges, last = [], {}
    for k, block in enumerate(blocks):
        if k:
            before = blocks[k - 1]
            steps = steps_between(before.element, block.element, parents, depths) + (before.tag != block.tag)
            edges.append((k - 1, k, NEXT / (1 + steps)))
        parent = parents[block.element]
        if parent in last and last[parent] != k - 1:
            edges.append((last[parent], k, SIBLING))
        last[parent] = k
    return edges


def minimum_cut(lean: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side of a minimum cut: node i is tied to the source with lean[i] if positive, else to the sink."""
    n = len(lean)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, weight in edges:
        near[a][b] = near[a].get(b, 0.0) + weight
        near[b][a] = near[b].get(a, 0.0) + weight
    label: list[bool | None] = [None] * n
    lean, queue = lean[:], deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(lean[i]) > sum(near[i].values()):
            label[i] = lean[i] > 0
            for j, weight in near[i].items():
                lean[j] += weight if label[i] else -weight
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if not rest:
        return label
    source, sink = n, n + 1
    capacity: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest} | {source: {}, sink: {}}
    for i in rest:
        a, b, weight = (source, i, lean[i]) if lean[i] > 0 else (i, sink, -lean[i])
        capacity[a][b], capacity[b][a] = weight, 0.0
    while True:
        depth, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, weight in capacity[i].items():
                if weight > 1e-12 and j not in depth:
                    depth[j] = depth[i] + 1
                    queue.append(j)
        if sink not in depth:
            for i in rest:
                label[i] = i in depth
            return label
        # blocking flow along shortest paths, walked with an explicit stack
        open_ = {i: iter(list(capacity[i])) for i in depth}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                push = min(capacity[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    capacity[a][b] -= push
                    capacity[b][a] += push
                cut = next(k for k, (a, b) in enumerate(zip(path, path[1:])) if capacity[a][b] <= 1e-12)
                del path[cut + 1 :]
                continue
            step = next((j for j in open_[i] if capacity[i][j] > 1e-12 and depth.get(j, -1) == depth[i] + 1), None)
            if step is None:
                path.pop()
            else:
                path.append(step)


def marks_main(blocks: list[Block]) -> bool:
    return any(b.inside and b.bias > -SIDE for b in blocks)


def main_text(page: str | None, weights: Sequence[float] = START) -> str:
    """Text of the content blocks, joined by one space."""
    blocks, parents, depths = blocks_of(page or "")
    if not blocks:
        return ""
    has_main = marks_main(blocks)
    labels = minimum_cut([leaning(b, has_main, weights) for b in blocks], edges_of(blocks, parents, depths))
    return " ".join(b.text for b, content in zip(blocks, labels) if content)


def learned(rows: np.ndarray, content: np.ndarray) -> tuple[float, ...]:
    """Weights of greatest posterior: logistic regression, held to the starting weights like by TRUST blocks."""
    start = np.array(START)
    weights = start.copy()
    for _ in range(20):
        odds = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (content - odds) - TRUST / 4 * (weights - start)
        bend = (rows * (odds * (1 - odds))[:, None]).T @ rows + TRUST / 4 * np.eye(len(start))
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(w) for w in weights.round(6))


def fitted(pages: DataFrame, html: str = "html", sample: int = SAMPLE_PAGES) -> tuple[float, ...]:
    """Weights of the classifier, learned from about `sample` pages (SAMPLE_BLOCKS of each, evenly over the page)."""
    count = pages.count()
    if not count:
        return START
    hashable = [c for c, kind in pages.dtypes if not any(k in kind for k in ("map<", "variant"))]
    mark = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in hashable])
    some = pages.select(mark.alias("mark"), F.col(html).cast("string").alias("page"))
    if count > sample:
        some = some.where(F.abs(F.col("mark") / 2.0**63) < sample / count)
    # equal rows meet before the shuffle
    some = some.groupBy("mark").agg(F.min("page").alias("page"))

    def shown(batches):
        for frame in batches:
            for page in frame["page"]:
                blocks = blocks_of(page or "")[0]
                if marks_main(blocks):
                    chosen = blocks[:: -(-len(blocks) // SAMPLE_BLOCKS)]
                    yield pd.DataFrame({"form": [form(b) for b in chosen], "content": [b.inside and b.bias > 0 for b in chosen]})

    found = some.mapInPandas(shown, "form array<double>, content boolean").toPandas()
    if not len(found):
        return START
    rows = np.stack(found["form"].to_numpy())
    order = np.lexsort((found["content"], *rows.T))
    return learned(rows[order], found["content"].to_numpy(dtype=float)[order])


def extracted(pages: DataFrame, html: str = "html", into: str = "text", weights: Sequence[float] | None = None) -> DataFrame:
    """All columns of the rows with their main text, by the given weights or those learned from the pages."""
    weights = fitted(pages, html) if weights is None else tuple(weights)

    @F.pandas_udf("string")
    def run(column):
        return column.map(lambda page: main_text(page, weights), na_action=None)

    return pages.withColumn(into, run(F.col(html).cast("string")))
