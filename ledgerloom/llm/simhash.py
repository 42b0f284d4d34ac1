"""SimHash near-duplicates by a hierarchical index in Gray order.

Fingerprints of equal value are one class. Every class is filed under several masks: the masked bits are the uppermost
pattern of the index, shared by all classes below it. Below a pattern, classes lie in the order of their Gray rank, in
which every common prefix is one run; runs are the inner nodes. A search walks pairs of nodes downwards, counts the
bits by which their prefixes differ, and drops a pair with all that lies below it as soon as the count exceeds the
radius. With pigeonhole masks no pair within the radius is missed; sampled masks reach wider radii with a known share.

What leaves a pattern is not the pairs but, for each class, the least class of its local component: at most one row per
class and mask. The components of those links come from alternating star contraction over written tables.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

#: Seeds of the 64-bit words of a fingerprint; one word is the plain fingerprint.
SEEDS = (42, 4242)
#: Classes below one pattern that a task compares at once; larger patterns are cut into blocks and the blocks paired.
BLOCK = 8192
#: Rows of the index in one task.
TASK_ROWS = 60_000
#: Node pairs walked at once.
FRONT = 1 << 20
#: Bits of the prefixes that make the inner nodes, for each 64-bit word.
LEVELS = (12, 24, 40, 64)


def simhash(text: str | None, words: int = 4, seeds: Sequence[int] = SEEDS[:1]) -> list[int]:
    """Fingerprint words of a text: a bit is set where over half of the shingles' hashes have it set."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return [0] * len(seeds)
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(1, len(tokens) - words + 1)
    stops = ends[words - 1 :].tolist() if len(tokens) >= words else [len(line)]
    found = []
    view = memoryview(line)
    shingles = [view[a:b] for a, b in zip(starts[:count].tolist(), stops)]
    for seed in seeds:
        ones = np.zeros(64, dtype=np.int64)
        digest = xxhash.xxh64_intdigest
        for k in range(0, count, 1 << 16):
            hashes = np.array([digest(s, seed) for s in shingles[k : k + (1 << 16)]], dtype=">u8")
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        found.append(int.from_bytes(np.packbits(ones * 2 > count).tobytes(), "big"))
    return found


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, width: int = 1) -> DataFrame:
    """Columns key, w0.. : the fingerprint words of every row as signed longs. NULL text counts as empty."""
    seeds = SEEDS[:width]
    names = [f"w{k}" for k in range(width)]

    def run(batches):
        for frame in batches:
            rows = [[signed(v) for v in simhash(t, words, seeds)] for t in frame[text]]
            out = pd.DataFrame(rows, columns=names, dtype="int64")
            out.insert(0, key, frame[key].to_numpy())
            yield out

    source = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias(text)).where(F.col(key).isNotNull())
    return source.mapInPandas(run, ", ".join([f"{key} long", *[f"{n} long" for n in names]]))


def pigeonhole_masks(radius: int, width: int = 1, spare: int = 3) -> list[tuple[int, ...]]:
    """Masks of which every two fingerprints within the radius agree on one: of radius + spare blocks, any `spare`."""
    blocks, bits = radius + spare, 64 * width
    cuts = [bits * k // blocks for k in range(blocks + 1)]
    one = [sum(1 << b for b in range(cuts[k], cuts[k + 1])) for k in range(blocks)]
    return [_words(sum(c), width) for c in itertools.combinations(one, spare)]


def sampled_masks(count: int, bits: int, width: int = 2, seed: int = 7) -> list[tuple[int, ...]]:
    """Masks of `bits` places drawn by a fixed seed; a pair that differs in a share p of its bits is missed by all of
    them with probability about (1 - (1 - p) ** bits) ** count."""
    draw = random.Random(seed)
    return [_words(sum(1 << b for b in draw.sample(range(64 * width), bits)), width) for _ in range(count)]


def _words(mask: int, width: int) -> tuple[int, ...]:
    return tuple(signed(mask >> (64 * k) & ((1 << 64) - 1)) for k in range(width))


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Place of each fingerprint (rows of unsigned words, highest first) in the Gray sequence."""
    rank = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    for k in range(1, rank.shape[1]):
        # the prefix parity of the word before runs on
        rank[:, k] ^= np.uint64(0) - (rank[:, k - 1] & np.uint64(1))
    return rank


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges start, start + 1, ... with the given counts, joined."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def _merge(least: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes a[i] and b[i]; every entry of `least` ends at the least index of its component."""
    while len(a):
        x, y = least[a], least[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = least[least]
            if (jumped == least).all():
                break
            least[:] = jumped


def _below(first_a, count_a, first_b, count_b, same, last):
    """Pairs of children of paired nodes; a node paired with itself gives each pair of its children once."""
    left = _ranges(first_a, count_a)
    right_count = np.repeat(count_b, count_a)
    right = _ranges(np.repeat(first_b, count_a), right_count)
    left = np.repeat(left, right_count)
    same = np.repeat(np.repeat(same, count_a), right_count)
    keep = ~same | ((left < right) if last else (left <= right))
    return left[keep], right[keep]


def _near(left, right, at, words, level, radius):
    """The pairs whose prefixes differ in at most `radius` bits so far."""
    w, mask = level
    p, q = at[left], at[right]
    apart = np.zeros(len(left), dtype=np.int64)
    for k in range(min(w + 1, words.shape[1])):
        bits = words[p, k] ^ words[q, k]
        apart += np.bitwise_count(bits & mask if k == w else bits)
    near = apart <= radius
    return left[near], right[near]


def local_least(group: np.ndarray, words: np.ndarray, side: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by (group, Gray rank): the least row index of each row's component within its group.

    `side`: -1 where all rows of a group meet; 0 and 1 where only rows of different blocks have to meet.
    """
    n, width = words.shape
    least = np.arange(n)
    if n < 2:
        return least
    # inner nodes by level: bounds of the runs that share a prefix, and the mask of that prefix
    fresh = np.concatenate(([True], group[1:] != group[:-1]))
    levels = []
    bounds = [np.flatnonzero(fresh)]
    diff = words[1:] ^ words[:-1]
    for w in range(width):
        for bits in LEVELS:
            mask = np.uint64(((1 << bits) - 1) << (64 - bits))
            fresh = fresh.copy()
            fresh[1:] |= (diff[:, w] & mask) != 0
            if w:
                fresh[1:] |= (diff[:, :w] != 0).any(axis=1)
            levels.append((w, mask))
            bounds.append(np.flatnonzero(fresh))
    # equal fingerprints of one group can only be rows of two blocks; the last level keeps rows apart
    levels.append((width, np.uint64(0)))
    bounds.append(np.arange(n))
    children = []
    for above, below in zip(bounds, bounds[1:]):
        first = np.searchsorted(below, above)
        children.append((first, np.diff(np.concatenate((first, [len(below)])))))
    has_two = np.diff(np.concatenate((bounds[0], [n]))) > 1
    roots = np.flatnonzero(has_two)
    stack = [(0, roots, roots)]
    while stack:
        level, a, b = stack.pop()
        first, count = children[level]
        size = count[a]
        if int((size * count[b]).sum()) > FRONT and len(a) > 1:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        # one pair of wide nodes is walked in slices of the left node's children
        step = int(size[0]) if len(a) > 1 else max(1, FRONT // int(count[b[0]]))
        for skip in range(0, int(size[0]), step) if len(a) == 1 else (0,):
            taken = np.minimum(size - skip, step) if len(a) == 1 else size
            left, right = _below(first[a] + skip, taken, first[b], count[b], a == b, level + 2 == len(bounds))
            left, right = _near(left, right, bounds[level + 1], words, levels[level], radius)
            if level + 2 == len(bounds):
                cross = (side[left] < 0) | (side[left] != side[right])
                _merge(least, left[cross], right[cross])
            elif len(left):
                stack.append((level + 1, left, right))
    return least


def near_links(classes: DataFrame, radius: int, masks: Sequence[tuple[int, ...]], block: int = BLOCK) -> DataFrame:
    """Links between classes (columns node, w0..; distinct fingerprints): node and the least node of its component
    below some mask. Both ends of every pair found within the radius lie in one component of these links."""
    width = len(masks[0])
    names = [f"w{k}" for k in range(width)]
    patterns = F.array(*[F.xxhash64(F.lit(m), *[F.col(c).bitwiseAND(F.lit(v)) for c, v in zip(names, mask)]) for m, mask in enumerate(masks)])
    filed = classes.select("node", *names, F.explode(patterns).alias("_key"))
    sizes = written(filed.groupBy("_key").agg(F.count("*").alias("_size")).where("_size > 1"))
    shared = filed.join(sizes, "_key")
    # a pattern of more than one block: its rows go to every pair of blocks that they belong to
    blocks = F.ceil(F.col("_size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = F.when(blocks == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")))
    )
    dealt = shared.select("node", *names, "_key", own.alias("_own"), F.explode(pairs).alias("_pair"))
    side = F.when(F.col("_pair.i") == F.col("_pair.j"), -1).when(F.col("_own") == F.col("_pair.i"), 0).otherwise(1)
    dealt = dealt.select("node", *names, F.xxhash64("_key", "_pair").alias("_group"), side.cast("int").alias("_side"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        words = frame[names].to_numpy(dtype=np.int64).view(np.uint64)
        rank = gray_rank(words)
        group, side, node = (frame[c].to_numpy() for c in ("_group", "_side", "node"))
        order = np.lexsort([node, *[rank[:, k] for k in range(width - 1, -1, -1)], group])
        group, side, node, words = group[order], side[order], node[order], np.ascontiguousarray(words[order])
        least = local_least(group, words, side, radius)
        # the least index names the component; its least node represents it
        lowest = node.copy()
        np.minimum.at(lowest, least, node)
        to = lowest[least]
        moved = to != node
        return pd.DataFrame({"node": node[moved], "to": to[moved]}).drop_duplicates()

    rows = sizes.agg(F.sum(F.col("_size") * F.ceil(F.col("_size") / F.lit(block)))).first()[0] or 0
    tasks = max(1, math.ceil(rows / TASK_ROWS))
    return (
        dealt.withColumn("_task", F.pmod(F.col("_group"), F.lit(tasks)).cast("int"))
        .groupBy("_task")
        .applyInPandas(run, "node long, to long")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """Least node reachable from each linked node: node, component. Alternates large and small stars until the links
    no longer change; every round is a written table."""
    edges = written(links.select(F.greatest("node", "to").alias("u"), F.least("node", "to").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.where("u > v")
        minimum = lower.groupBy("u").agg(F.min("v").alias("m"))
        small = lower.join(minimum, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = tuple(now)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4,
    masks: Sequence[tuple[int, ...]] | None = None,
) -> DataFrame:
    """Columns key, w0.., component: the smallest key reachable over links of at most `radius` differing bits.

    The width of the fingerprints follows from the masks (default: pigeonhole masks over one word, which miss no link).
    NULL and blank texts have the fingerprint zero and are linked like any other. Empty tables give no rows. Rows with a NULL key are left out;
    repeated keys each get their row.
    """
    masks = masks or pigeonhole_masks(radius)
    width = len(masks[0])
    names = [f"w{k}" for k in range(width)]
    prints = written(with_fingerprints(docs, key, text, words, width))
    classes = written(prints.groupBy(*names).agg(F.min(key).alias("node")))
    reached = components(near_links(classes, radius, masks))
    labelled = classes.join(reached, "node", "left").select(*names, F.coalesce("component", "node").alias("component"))
    return prints.join(labelled, names).select(key, *names, "component")
