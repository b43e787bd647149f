"""SimHash near-dedup by vantage-point trees.

A vantage-point tree splits fingerprints by their Hamming distance to a vantage point: up to a limit they go left,
beyond it right. By the triangle inequality a fingerprint can only be near one on the other side if its own distance
is close to the limit, so all other branches are pruned. The upper levels are fitted to a bounded sample and broadcast; its
leaves are the shards. Every fingerprint lives in one shard and visits those beyond the limits that it may have
neighbours in; a shard then goes on splitting its own points until blocks are small and compares pairs exactly.

Distances of random 64-bit fingerprints all lie close to 32, so that a radius of 3 would prune little. Two fingerprints
within 3 bits are within 1 bit on their upper or on their lower half. So there is one tree for each half, in which a
radius of 1 suffices; nodes whose points agree on that half split by the whole fingerprint with the full radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import by_row, matching, saved, whole_text
from tallymill.llm.components import components

WORDS_PER_SHINGLE = 3
MAX_BITS = 3
#: Points that a shard should hold, and the most shards a tree may have; the sample has 64 points for each shard.
SHARD_POINTS, MAX_SHARDS, SAMPLE_PER_SHARD = 4096, 4096, 64
#: Points below which a shard compares all pairs of a block, in tiles of this many rows.
BLOCK = 1024
#: Links that join the members of a shard's component: a tree of this many children for each.
_FAN = 32

_ALL = 0xFFFFFFFFFFFFFFFF
HALVES = (0x00000000FFFFFFFF, 0xFFFFFFFF00000000)


# Fingerprints


def fingerprint(text: str | None, size: int = WORDS_PER_SHINGLE) -> int:
    """64 bits, each set if over half of the shingles' XXH64 have it; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, glue = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= size:
        return digest(glue(words), 42)
    ones = np.zeros(64, np.int64)
    count = len(words) - size + 1
    for start in range(0, count, 65536):
        stop = min(start + 65536, count)
        hashes = np.fromiter(
            (digest(glue(words[i : i + size]), 42) for i in range(start, stop)), np.uint64, stop - start
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS_PER_SHINGLE) -> DataFrame:
    """``doc_id, mark, fp``: a hash of the text, and the fingerprint as a signed long with the same 64 bits."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), _mark(text).alias("mark"), whole_text(text).alias("text"))

    def make(text: str) -> list[tuple]:
        value = fingerprint(text, size)
        return [(value - (1 << 64) if value >> 63 else value,)]

    return by_row(rows, make, "fp bigint")


def _mark(text: str) -> Column:
    return F.xxhash64(whole_text(text))


# Vantage-point trees


class Split(NamedTuple):
    point: int
    mask: int
    radius: int
    limit: int


def _distance(points: np.ndarray, to: np.ndarray | int, mask: np.ndarray | int) -> np.ndarray:
    return np.bitwise_count((points ^ np.uint64(to)) & np.uint64(mask)).astype(np.int16)


def choose_split(points: np.ndarray, half: int, radius: int, rng: np.random.Generator) -> Split | None:
    """The best of a few vantage points: halves of like size, few points near the limit. None if nothing separates."""
    best, least = None, 0.95
    some = points if len(points) <= 2048 else points[rng.integers(0, len(points), 2048)]
    for point in some[rng.integers(0, len(some), 6)]:
        for mask, reach in ((half, radius // 2), (_ALL, radius)):
            d = _distance(some, point, mask)
            limit = int(np.median(d))
            for limit in (limit - 1, limit):
                left = np.mean(d <= limit)
                if 0 < left < 1:
                    near = np.mean((d > limit - reach) & (d <= limit + reach))
                    cost = max(left, 1 - left) + near / 2
                    if cost < least:
                        best, least = Split(int(point), mask, reach, limit), cost
    return best


def fit_tree(sample: np.ndarray, half: int, shards: int, radius: int = MAX_BITS) -> list[Split | None]:
    """Nodes in heap order; None where the tree ends."""
    rng = np.random.default_rng(half & 0xFFFF)
    nodes: list[Split | None] = []
    level = [sample]
    while len(level) <= shards // 2 and any(len(x) > 1 for x in level):
        below = []
        for points in level:
            split = choose_split(points, half, radius, rng) if len(points) > 1 else None
            nodes.append(split)
            if split is None:
                below += [points, points[:0]]
            else:
                left = _distance(points, split.point, split.mask) <= split.limit
                below += [points[left], points[~left]]
        level = below
    return nodes


def visit(points: np.ndarray, nodes: list[Split | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which point goes to which shard, and whether it lives there.

    Of two near points that a node parts, the one on the right visits the left side; the other needn't move.
    """
    point = np.array([n.point if n else 0 for n in nodes], np.uint64)
    mask = np.array([n.mask if n else 0 for n in nodes], np.uint64)
    radius = np.array([n.radius if n else 0 for n in nodes], np.int16)
    limit = np.array([n.limit if n else 0 for n in nodes], np.int16)
    who, at, home = np.arange(len(points)), np.zeros(len(points), np.int64), np.ones(len(points), bool)
    while len(at) and at[0] < len(nodes):
        d = np.bitwise_count((points[who] ^ point[at]) & mask[at]).astype(np.int16)
        right = d > limit[at]
        to_left = ~right | (d <= limit[at] + radius[at])
        to_right = right | (~home & (d > limit[at] - radius[at]))
        who, at, home = (
            np.concatenate([who[to_left], who[to_right]]),
            np.concatenate([2 * at[to_left] + 1, 2 * at[to_right] + 2]),
            np.concatenate([home[to_left] & ~right[to_left], home[to_right] & right[to_right]]),
        )
    return who, at - len(nodes), home


# Pairs within a shard


class Groups:
    """Labels of the points of a shard; ``link`` merges, many pairs at a time."""

    def __init__(self, count: int) -> None:
        self.label = np.arange(count)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        while (differ := a != b).any():
            a, b = a[differ], b[differ]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while ((up := parent[parent]) != parent).any():
                parent = up
            self.label = parent[self.label]
            a, b = parent[a], parent[b]


def _pairs(points: np.ndarray, home: np.ndarray, guest: np.ndarray, half: int, radius: int, groups: Groups, rng, depth: int = 0) -> None:
    """Links ``home`` with itself and with ``guest``, both indexes into ``points``."""
    if len(home) > BLOCK and depth < 64:
        split = choose_split(points[home], half, radius, rng)
        if split is not None:
            d, g = (_distance(points[x], split.point, split.mask) for x in (home, guest))
            left = d <= split.limit
            over = home[(d > split.limit) & (d <= split.limit + split.radius)]
            near = g <= split.limit + split.radius, g > split.limit - split.radius
            _pairs(points, home[left], np.concatenate([over, guest[near[0]]]), half, radius, groups, rng, depth + 1)
            _pairs(points, home[~left], guest[near[1]], half, radius, groups, rng, depth + 1)
            return
    every = np.concatenate([home, guest])
    for i in range(0, len(home), BLOCK):
        rows = home[i : i + BLOCK]
        for j in range(i, len(every), BLOCK):
            columns = every[j : j + BLOCK]
            r, c = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[columns][None, :]) <= radius)
            groups.link(rows[r], columns[c])


def shard_links(points: np.ndarray, home: np.ndarray, half: int, radius: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what pairs within ``radius`` connect, as few for a component as it has members, less one."""
    order = np.argsort(points)
    points, home = points[order], home[order]
    groups = Groups(len(points))
    _pairs(points, np.flatnonzero(home), np.flatnonzero(~home), half, radius, groups, np.random.default_rng(0))
    by_label = np.argsort(groups.label, kind="stable")
    label = groups.label[by_label]
    first = np.r_[True, label[1:] != label[:-1]] if len(label) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(label)), 0))
    rank = np.arange(len(label)) - start
    child = rank > 0
    parent = start + (rank - 1) // _FAN
    return points[by_label[child]], points[by_label[parent[child]]]


def near_links(prints: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` that connect all pairs within ``radius`` bits."""
    count = prints.count()
    shards = 1
    while shards < MAX_SHARDS and shards * SHARD_POINTS < count:
        shards *= 2
    sample = prints.orderBy(F.xxhash64("fp"), "fp").limit(shards * SAMPLE_PER_SHARD)
    points = np.array([row["fp"] for row in sample.collect()], np.int64).view(np.uint64)
    trees = [fit_tree(points, half, shards, radius) for half in HALVES]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for tree, nodes in enumerate(trees):
                who, shard, home = visit(own, nodes)
                yield pd.DataFrame({"tree": tree, "shard": shard, "fp": own[who].view(np.int64), "home": home})

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_links(rows["fp"].to_numpy(np.int64).view(np.uint64), rows["home"].to_numpy(bool), HALVES[key[0]], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (
        prints.select("fp")
        .mapInPandas(route, "tree int, shard bigint, fp bigint, home boolean")
        .groupBy("tree", "shard")
        .applyInPandas(compare, "a bigint, b bigint")
    )


# The operator


def _grouped(docs: DataFrame, doc_id: str, text: str, size: int, radius: int) -> DataFrame:
    """``doc_id, mark, fp, root, component_id``: the mark tells texts apart, the root names a group."""
    if not 0 <= radius <= 64:
        raise ValueError("radius must be a number of bits")
    rows = saved(fingerprints(docs, doc_id, text, size), "fingerprints")
    points = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    roots = components(saved(near_links(points, radius), "near"))
    placed = saved(
        points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "placed",
    )
    names = saved(placed.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    members = saved(placed.join(names, "root").select("fp", "root", "component_id"), "members")
    return rows.join(members, "fp")


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS_PER_SHINGLE, radius: int = MAX_BITS
) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``.

    Words are runs of characters other than ASCII white space, after lower-casing A-Z. Fingerprints link at ``radius``
    differing bits or fewer; ``component_id`` is the smallest ``doc_id`` that links reach. A document without words (a
    null or empty text among them) has fingerprint zero and links like any other. Rows that repeat an id are reported
    each. A null id is reported and joins its group, but never names it; a group of null ids only has a null component.
    An empty table gives an empty result. Other columns are not read.
    """
    return _grouped(docs, doc_id, text, size, radius).select("doc_id", "fp", "component_id")


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = WORDS_PER_SHINGLE, radius: int = MAX_BITS
) -> DataFrame:
    """One document of each group, the one with the smallest id, with its own columns.

    Any id goes before a null one. Of rows that repeat id and text, one stays.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark"))
    kept = (
        _grouped(docs, doc_id, text, size, radius)
        .groupBy("root")
        .agg(first.alias("first"))
        .select("first.doc_id", "first.mark")
    )
    return matching(docs, doc_id, _mark(text), kept, "left_semi").dropDuplicates(["key"]).select("doc.*")
