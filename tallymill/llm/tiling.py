"""Benchmark decontamination by greedy string tiling.

Five words in a row that a document shares with an item are a seed, or all words of a shorter item; the items that enough seeds point to are
compared with the document. The longest run of words that both have, and that no tile covers yet, becomes a tile, again and
again until runs are shorter than a seed; Karp-Rabin hashes find it. A document is contaminated by an item if tiles
cover most of the item's words, in whatever order they stand.
"""

from __future__ import annotations

import functools
import re
import string
from itertools import repeat
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import by_row, matching, saved, whole_text

SEED_WORDS = 5
LEAST_COVERAGE = 0.8
#: Bytes of benchmark text that go to tasks at once; larger benchmarks are taken in blocks, one pass each.
BLOCK_BYTES = 8_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TO_SPACE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


# Thai to Burmese, Khmer, kana and Han, which put no spaces between words; their marks and full-width ones.
_NO_SPACES = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_WIDE_MARKS = re.compile("[\u3000-\u3003\u3008-\u3011\u3014-\u301f\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def words(text: str | None) -> list[bytes]:
    """Lower-case words: runs of characters other than ASCII white space and ASCII punctuation; of scripts that put no spaces
    between words, single characters."""
    text = (text or "").lower()
    if not text.isascii():
        text = _NO_SPACES.sub(r" \g<0> ", _WIDE_MARKS.sub(" ", text))
    return text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def run_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length``, modulo 2^64."""
    if len(ids) < length:
        return np.zeros(0, np.uint64)
    spread = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    spread ^= spread >> np.uint64(29)
    power = spread
    # Runs of doubled lengths, put together for the bits of the length.
    found, offset, size, factor = np.zeros(len(ids) - length + 1, np.uint64), 0, 1, int(_BASE)
    while size <= length:
        if length & size:
            scale = np.uint64(pow(int(_BASE), offset, 1 << 64))
            found = found + power[offset : offset + len(found)] * scale
            offset += size
        power = power[: len(power) - size] + power[size:] * np.uint64(factor) if len(power) > size else power[:0]
        factor = factor * factor % 2**64
        size *= 2
    return found


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(marked)])
    return total[length:] == total[:-length]


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """``(place in doc, place in item, length)`` of each tile, longest first; numbers stand for words."""
    marked_doc, marked_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    found: list[tuple[int, int, int]] = []

    def shared(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        in_doc, in_item = np.flatnonzero(_free(marked_doc, length)), np.flatnonzero(_free(marked_item, length))
        d, i = run_hashes(doc, length)[in_doc], run_hashes(item, length)[in_item]
        both = np.intersect1d(d, i)
        keep_d, keep_i = np.isin(d, both), np.isin(i, both)
        return in_doc[keep_d], d[keep_d], in_item[keep_i], i[keep_i]

    most = min(len(doc), len(item))
    while most >= least and len(shared(least)[0]):
        low, high = least, most
        while low < high:
            middle = (low + high + 1) // 2
            if len(shared(middle)[0]):
                low = middle
            else:
                high = middle - 1
        at_doc, hash_doc, at_item, hash_item = shared(low)
        places: dict[int, list[int]] = {}
        for at, h in zip(at_item.tolist()[::-1], hash_item.tolist()[::-1], strict=True):
            places.setdefault(h, []).append(at)
        before = len(found)
        for at, h in zip(at_doc.tolist(), hash_doc.tolist(), strict=True):
            open_places = places.get(h, [])
            while open_places and marked_item[open_places[-1] : open_places[-1] + low].any():
                open_places.pop()
            if open_places and not marked_doc[at : at + low].any():
                place = open_places[-1]
                if (doc[at : at + low] == item[place : place + low]).all():
                    open_places.pop()
                    marked_doc[at : at + low] = marked_item[place : place + low] = True
                    found.append((at, place, low))
        if len(found) == before:  # hashes agreed where words do not
            low -= 1
        most = low
    return found


class Seeds(NamedTuple):
    hashes: np.ndarray
    item_of: np.ndarray
    place: np.ndarray


class Block(NamedTuple):
    """Items as numbers, and where each seed stands in them, by the length of seeds."""

    numbers: dict[bytes, int]
    ids: list
    items: list[np.ndarray]
    seeds: dict[int, Seeds]


def make_block(rows: list[tuple], size: int, short: bool = False) -> Block:
    numbers: dict[bytes, int] = {}
    items = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in words(text)], np.int64) for _, text in rows]
    # With ``short``, a shorter item is a seed as a whole.
    lengths = [size if len(x) >= size else len(x) * short for x in items]
    return Block(numbers, [key for key, _ in rows], items, {n: _seeds(items, lengths, n) for n in sorted(set(lengths) - {0})})


def _seeds(items: list[np.ndarray], lengths: list[int], length: int) -> Seeds:
    own = [i for i, n in enumerate(lengths) if n == length]
    found = [run_hashes(items[i], length) for i in own]
    hashes = np.concatenate(found)
    order = np.argsort(hashes, kind="stable")
    item_of = np.concatenate([np.full(len(h), i, np.int64) for i, h in zip(own, found, strict=True)])
    place = np.concatenate([np.arange(len(h), dtype=np.int64) for h in found])
    return Seeds(hashes[order], item_of[order], place[order])


def compare(text: str | None, block: Block, size: int, least: float) -> list[tuple]:
    """``(item, item_words, tiles, tiled_words)`` of the items that tiles cover well enough."""
    own = words(text)
    doc = np.fromiter(map(block.numbers.get, own, repeat(0)), np.int64, len(own))
    return [hit for length in block.seeds for hit in _covered(doc, block, length, least)]


def _covered(doc: np.ndarray, block: Block, size: int, least: float) -> list[tuple]:
    known = np.flatnonzero(_free(doc == 0, size)) if len(doc) >= size else np.zeros(0, np.int64)
    if not len(known):
        return []
    of_items = block.seeds[size]
    seeds = np.unique(run_hashes(doc, size)[known])
    first, past = np.searchsorted(of_items.hashes, seeds), np.searchsorted(of_items.hashes, seeds, "right")
    hits = np.concatenate([*(np.arange(a, b) for a, b in zip(first, past, strict=True) if b > a), np.zeros(0, np.int64)]).astype(int)
    found = []
    for i in np.unique(of_items.item_of[hits]):
        item = block.items[i]
        under = np.zeros(len(item), bool)
        for at in of_items.place[hits[of_items.item_of[hits] == i]]:
            under[at : at + size] = True
        if under.sum() >= least * len(item):  # tiles cannot cover more words than seeds do
            laid = tiles(doc, item, size)
            covered = sum(length for _, _, length in laid)
            if covered >= least * len(item):
                found.append((block.ids[i], len(item), len(laid), covered))
    return found


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = SEED_WORDS,
    least: float = LEAST_COVERAGE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    short: bool = False,
) -> DataFrame:
    """``doc_id, mark, item_id, item_words, tiles, tiled_words, coverage`` of each document and item that it holds.

    Whole texts of all documents are compared with all items, tiles have ``size`` words or more, and coverage is at
    least ``least``. Items of fewer than ``size`` words are one tile as a whole; ``short=False`` leaves them out, for benchmarks whose
    short items are common words. Null items and those without words contaminate nothing, and null or empty documents are not
    contaminated. Rows that repeat an id are reported each, null ids as null. An empty table on
    either side gives an empty result. Other columns are not read. ``mark`` is a hash of the text.
    """
    kind = benchmark.schema[item_id].dataType.simpleString()
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col("text").alias("text"))
    total = items.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole_text(text)).alias("mark"), whole_text(text).alias("text"))

    def one(block: Block) -> DataFrame:
        def make(text: str) -> list[tuple]:
            return [(*hit, hit[3] / hit[1]) for hit in compare(text, block, size, least)]

        return by_row(rows, make, f"item_id {kind}, item_words bigint, tiles bigint, tiled_words bigint, coverage double")

    found = []
    for i in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)
        found.append(one(make_block([(r["item_id"], r["text"]) for r in part.collect()], size, short)))
    return functools.reduce(DataFrame.unionByName, found)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """The documents that no item contaminates, with their own columns."""
    hits = saved(contaminated(docs, benchmark, doc_id=doc_id, text=text, short=short).select("doc_id", "mark").distinct(), "contaminated")
    return matching(docs, doc_id, F.xxhash64(whole_text(text)), hits, "left_anti").select("doc.*")
