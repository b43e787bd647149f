"""Suffix arrays by induced sorting, and permuted common prefixes, on arrays of a shard.

A suffix is of the smaller type if it is smaller than the next one. Leftmost smaller suffixes are sorted first; all others
follow from them in one pass up and one pass down over the buckets of first letters. A pass handles a bucket at a
time, as arrays, so its work is linear. Sorting the leftmost smaller substrings in the same way names them, and the string
of the names is sorted by recursion. An alphabet too large for that, as names soon have, is sorted by doubling.
"""

from __future__ import annotations

import numpy as np

#: Letters for which a pass bucket by bucket is worth while: one for so many positions.
_POSITIONS_PER_LETTER = 256


def _smaller(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next; the last letter is smaller than all others and unique."""
    n = len(text)
    rises, differs = np.zeros(n, bool), np.zeros(n, bool)
    rises[:-1], differs[:-1] = text[:-1] < text[1:], text[:-1] != text[1:]
    rises[-1] = differs[-1] = True
    at = np.where(differs, np.arange(n), n)
    return rises[np.minimum.accumulate(at[::-1])[::-1]]


def _induce(text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, letters: int) -> np.ndarray:
    """The suffix array that follows from the leftmost smaller suffixes in the given order."""
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes)
    heads, tails = ends - sizes, ends.copy()
    found = np.full(len(text), -1, np.int64)
    first = text[leftmost]
    by_letter = leftmost[np.argsort(first, kind="stable")]
    bounds = np.searchsorted(first[np.argsort(first, kind="stable")], np.arange(letters + 1))

    def before(at: np.ndarray, kind: bool) -> tuple[np.ndarray, np.ndarray]:
        at = at[at > 0] - 1
        at = at[smaller[at] == kind]
        return at, text[at]

    def deal(at: np.ndarray, letter: np.ndarray, up: bool) -> None:
        order = np.argsort(letter, kind="stable")
        at, letter = at[order], letter[order]
        count = np.bincount(letter, minlength=letters)
        rank = np.arange(len(at)) - (np.cumsum(count) - count)[letter]
        if up:
            found[heads[letter] + rank] = at
            heads[:] += count
        else:
            found[tails[letter] - 1 - rank] = at
            tails[:] -= count

    starts = heads.copy()
    for letter in np.flatnonzero(sizes):
        done = starts[letter]
        while done < heads[letter]:  # a run of the letter adds to its own bucket
            wave = found[done : heads[letter]]
            done = heads[letter]
            deal(*before(wave, False), True)
        deal(*before(by_letter[bounds[letter] : bounds[letter + 1]], False), True)
    larger_end = heads.copy()
    for letter in np.flatnonzero(sizes)[::-1]:
        done = ends[letter]
        while done > tails[letter]:
            wave = found[tails[letter] : done][::-1]
            done = tails[letter]
            deal(*before(wave, True), False)
        deal(*before(found[starts[letter] : larger_end[letter]][::-1], True), False)
    found[0] = len(text) - 1
    return found


def _doubled(text: np.ndarray) -> np.ndarray:
    """The suffix array by ranks of prefixes of doubled lengths; the last letter is unique."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        behind = np.zeros(n, np.int64)
        if step < n:
            behind[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Places of all suffixes in order; ``text`` holds numbers below ``letters`` and ends with its only 0."""
    n = len(text)
    if n < 3 or letters * _POSITIONS_PER_LETTER > n and letters > 512:
        return _doubled(text)
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if not len(leftmost):
        return _induce(text, smaller, leftmost, letters)
    # Sort leftmost smaller substrings, name them, sort the names' suffixes.
    order = _induce(text, smaller, leftmost, letters)
    is_leftmost = np.zeros(n, bool)
    is_leftmost[leftmost] = True
    in_order = order[is_leftmost[order]]
    length = np.zeros(n, np.int64)
    length[leftmost] = np.concatenate([np.diff(leftmost) + 1, [1]])
    a, b = in_order[:-1], in_order[1:]
    same = length[a] == length[b]
    open_ = np.flatnonzero(same)
    k = 0
    while len(open_):
        equal = text[a[open_] + k] == text[b[open_] + k]
        same[open_[~equal]] = False
        open_ = open_[equal]
        k += 1
        open_ = open_[length[a[open_]] > k]
    name = np.empty(n, np.int64)
    name[in_order] = np.concatenate([[0], np.cumsum(~same)])
    reduced = name[leftmost]
    ranked = suffix_array(reduced, int(reduced.max()) + 1)
    return _induce(text, smaller, leftmost[ranked], letters)


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the suffix before it in order (-1: none) and the length of their common prefix.

    Where the letters before both suffixes agree, the length is one less than that of the place before. Only at other places,
    whose lengths have a small sum, letters are compared, eight at a time. ``text`` holds bytes.
    """
    n = len(text)
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    padded = np.concatenate([text.astype(np.uint8), np.zeros(16, np.uint8)])
    word = np.lib.stride_tricks.as_strided(padded, (n + 8, 8), (1, 1)).copy().view("<u8").ravel()
    place = np.arange(n)
    compare = (place == 0) | (previous <= 0)
    inner = np.flatnonzero(~compare)
    compare[inner] = padded[inner - 1] != padded[previous[inner] - 1]
    # The place before must have had the same two neighbours.
    compare[inner] |= previous[inner - 1] != previous[inner] - 1
    at = np.flatnonzero(compare & (previous >= 0))
    length = np.zeros(n, np.int64)
    open_, k = at, 0
    while len(open_):
        other = previous[open_]
        fits = np.maximum(open_, other) + k < n
        open_, other = open_[fits], other[fits]
        x = word[open_ + k] ^ word[other + k]
        equal = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8)
        length[open_] = np.minimum(k + equal, n - np.maximum(open_, other))
        open_ = open_[x == 0]
        k += 8
    last = np.maximum.accumulate(np.where(compare, place, 0))
    return previous, np.where(compare, length, np.maximum(length[last] - (place - last), 0))
