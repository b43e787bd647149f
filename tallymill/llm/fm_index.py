"""A depth-limited bidirectional FM-index over word ids.

Rows of the forward index are places sorted by the words that follow, rows of the backward index are places sorted by the
words that precede, each up to ``depth`` words. A phrase of at most so many words is one range of rows in
both; the column of words before the rows of the one, and behind the rows of the other, extend it to the left and to
the right. All ranges of a step are extended together, as arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Ranges:
    """Phrases as ranges of rows, of equal size in both indexes."""

    forward: np.ndarray
    backward: np.ndarray
    size: np.ndarray

    def pick(self, which: np.ndarray) -> Ranges:
        return Ranges(self.forward[which], self.backward[which], self.size[which])


@dataclass(frozen=True)
class Extended:
    """Phrases with one word more: which phrase they extend, that word, and their ranges."""

    parent: np.ndarray
    word: np.ndarray
    ranges: Ranges


class PhraseIndex:
    """Index of the words of ``ids``; 0 there separates, and no phrase reaches across it."""

    def __init__(self, ids: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.places = np.flatnonzero(ids)
        words = ids[self.places].astype(np.int64)
        joined = np.diff(self.places) == 1
        before = np.concatenate([[0], np.where(joined, words[:-1], 0)])[: len(words)]
        behind = np.concatenate([np.where(joined, words[1:], 0), [0]])[: len(words)]
        run = np.cumsum(np.concatenate([[True], ~joined])[: len(words)])
        self._forward_rank = _ranks(words, run, depth)
        self._backward_rank = _ranks(words[::-1], run[::-1], depth)
        self._backward_rank = [rank[::-1] for rank in self._backward_rank]
        self._rows = np.argsort(self._forward_rank[depth], kind="stable")
        self.before = _Column(before[self._rows], words, words[behind == 0])
        self.behind = _Column(behind[np.argsort(self._backward_rank[depth], kind="stable")], words, words[before == 0])

    def find(self, places: np.ndarray, length: int) -> Ranges:
        """The phrases of ``length`` words that begin at the given places of ``ids``."""
        at = np.searchsorted(self.places, places)
        forward, size = _row_ranges(self._forward_rank[length], at)
        backward, _ = _row_ranges(self._backward_rank[length], at + length - 1)
        return Ranges(forward, backward, size)

    def place(self, ranges: Ranges) -> np.ndarray:
        """A place where each phrase begins."""
        return self.places[self._rows[ranges.forward]]

    def extend_right(self, ranges: Ranges) -> Extended:
        """Every phrase of one word more at its end, with its count as the size of its ranges."""
        parent, word, size, backward, smaller = self.behind.extend(ranges.backward, ranges.size)
        return Extended(parent, word, Ranges(ranges.forward[parent] + smaller, backward, size))

    def extend_left(self, ranges: Ranges) -> Extended:
        """Every phrase of one word more at its beginning."""
        parent, word, size, forward, smaller = self.before.extend(ranges.forward, ranges.size)
        return Extended(parent, word, Ranges(forward, ranges.backward[parent] + smaller, size))


class _Column:
    """The words beside the rows of an index, with their ranks: how many equal words stand in rows above.

    Separators have no rows, so the rows of words at the ``ends`` of their runs, which come first, are reached by no rank.
    """

    def __init__(self, beside: np.ndarray, words: np.ndarray, ends: np.ndarray) -> None:
        self.beside = beside
        counts = np.bincount(words, minlength=1)
        self.first_row = np.cumsum(counts) - counts + np.bincount(ends, minlength=len(counts))
        order = np.argsort(beside, kind="stable")
        in_order = beside[order]
        self.rank = np.empty(len(beside), np.int64)
        self.rank[order] = np.arange(len(beside)) - np.searchsorted(in_order, in_order)

    def extend(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each range and each word beside it: the range, the word, how often, its first row in this index, and
        how many rows of the range have a smaller word or none."""
        which, rows = _spread(start, size)
        beside = self.beside[rows]
        order = np.argsort(which * (1 + self.beside.max(initial=0)) + beside, kind="stable")
        which, beside, rows = which[order], beside[order], rows[order]
        new = np.flatnonzero(np.diff(which, prepend=-1) | np.diff(beside, prepend=-1))
        count = np.diff(new, append=len(rows))
        smaller = new - (np.cumsum(size) - size)[which[new]]
        known = beside[new] > 0
        new, count, smaller = new[known], count[known], smaller[known]
        word = beside[new]
        return which[new], word, count, self.first_row[word] + self.rank[rows[new]], smaller


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all ranges, and which range each is of."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def _ranks(words: np.ndarray, run: np.ndarray, depth: int) -> list[np.ndarray]:
    """``ranks[d]`` orders places by their next ``d`` words; where a run ends earlier, the shorter comes first."""
    ranks = [np.zeros(len(words), np.int64), words]
    while len(ranks) <= depth:
        length = len(ranks)
        head = 1 << (length - 1).bit_length() - 1
        rest = ranks[length - head]
        tail = np.zeros(len(words), np.int64)
        tail[:-head] = np.where(run[head:] == run[:-head], 1 + rest[head:], 0)
        joint = ranks[head] * (2 + rest.max(initial=0)) + tail
        ranks.append(np.unique(joint, return_inverse=True)[1])
    return ranks


def _row_ranges(rank: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and number of rows of the places that rank like those given."""
    counts = np.bincount(rank, minlength=1)
    return (np.cumsum(counts) - counts)[rank[at]], counts[rank[at]]
