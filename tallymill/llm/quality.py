"""Quality classifier from weak labels.

Heuristic labellers each vote good, bad or nothing on a document. Expectation-maximisation over the counts of all vote
patterns estimates how often each labeller votes what for good and for bad documents, without any true label, and
so the probability that a pattern belongs to a good one. These posteriors train a linear scorer on hashed word
features, which then judges every document.
"""

from __future__ import annotations

import functools
import math
import operator
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import saved, whole_text

NOTHING, BAD, GOOD = 0, 1, 2
LABELLERS = ("capitals", "marks", "plain_words", "repeats", "variety", "sentences", "word_length")
#: Documents with features that the scorer is trained on, at most; those whose hash is smallest.
TRAINING_DOCUMENTS = 4000
BUCKETS = 1024
#: Documents that score less are rejected. Scores of very short texts lie between those of good and bad ones.
KEEP_FROM = 0.2
_KEPT_WORDS = 200_000
_PUNCTUATION = ".,;:!?\"'()-"
_MARKS = "%&$*#|!@^~<>{}[]=+\\"

# Scripts that write no blanks between words (Thai, Lao, Tibetan, Burmese, Khmer, kana, ideographs), and wide marks
# with those that they stand for.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WIDE = dict(zip("、。，．！？；：（）「」『』", ",.,.!?;:()\"\"\"\"", strict=True))
_BEGINS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_UNITS = re.compile(f"[{_UNSPACED}]{{1,2}}[{''.join(_WIDE)}]*|[^{_UNSPACED}]+")


def units(text: str) -> list[str]:
    """The words of a text: runs of characters other than white space, and pairs of characters where a script has no blanks."""
    words = text.split()
    if text.isascii() or not _BEGINS_UNSPACED.search(text):
        return words
    return [unit for word in words for unit in _UNITS.findall(word)]


# Labellers


def _vote(value: float, good: tuple[float, float], bad_below: float, bad_above: float) -> int:
    if value < bad_below or value > bad_above:
        return BAD
    return GOOD if good[0] <= value <= good[1] else NOTHING


def votes(text: str, words: list[str]) -> list[int]:
    """One vote of each labeller; none on a text of fewer than five words."""
    count = len(words)
    if count < 5:
        return [NOTHING] * len(LABELLERS)
    marks = sum(map(text.count, _MARKS)) / count
    ends = sum(map(text.count, ".?;:。？；：")) / count
    repeats = sum(map(operator.eq, words, words[1:])) / count
    plain = sum(w.strip(_PUNCTUATION).isalpha() or w[0] > "\u0dff" and _BEGINS_UNSPACED.match(w) is not None for w in words) / count
    variety = len({*words}) / count ** 0.9
    return [
        _vote(sum(map(str.isupper, words)) / count, (0, 0.2), -1, 0.4),
        _vote(marks, (0, 0.1), -1, 0.25),
        _vote(plain, (0.85, 1), 0.75, 1),
        _vote(repeats, (0, 0.05), -1, 0.15),
        _vote(variety, (0.3, 9), 0.12, 9) if count >= 40 else NOTHING,
        _vote(ends, (0.015, 0.4), 0.002 if count >= 100 else -1, 1),
        _vote(sum(map(len, words)) / count, (3, 11), 2 if text.isascii() else 1.5, 25),
    ]


def pattern(found: list[int]) -> int:
    return functools.reduce(lambda number, vote: 3 * number + vote, found, 0)


def pattern_votes(number: int) -> list[int]:
    return [number // 3**i % 3 for i in range(len(LABELLERS) - 1, -1, -1)]


class Posterior(NamedTuple):
    prior: float
    #: By class (bad, good), labeller and vote.
    chances: np.ndarray
    good: dict[int, float]


def estimate(counts: dict[int, int], rounds: int = 200) -> Posterior:
    """Dawid and Skene's estimate of the labellers' accuracies from the number of documents of each pattern.

    It starts from rare false alarms, and from bad documents that set off a few labellers each.
    """
    patterns = np.array(sorted(counts), np.int64)
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    cast = np.array([pattern_votes(p) for p in patterns.tolist()]).reshape(len(patterns), len(LABELLERS))
    shown = cast[:, :, None] == np.arange(3)
    prior = 0.8
    chances = np.empty((2, len(LABELLERS), 3))
    chances[0], chances[1] = (0.2, 0.3, 0.5), (0.19, 0.01, 0.8)
    good = np.full(len(patterns), prior)
    for _ in range(rounds if len(patterns) else 0):
        logs = np.where(shown, np.log(chances)[:, None], 0).sum(axis=(2, 3)) + np.log([[1 - prior], [prior]])
        good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        for k, belief in enumerate((1 - good, good)):
            seen = (weight * belief)[:, None, None] * shown
            chances[k] = (seen.sum(axis=0) + 0.1) / (weight @ belief + 0.3)
        prior = float(np.clip(weight @ good / weight.sum(), 1e-3, 1 - 1e-3))
    return Posterior(prior, chances, dict(zip(patterns.tolist(), good.tolist(), strict=True)))


# Scorer


def _kind(c: str) -> str:
    if c.isupper():
        return "A"
    return "a" if c.isalpha() or _BEGINS_UNSPACED.match(c) else "0" if c.isdigit() else _WIDE.get(c, c)


_KINDS = {i: _kind(chr(i)) for i in range(0x250)}
_RUN = re.compile(r"(.)\1+", re.DOTALL)


def word_features(word: str) -> tuple[int, int]:
    """Buckets of a word's shape, with runs of a kind written once, and of its length."""
    shape = word.translate(_KINDS)
    if max(shape) > "\u024f":
        shape = "".join(map(_kind, shape))
    length = min(len(word), 8) if len(word) < 20 else 9
    return zlib.crc32(_RUN.sub(r"\1", shape).encode()) % BUCKETS, zlib.crc32(b"length %d" % length) % BUCKETS


_REPEAT = zlib.crc32(b"as before") % BUCKETS


def features(words: list[str]) -> np.ndarray:
    """Share of words with each feature."""
    found = np.zeros(BUCKETS, np.float32)
    if words:
        both = np.array([*map(word_features, words)])
        found += np.bincount(both.ravel(), minlength=BUCKETS)
        found[_REPEAT] += sum(map(operator.eq, words, words[1:]))
        found /= len(words)
    return found


class _WordScores(dict):
    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights.tolist()

    def __missing__(self, word: str) -> float:
        shape, length = word_features(word)
        value = self.weights[shape] + self.weights[length]
        if len(self) >= _KEPT_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


@functools.lru_cache(1)
def _word_scores(weights: bytes) -> _WordScores:
    return _WordScores(np.frombuffer(weights))


class Scorer(NamedTuple):
    weights: bytes
    bias: float

    def score(self, words: list[str]) -> float:
        """Probability that the document is good; 0 without words."""
        if not words:
            return 0.0
        known = _word_scores(self.weights)
        total = sum(map(known.__getitem__, words)) + known.weights[_REPEAT] * sum(map(operator.eq, words, words[1:]))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total / len(words) + self.bias))))


def train(rows: np.ndarray, good: np.ndarray, rounds: int = 300) -> Scorer:
    """Logistic regression on soft labels, by gradient steps with momentum."""
    weights, bias = np.zeros(BUCKETS), 0.0
    if len(rows):
        used = np.flatnonzero(rows.any(axis=0))
        inputs, own = rows[:, used].astype(float), np.zeros(len(used))
        share = float(np.clip(good.mean(), 0.05, 0.95))
        bias, speed, pace, slide = float(np.log(share / (1 - share))), np.zeros(len(used)), 0.0, 8.0
        for _ in range(rounds):
            error = (1 / (1 + np.exp(-np.clip(inputs @ own + bias, -30, 30))) - good) / len(rows)
            speed = 0.9 * speed - slide * (inputs.T @ error + 1e-5 * own)
            pace = 0.9 * pace - 0.5 * error.sum()
            own, bias = own + speed, bias + pace
        weights[used] = own
    else:
        bias = 1.0
    return Scorer(weights.tobytes(), bias)


# The operator


def fit(docs: DataFrame, text: str = "text", training: int = TRAINING_DOCUMENTS) -> tuple[Posterior, Scorer]:
    """Accuracies from the votes on all documents; a scorer from at most ``training`` of them."""
    total = docs.count()
    rate = min(1.0, 1.5 * training / max(1, total))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text, hashed, chosen in zip(batch["text"], batch["hash"], batch["chosen"], strict=True):
                words = units(text)
                inputs = features(words).tobytes() if words and chosen else None
                found.append((pattern(votes(text, words)) if words else -1, hashed, inputs))
            yield pd.DataFrame(found, columns=["pattern", "hash", "features"])

    share = F.pmod(F.col("hash"), F.lit(1_000_003)) / 1_000_003
    rows = docs.select(whole_text(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    judged = saved(
        rows.withColumn("chosen", share < rate).mapInPandas(run, "pattern int, hash bigint, features binary"), "votes"
    )
    counts = {r["pattern"]: r["n"] for r in judged.filter("pattern >= 0").groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    posterior = estimate(counts)
    chosen = judged.filter("features IS NOT NULL").orderBy("hash", "pattern").limit(training).collect()
    inputs = np.array([np.frombuffer(r["features"], np.float32) for r in chosen], np.float32).reshape(len(chosen), BUCKETS)
    return posterior, train(inputs, np.array([posterior.good[r["pattern"]] for r in chosen]))


def score_column(scorer: Scorer, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([scorer.score(units(x)) for x in texts], dtype="float64")

    return score(whole_text(text))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score, good``.

    ``score`` is the scorer's probability that the document is good and ``good`` says whether it stays. Words
    are runs of characters other than white space, or pairs of characters in scripts without blanks. A null, empty or blank document scores 0. Rows that repeat an id, or have
    none, are judged each; an empty table gives an empty result. Other columns are not read.
    """
    _, scorer = fit(docs, text)
    scored = docs.select(F.col(doc_id).alias("doc_id"), score_column(scorer, text).alias("score"))
    return scored.withColumn("good", F.col("score") >= KEEP_FROM)


def kept_share(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    """``by, documents, kept``: the share of documents that stay for each value of a column, such as the language."""
    _, scorer = fit(docs, text)
    kept = (score_column(scorer, text) >= KEEP_FROM).cast("int").alias("kept")
    scored = docs.select(F.col(by).alias("by"), kept)
    return scored.groupBy("by").agg(F.count(F.lit(1)).alias("documents"), F.avg("kept").alias("kept")).withColumnRenamed("by", by)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that score ``KEEP_FROM`` or more, with their own columns."""
    _, scorer = fit(docs, text)
    return docs.filter(score_column(scorer, text) >= KEEP_FROM)
