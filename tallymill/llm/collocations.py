"""Phrases whose words occur together more often than alone, by an FM-index for each shard of the corpus.

A shard holds the words of some texts of one language. Step by step, for phrases of one word, two words and so on, each
shard extends the phrases that the whole corpus has often enough, through the ranges of its bidirectional index: to the
right from the phrase without its last word, to the left from the phrase without its first word. What both give is counted
there, the counts are summed across shards, and the phrases that remain come back to the shards that hold them. So a
phrase leaves a shard as two numbers, those of its two parts, and only if both parts are frequent. The phrases of a shard travel
as packed arrays, dealt to buckets by a hash; the number of buckets grows with the corpus.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import saved, whole_text
from tallymill.llm.fm_index import PhraseIndex
from tallymill.scratch import remove

#: Bytes of text that a task holds before it closes its largest shard. It bounds memory, not what is counted.
SHARD_BYTES = 16 << 20

#: Bytes of text for each bucket that counts are summed in; phrases are dealt evenly, so this bounds a bucket.
BUCKET_BYTES = 16 << 20

#: Characters that end a piece; words are what blanks and tabs part within one.
PIECE_ENDS = r".,;:!?\x0A-\x0D"

_PARTS = re.compile(rf"[{PIECE_ENDS}]|[^\x20\x09{PIECE_ENDS}]+")
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_TEXTS = 256


class _Numbers(dict):
    """Words by number, from 1; what ends a piece is 0."""

    def __init__(self) -> None:
        self.ends = dict.fromkeys(".,;:!?\n\v\f\r", 0)
        super().__init__(self.ends)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self) - len(self.ends) + 1
        return number


class _Shard:
    def __init__(self) -> None:
        self.numbers, self.ids, self.bytes = _Numbers(), [], 0

    def add(self, text: str) -> None:
        lowered = text.encode().translate(_LOWER)
        self.bytes += len(lowered)
        self.ids.append(np.fromiter(map(self.numbers.__getitem__, _PARTS.findall(lowered.decode())), np.uint32))
        self.ids.append(np.zeros(1, np.uint32))

    def rows(self, number: int, lang: str, buckets: int) -> Iterator[pa.RecordBatch]:
        """The ids, and for each bucket its words with their first places and counts."""
        ids = np.concatenate(self.ids)
        words = [*self.numbers][len(self.numbers.ends) :]
        if not words:
            return
        yield _batch(_SHARD, shard=[number], lang=[lang], ids=[_packed(ids)], n=[np.count_nonzero(ids)])
        first = np.zeros(1 + len(words), np.int64)
        first[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
        counts = np.bincount(ids, minlength=1 + len(words))
        bucket = np.fromiter((zlib.crc32(word.encode()) for word in words), np.int64, len(words)) % buckets
        words = np.array(words, object)
        for number_of_bucket, at in _by_bucket(bucket, first[1:]):
            yield _batch(
                _SHARD,
                shard=[number],
                lang=[lang],
                bucket=[number_of_bucket],
                places=[_packed(first[1:][at], ascending=True)],
                words=[_compressed("\n".join(words[at]).encode())],
                counts=[_packed(counts[1:][at])],
            )


def _by_bucket(bucket: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with what it holds, in order of places."""
    order = np.lexsort((places, bucket))
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    start = 0
    for end in ends.tolist():
        yield int(bucket[order[start]]), order[start:end]
        start = end


_SHARD = pa.schema(
    [
        ("shard", pa.int64()),
        ("lang", pa.string()),
        ("ids", pa.binary()),
        ("n", pa.int64()),
        ("bucket", pa.int32()),
        ("places", pa.binary()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
    ]
)
_CANDIDATES = pa.schema(
    [
        ("shard", pa.int64()),
        ("bucket", pa.int32()),
        ("places", pa.binary()),
        ("heads", pa.binary()),
        ("tails", pa.binary()),
        ("counts", pa.binary()),
    ]
)
_FREQUENT = pa.schema(
    [
        ("of", pa.int64()),
        ("length", pa.int32()),
        ("places", pa.binary()),
        ("ids", pa.binary()),
        ("id", pa.int64()),
        ("head", pa.int64()),
        ("tail", pa.int64()),
        ("lang", pa.string()),
        ("phrase", pa.string()),
        ("f", pa.int64()),
    ]
)
_KINDS = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_KINDS[f.type]}" for f in schema)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    count = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers from 0, as steps if they ascend: the first bytes of all, then the second ones and so on, compressed."""
    values = np.diff(values, prepend=0) if ascending else values
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + _compressed(np.ascontiguousarray(planes.T).tobytes())


def _unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, : data[0]] = planes.T
    values = values.reshape(-1).view("<i8")
    return np.cumsum(values) if ascending else values


def _shards(rows: DataFrame, shard_bytes: int, buckets: int) -> DataFrame:
    """Rows of two kinds: a shard (``ids``) and its distinct words in a bucket (``words``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_shards: dict[str, _Shard] = {}
        held = 0
        for batch in batches:
            for part in (batch.slice(i, _TEXTS) for i in range(0, batch.num_rows, _TEXTS)):
                for lang, text in zip(*(column.to_pylist() for column in part.columns), strict=True):
                    shard = open_shards.get(lang)
                    if shard is None:
                        shard = open_shards[lang] = _Shard()
                    before = shard.bytes
                    shard.add(text)
                    held += shard.bytes - before
                    if held >= shard_bytes:
                        largest = max(open_shards, key=lambda name: open_shards[name].bytes)
                        shard = open_shards.pop(largest)
                        yield from shard.rows(number, largest, buckets)
                        held, number = held - shard.bytes, number + 1
        for lang, shard in open_shards.items():
            yield from shard.rows(number, lang, buckets)
            number += 1

    return rows.mapInArrow(run, _ddl(_SHARD))


def _answers(rows: pa.Table, length: int, key_of: np.ndarray, sums: np.ndarray, least: int, buckets: int) -> tuple[list, np.ndarray]:
    """What goes back to each shard: the places and ids of its frequent phrases. And the ids of the keys, -1 where rare.

    ``key_of`` holds the key of each phrase of each row, row after row, ``sums`` the counts of the keys.
    """
    ids = np.full(len(sums), -1)
    frequent = sums >= least
    ids[frequent] = np.arange(np.count_nonzero(frequent)) * buckets + rows["bucket"][0].as_py()
    found, start = [], 0
    for shard, places in zip(rows["shard"].to_pylist(), rows["places"].to_pylist(), strict=True):
        places = _unpacked(places, ascending=True)
        own = ids[key_of[start : start + len(places)]]
        start += len(places)
        kept = own >= 0
        if kept.any():
            packed = {"places": [_packed(places[kept], ascending=True)], "ids": [_packed(own[kept])]}
            found.append(_batch(_FREQUENT, of=[shard], length=[length], **packed))
    return found, ids


def _frequent_words(least: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        lists = [zstandard.ZstdDecompressor().decompress(data).decode().split("\n") for data in rows["words"].to_pylist()]
        langs = rows["lang"].to_pylist()
        words = pd.DataFrame({"lang": np.repeat(langs, [*map(len, lists)]), "word": [word for words in lists for word in words]})
        words["n"] = np.concatenate([_unpacked(data) for data in rows["counts"].to_pylist()])
        by_key = words.groupby(["lang", "word"], sort=False)
        key_of, sums = by_key.ngroup().to_numpy(), by_key["n"].sum()
        found, ids = _answers(rows, 1, key_of, sums.to_numpy(), least, buckets)
        named = sums.reset_index()[ids >= 0]
        columns = {"id": ids[ids >= 0], "lang": named["lang"], "phrase": named["word"], "f": named["n"]}
        return pa.Table.from_batches([*found, _batch(_FREQUENT, **columns)])

    return run


def _frequent_phrases(length: int, least: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        heads, tails, counts = (
            np.concatenate([_unpacked(data) for data in rows[name].to_pylist()]) for name in ("heads", "tails", "counts")
        )
        order = np.lexsort((tails, heads))
        heads, tails = heads[order], tails[order]
        new = (np.diff(heads, prepend=-1) != 0) | (np.diff(tails, prepend=-1) != 0)
        first = np.flatnonzero(new)
        key_of = np.empty(len(order), np.int64)
        key_of[order] = np.cumsum(new) - 1
        sums = np.add.reduceat(counts[order], first)
        found, ids = _answers(rows, length, key_of, sums, least, buckets)
        kept = ids >= 0
        columns = {"id": ids[kept], "head": heads[first][kept], "tail": tails[first][kept], "f": sums[kept]}
        return pa.Table.from_batches([*found, _batch(_FREQUENT, **columns)])

    return run


def _labels(ids: np.ndarray, known: dict[int, np.ndarray], length: int) -> np.ndarray:
    """For each place of a shard the frequent phrase of ``length`` words that begins there, by its number, or -1.

    ``known`` holds a place of each frequent phrase of each length up to this one. A phrase is known by the numbers of its two
    parts, which overlap in all but a word at either end.
    """
    numbers = np.full(1 + ids.max(), -1)
    numbers[ids[known[1]]] = np.arange(len(known[1]))
    label = numbers[ids]
    for size in range(2, length + 1):
        places, base = known[size], 1 + len(known[size - 1])
        pair = np.where((label[:-1] >= 0) & (label[1:] >= 0), label[:-1] * base + label[1:], -1)
        wanted = pair[places]
        order = np.argsort(wanted)
        at = np.minimum(np.searchsorted(wanted, pair, sorter=order), len(wanted) - 1)
        label = np.append(np.where(wanted[order[at]] == pair, order[at], -1), -1)
    return label


def _candidates(length: int, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """From a shard and its frequent phrases of fewer words to its candidates of ``length`` words."""

    def run(shard: pa.Table, answers: pa.Table) -> pa.Table:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, *packed in zip(*(answers[name].to_pylist() for name in ("length", "places", "ids")), strict=True):
            parts.setdefault(size, []).append((_unpacked(packed[0], ascending=True), _unpacked(packed[1])))
        if not shard.num_rows or length - 1 not in parts:
            return _CANDIDATES.empty_table()
        known = {size: np.concatenate([places for places, _ in found]) for size, found in parts.items()}
        names = np.concatenate([ids for _, ids in parts[length - 1]])
        ids = _unpacked(shard["ids"][0].as_py())
        inside = np.zeros(len(ids), bool)
        begins = np.flatnonzero(_labels(ids, known, length - 1) >= 0)
        for k in range(length - 1):
            inside[begins + k] = True
        index = PhraseIndex(np.where(inside, ids, 0), length)
        ranges = index.find(known[length - 1], length - 1)
        right, left = index.extend_right(ranges), index.extend_left(ranges)
        _, i, j = np.intersect1d(right.ranges.forward, left.ranges.forward, assume_unique=True, return_indices=True)
        found = right.ranges.pick(i)
        places, heads, tails = index.place(found), names[right.parent[i]], names[left.parent[j]]
        mixed = heads.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ tails.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        number = shard["shard"][0].as_py()
        rows = [
            _batch(
                _CANDIDATES,
                shard=[number],
                bucket=[of],
                places=[_packed(places[at], ascending=True)],
                heads=[_packed(heads[at])],
                tails=[_packed(tails[at])],
                counts=[_packed(found.size[at])],
            )
            for of, at in _by_bucket(bucket, places)
        ]
        return pa.Table.from_batches(rows, _CANDIDATES)

    return run


def _score(occurrences: int) -> Column:
    """The lowest score of all cuts, and the counts of its two parts, for phrases of so many words."""

    def cut(k: int) -> str:
        left, right = f"heads[{k - 1}]", f"tails[{occurrences - k - 1}]"
        product = f"CAST({left} AS DECIMAL(38, 0)) * {right}"
        score = f"(CAST(1000 AS DECIMAL(38, 0)) * f * n) div ({product})"
        return f"named_struct('score', {score}, 'cut', {k}, 'l', {left}, 'r', {right})"

    return F.expr(f"array_min(array({', '.join(cut(k) for k in range(1, occurrences))}))")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The phrases of each language that stand out most: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are split at ``PIECE_ENDS`` into pieces and at blanks and tabs into words, with A-Z in lower case. Candidates are the
    phrases of 2 to ``longest`` words that a language has ``a >= least`` times, overlaps included. Cut behind its
    k-th word, a phrase has parts that occur ``l`` and ``r`` times; of all cuts the one with the lowest
    ``score = floor(1000 * a * n / (l * r))`` counts, the first of equal ones, where ``n`` is the number of words. A candidate
    that lies inside a longer one of the same count is dropped. ``top`` phrases of each language follow by score, count and
    phrase.

    A null language is ``und``; a null text is empty. Repeated rows count each. An empty table, or one without frequent
    phrases, gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    kept: list[str] = []
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(language.alias("lang"), whole_text(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    shards = saved(_shards(rows, shard_bytes, buckets), "shards", kept)
    words = shards.filter("words IS NOT NULL").select("bucket", "shard", "lang", "places", "words", "counts")
    shards = shards.filter("ids IS NOT NULL").select("shard", "lang", "ids", "n")
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = saved(words.groupBy("bucket").applyInArrow(_frequent_words(least, buckets), _ddl(_FREQUENT)), "frequent-1", kept)
    found = frequent.filter("id IS NOT NULL")
    counts = F.array("f").alias("heads"), F.array("f").alias("tails")
    nothing = F.lit(None).cast("bigint")
    phrases = found.select("id", nothing.alias("head"), nothing.alias("tail"), "lang", "phrase", F.col("phrase").alias("last"), "f", *counts)
    answers = frequent.filter("of IS NOT NULL").select("of", "length", "places", "ids")
    results = []
    for length in range(2, longest + 1):
        step = shards.select("shard", "ids").groupBy("shard").cogroup(answers.groupBy("of"))
        candidates = saved(step.applyInArrow(_candidates(length, buckets), _ddl(_CANDIDATES)), f"candidates-{length}", kept)
        summed = candidates.groupBy("bucket").applyInArrow(_frequent_phrases(length, least, buckets), _ddl(_FREQUENT))
        frequent = saved(summed, f"frequent-{length}", kept)
        shorter, phrases = phrases, _named(frequent.filter("id IS NOT NULL").select("id", "head", "tail", "f"), phrases, length, kept)
        if length > 2:
            results.append(_not_inside(shorter, phrases, length - 1))
        answers = answers.unionByName(frequent.filter("of IS NOT NULL").select("of", "length", "places", "ids"))
    results.append(phrases.withColumn("words", F.lit(longest)))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    by_words = F.coalesce(*[F.when(F.col("words") == m, _score(m)) for m in range(2, longest + 1)])
    scored = found.join(totals, "lang").withColumn("best", by_words)
    scored = scored.select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    ranked = ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    result = saved(ranked, "collocations")
    for path in kept:
        remove(spark, path)
    return result


def _named(frequent: DataFrame, shorter: DataFrame, length: int, kept: list[str]) -> DataFrame:
    """Phrases in words, with the counts of all that they begin and end with, shortest first."""
    heads = shorter.select(F.col("id").alias("head"), "lang", F.col("phrase").alias("begin"), F.col("heads").alias("begins"))
    tails = shorter.select(F.col("id").alias("tail"), "last", F.col("tails").alias("ends"))
    joined = frequent.join(heads, "head").join(tails, "tail")
    return saved(
        joined.select(
            "id",
            "head",
            "tail",
            "lang",
            F.concat_ws(" ", "begin", "last").alias("phrase"),
            "last",
            "f",
            F.concat("begins", F.array("f")).alias("heads"),
            F.concat("ends", F.array("f")).alias("tails"),
        ),
        f"phrases-{length}",
        kept,
    )


def _not_inside(phrases: DataFrame, longer: DataFrame, words: int) -> DataFrame:
    """Phrases of so many words that no phrase of one word more holds as often.

    Where a still longer one does, so does one between.
    """
    holding = longer.select(F.explode(F.array("head", "tail")).alias("id"), "f").distinct()
    return phrases.join(holding, ["id", "f"], "left_anti").withColumn("words", F.lit(words))
