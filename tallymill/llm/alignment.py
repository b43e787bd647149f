"""Alignment of two tokenizers over the same bytes, by pointer jumping.

Every token points to its farthest-right overlapping token of the other tokenizer, or to itself where none reaches
further; doubling these pointers brings each token to the last token of its component, which labels the group. The
tokens of many words are aligned at once, as arrays.

A single space between two other characters begins a token of both tokenizers, so texts fall into words that
are aligned once for each block of documents. A block tells its distinct id pairs and their counts; the corpus-wide counts
come back to the block by a join, so that neither links nor pair tables pass through one task or the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymill.llm.common import saved, whole_text
from tallymill.llm.tokens import byte_symbols
from tallymill.scratch import remove

#: Bytes of text behind which a block ends. It bounds what a task holds, not what is counted.
BLOCK_BYTES = 16 << 20

_GAP = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"
_DOCS = 256
#: Characters of words that are encoded in one call.
_CALL = 1 << 19


class TokenPair:
    """Two tokenizer files, and the bytes that their tokens stand for."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        vocab = self.a.get_vocab()
        self.bytes_a = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.vocab_size())]
        if any(_SPACE in self.b.id_to_piece(i).lstrip(_SPACE) for i in range(self.b.vocab_size())):
            raise ValueError("a piece goes on behind the end of a word")
        self.size_a, self.size_b = (np.array([*map(len, tokens)]) for tokens in (self.bytes_a, self.bytes_b))
        self.names_a, self.names_b = ([*map(str, range(len(tokens)))] for tokens in (self.bytes_a, self.bytes_b))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(_SPACE, " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a space and the text; None where either does not give back its bytes."""
        whole = (" " + text).encode()
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b)) != whole:
            return None
        return np.array(ids_a, np.int64), np.array(ids_b, np.int64)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token of A, then of B, the last token of its component, numbered so.

    Both arrays hold where tokens end, ascending, and have the same last place.
    """
    n = len(ends_a)
    over_a = n + np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    itself = n + np.arange(len(ends_b))
    successor = np.concatenate([over_a, np.where(ends_a[over_b] > ends_b, over_b, itself)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


class _Block:
    """Words of some documents with their alignments, each aligned once."""

    def __init__(self, pair: TokenPair) -> None:
        self.pair = pair
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes: list[np.ndarray] = []  # of each word: tokens of A, of B, groups
        self.links: list[np.ndarray] = []  # id pairs, word after word
        self.words: list[np.ndarray] = []  # of each document
        self.bytes = 0

    def learn(self, words: list[str]) -> None:
        """Align words that are not known yet, joined by spaces where those part tokens: no white space lies beside them."""
        plain = [w for w in words if w and _SPACE not in w and not w[0].isspace() and not w[-1].isspace()]
        odd = set(words).difference(plain)
        start = 0
        while start < len(plain):
            end, held = start, 0
            while end < len(plain) and (held := held + len(plain[end]) + 1) <= _CALL:
                end += 1
            self._learn_joined(plain[start : max(end, start + 1)])
            start = max(end, start + 1)
        for word in sorted(odd):
            self._learn_joined([word])

    def _learn_joined(self, words: list[str]) -> None:
        ids = self.pair.encode(" ".join(words))
        if ids is not None:
            places = np.cumsum([len(w.encode()) + 1 for w in words])
            if self._add(*ids, places):
                self.number.update(zip(words, range(len(self.groups) - len(words), len(self.groups)), strict=True))
                return
        if len(words) == 1:
            self.number[words[0]] = -1
        else:
            middle = len(words) // 2
            self._learn_joined(words[:middle])
            self._learn_joined(words[middle:])

    def _add(self, ids_a: np.ndarray, ids_b: np.ndarray, places: np.ndarray) -> bool:
        """Align tokens; words end at ``places``. False where a word does not end with a token of both."""
        pair = self.pair
        ends_a, ends_b = np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b])
        to_a, to_b = np.searchsorted(ends_a, places), np.searchsorted(ends_b, places)
        if not (np.array_equal(ends_a[to_a], places) and np.array_equal(ends_b[to_b], places)):
            return False
        label = terminals(ends_a, ends_b)
        of_a, of_b = label[: len(ids_a)], label[len(ids_a) :]
        last_a = np.flatnonzero(np.diff(of_a, append=-1)) + 1
        last_b = np.flatnonzero(np.diff(of_b, append=-1)) + 1
        a = [*map(pair.names_a.__getitem__, ids_a.tolist())]
        b = [*map(pair.names_b.__getitem__, ids_b.tolist())]
        groups, i, j = [], 0, 0
        for k, m in zip(last_a.tolist(), last_b.tolist(), strict=True):
            groups.append(f"{a[i]}|{b[j]}" if k - i == 1 == m - j else f"{','.join(a[i:k])}|{','.join(b[j:m])}")
            i, j = k, m
        to_group = np.searchsorted(last_a, to_a + 1) + 1
        start = 0
        for end in to_group.tolist():
            self.groups.append(groups[start] if end - start == 1 else ";".join(groups[start:end]))
            start = end
        self.sizes.append(np.diff(np.stack([to_a + 1, to_b + 1, to_group]), axis=1, prepend=0).T)
        cuts = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        self.links.append(ids_a[at_a] * len(pair.bytes_b) + ids_b[at_b])
        return True

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[bytes]]:
        """Counts, groups and words of each text."""
        cut = [_GAP.split(text) if text else [] for text in texts]
        self.learn(sorted(set().union(*cut).difference(self.number)))
        found = []
        for text, words in zip(texts, cut, strict=True):
            numbers = [*map(self.number.__getitem__, words)]
            if -1 in numbers:
                ids = self.pair.encode(text)
                known = ids is not None and self._add(*ids, np.array([len(text.encode()) + 1]))
                numbers = [len(self.groups) - 1] if known else []
            found.append(np.array(numbers, np.uint32))
            self.bytes += len(text)
        self.words += found
        sizes = np.concatenate([*self.sizes, np.empty((0, 3), np.int64)])
        self.sizes = [sizes]
        counts = np.array([sizes[numbers].sum(0) for numbers in found], np.int64).reshape(-1, 3)
        groups = [";".join(map(self.groups.__getitem__, numbers.tolist())) for numbers in found]
        return counts, groups, [numbers.tobytes() for numbers in found]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs and their counts; for each link of each word its pair, and the links of each word."""
        sizes = np.concatenate([*self.sizes, np.empty((0, 3), np.int64)])
        per_word = sizes[:, 0] + sizes[:, 1] - sizes[:, 2]
        links = np.concatenate([*self.links, np.empty(0, np.int64)])
        numbers = np.concatenate([*self.words, np.empty(0, np.uint32)])
        times = np.bincount(numbers, minlength=len(per_word)) if len(numbers) else np.zeros(len(per_word), np.int64)
        distinct, which = np.unique(links, return_inverse=True)
        counts = np.bincount(which, weights=np.repeat(times, per_word), minlength=len(distinct))
        return distinct, counts.astype(np.int64), which, per_word


_ALIGNED = pa.schema(
    [
        ("block", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("groups", pa.string()),
        ("words", pa.binary()),
        ("per_word", pa.binary()),
        ("place", pa.int32()),
        ("a", pa.int32()),
        ("b", pa.int32()),
        ("n", pa.int64()),
    ]
)
_KINDS = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}


def _rows(**columns) -> pa.RecordBatch:
    count = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in _ALIGNED]
    return pa.RecordBatch.from_arrays(arrays, schema=_ALIGNED)


def _aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool, block_bytes: int) -> DataFrame:
    """Rows of three kinds: documents (``words``), blocks (``per_word``) and distinct id pairs of a block (``place``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = TokenPair(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        block = _Block(pair)
        for batch in batches:
            for part in (batch.slice(i, _DOCS) for i in range(0, batch.num_rows, _DOCS)):
                counts, groups, words = block.align(part.column(1).to_pylist())
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                n_a, n_b, n_groups = counts.T
                yield _rows(
                    block=np.full(len(words), number), doc_id=part.column(0), n_a=n_a, n_b=n_b, n_groups=n_groups, groups=groups, words=words
                )
                if block.bytes >= block_bytes:
                    yield from close(block, number, pair)
                    block, number = _Block(pair), number + 1
        yield from close(block, number, pair)

    def close(block: _Block, number: int, pair: TokenPair) -> Iterator[pa.RecordBatch]:
        distinct, counts, which, per_word = block.pairs()
        if not len(distinct):
            return
        yield _rows(block=[number], words=[which.astype(np.uint32).tobytes()], per_word=[per_word.astype(np.uint32).tobytes()])
        a, b = np.divmod(distinct, len(pair.bytes_b))
        for i in range(0, len(distinct), 1 << 16):
            to = min(len(distinct), i + (1 << 16))
            yield _rows(
                block=np.full(to - i, number),
                place=np.arange(i, to, dtype=np.int32),
                a=a[i:to].astype(np.int32),
                b=b[i:to].astype(np.int32),
                n=counts[i:to],
            )

    schema = ", ".join(f"{f.name} {_KINDS[f.type]}" for f in _ALIGNED)
    return docs.mapInArrow(run, schema)


def _with_counts(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of one block with the sums over their links, from the corpus-wide counts of the block's id pairs."""
    is_block = np.array(rows["per_word"].is_valid())
    docs = rows.filter(pa.array(~is_block))
    words = [np.frombuffer(w, np.uint32) for w in docs["words"].to_pylist()]
    total, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if is_block.any():
        ((which, per_word),) = zip(*(rows.filter(pa.array(is_block))[n].to_pylist() for n in ("words", "per_word")), strict=True)
        which, per_word = np.frombuffer(which, np.uint32), np.frombuffer(per_word, np.uint32).astype(np.int64)
        order = np.argsort(answers["place"].to_numpy())
        ends = np.concatenate([[0], np.cumsum(per_word)])

        def by_word(name: str) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(answers[name].to_numpy()[order][which].astype(np.int64))])
            return np.diff(running[ends])

        total, best = by_word("total"), by_word("best")
    columns = [docs[n] for n in ("doc_id", "n_a", "n_b", "n_groups")]
    links = np.array(docs["n_a"]) + np.array(docs["n_b"]) - np.array(docs["n_groups"])
    sums = [np.array([int(of[w].sum()) for w in words], np.int64) for of in (best, total)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return pa.table([*columns, links, *sums, docs["groups"]], names=names)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, total, best``: how many links hold each id pair, and whether no partner of its B id has more.

    The highest counts are one row for each id of B at most, so that the vocabulary bounds the broadcast.
    """
    totals = saved(aligned.filter("place IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("total")), "pair-totals")
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    marked = totals.join(F.broadcast(highest), "b")
    return marked.select("a", "b", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``path_a`` is a byte-level BPE file, whose tokens are those of a space and the text; ``path_b`` is a piece model that
    adds that space itself. Byte places where tokens of both end cut them into groups, written as ``a1,a2|b1;a3|b2,b3``
    in ``groups`` or, with ``digest``, as the SHA-256 of that. Links are the pairs of overlapping tokens; ``count_sum`` adds up
    how many links of the corpus hold each link's two ids, and ``n_best`` counts links whose ids occur as often as any
    of their B id.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros and an
    empty ``groups``. They add nothing to the counts. Repeated ids and rows are rows of their own; null ids stay null. An
    empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    kept: list[str] = []
    aligned = saved(_aligned(docs.select(F.col(doc_id).cast("bigint"), whole_text(text)), path_a, path_b, digest, block_bytes), "aligned", kept)
    pairs = saved(pair_counts(aligned), "pair-counts", kept)
    asked = aligned.filter("place IS NOT NULL").select(F.col("block").alias("of"), "place", "a", "b")
    answers = asked.join(pairs, ["a", "b"]).select("of", "place", "total", "best")
    rows = aligned.filter("words IS NOT NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "groups", "words", "per_word")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
    counted = saved(rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_with_counts, schema), "alignment")
    for path in kept:
        remove(spark, path)
    return counted
