"""Packing of token sequences: first-fit decreasing in randomised groups, with a tournament tree of bin capacities."""

from __future__ import annotations

import base64
import functools
import zlib
from array import array
from typing import NamedTuple

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import by_row, saved, whole_text
from tallymill.llm.tokens import SETTLED, Kept, chunks, load

CAPACITY = 2048
END_ID = 1
#: A group has about this many tokens, and pieces, at most: what one task packs.
GROUP_TOKENS, GROUP_PIECES = 2_000_000, 65_536


class Encoder(NamedTuple):
    """The quicker library, what it must not be given, and ids of chunks for texts that hold such."""

    quick: tiktoken.Encoding
    added: list[str]
    kept: Kept

    def takes(self, text: str) -> bool:
        return _settled(text) and not any(t in text for t in self.added)


def _settled(text: str) -> bool:
    try:
        text.encode("latin-1")  # tells of most texts without a look at each character
    except UnicodeEncodeError:
        return max(text) < SETTLED
    return True


@functools.cache
def _encoder(path: str, ranks: str) -> Encoder:
    """Both libraries give the same ids for the same vocabulary; the quicker one takes characters whose
    kind all versions of Unicode agree on, and no added tokens."""
    tokenizer, added = load(path)
    lines = (line.split() for line in open(ranks, "rb"))
    quick = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={}
    )

    def make(chunk: str) -> bytes:
        if not chunk:
            return b""
        if max(chunk) < SETTLED and not any(t in chunk for t in added):
            return array("I", quick.encode_ordinary(chunk)).tobytes()
        return array("I", tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    return Encoder(quick, added, Kept(make, added))


def token_ids(text: str, path: str, ranks: str) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers: of a whole text where the quicker library takes it, else chunk by
    chunk (see ``tokens.chunks``), so that a character beyond it costs its own chunk only."""
    encoder = _encoder(path, ranks)
    if encoder.takes(text):
        return encoder.quick.encode_to_numpy(text).astype("<u4", copy=False).tobytes()
    return b"".join(chunks(text, encoder.kept))


class Bins:
    """Leaves hold the room left in each bin, inner nodes the most room below them."""

    def __init__(self, count: int, capacity: int) -> None:
        self.leaves = 1 << max(0, count - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """The leftmost bin with enough room, and the room that it had."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] = had - size
        at = node
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return node - self.leaves, had


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, in the given order; items of equal size go in that order."""
    bins = Bins(len(sizes), capacity)
    where, offset = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        where[i], had = bins.first_fit(sizes[i])
        offset[i] = capacity - had
    return where, offset


def pieces(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ids and the end id, cut after every ``capacity`` ids."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))

    def make(text: str) -> list[tuple]:
        ids = token_ids(text, path, ranks) + array("I", [END_ID]).tobytes()
        count = len(ids) // 4
        parts = ((start, ids[4 * start : 4 * (start + capacity)]) for start in range(0, count, capacity))
        return [(start, len(part) // 4, zlib.crc32(part), count) for start, part in parts]

    return by_row(rows, make, "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack(
    docs: DataFrame,
    path: str | None = None,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Documents are encoded whole and cut after every ``capacity`` ids. Pieces are dealt by chance into groups of bounded
    size, and each group is packed first-fit decreasing; sequences of different groups have different ids. A
    null or empty text is one piece that holds the end id only. Rows that repeat an id, or have none, are packed each. An
    empty table gives an empty result. Other columns are not read.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    cut = saved(pieces(docs, path, ranks, capacity, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "pieces")
    total = cut.agg(F.count("*").alias("pieces"), F.sum("length").alias("tokens")).first()
    groups = max(1, -(-(total["tokens"] or 0) // GROUP_TOKENS), -(-total["pieces"] // GROUP_PIECES))

    def fill(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        where, offset = first_fit_decreasing(rows["length"].to_pylist(), capacity)
        first = rows["part"][0].as_py() << 32
        rows = rows.append_column("sequence_id", pa.array([first + bin_ for bin_ in where], pa.int64()))
        return rows.append_column("offset", pa.array(offset, pa.int64())).drop_columns(["row", "part"])

    dealt = cut.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(groups)))
    kinds = ", ".join(f"{n} {t}" for n, t in cut.drop("row").dtypes)
    return dealt.groupBy("part").applyInArrow(fill, f"{kinds}, sequence_id bigint, offset bigint")
