"""Suffix-array dedup: removal of every byte that lies in a long string which starts elsewhere too.

Strings of 200 bytes ("windows") that are equal also agree on the place of their smallest hash of 24 bytes, their anchor.
So windows are dealt by what stands around the anchor: no two equal ones part, and neighbouring windows with one
anchor travel together, as a stretch. Each stretch is known by a hash of its bytes at first:

* stretches with equal bytes are repeated, all of their windows;
* a stretch whose surroundings of the anchor occur nowhere else has no repeated window;
* what is left, where repeats begin, end or were edited, is fetched, one stretch for each text, and dealt to shards of bounded
  size. Each shard builds a suffix array by induced sorting; neighbours in it with a common prefix of 200 bytes are
  repeated windows.

Surroundings with so many texts that they outgrow a shard are dealt window by window instead, by a hash of the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import by_row, saved, whole_text
from tallymill.llm.induced import permuted_prefixes, suffix_array

WINDOW = 200
GRAM = 24
#: Bytes on one side of an anchor that stretches with the same surroundings share besides the anchor.
SIDE = (WINDOW - GRAM) // 2
#: Stretches of a shard, and of one kind of surroundings in it, at most about.
SHARD_STRETCHES, KIND_STRETCHES = 8192, 4096
#: Bytes of texts that are hashed at a time; longer texts are taken in parts, whose windows overlap.
PART = 1 << 18

_U = np.uint64
_RANDOM = np.random.default_rng(20).integers(0, 1 << 64, (2, 256), dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int) -> np.ndarray:
    factors = np.full(PART + 2 * WINDOW, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    """Sums of weighted bytes up to each place, from which the hash of any range follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_RANDOM[which][data] * _POWERS[: len(data)], out=out[1:])
    return out


def _hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return _mixed((sums[stop] - sums[start]) * _INVERSES[start])


def stretches(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``kind, first, second, low, high`` of each stretch: a hash of the surroundings, two of the bytes, its windows' range."""
    found = [_part(data[at : at + PART + WINDOW - 1], at) for at in range(0, max(0, len(data) - WINDOW + 1), PART)]
    empty = [np.zeros(0, t) for t in (np.uint64, np.uint64, np.uint64, np.int64, np.int64)]
    return tuple(np.concatenate(columns) for columns in zip(empty, *found, strict=True))


def _part(data: bytes, offset: int) -> tuple[np.ndarray, ...]:
    letters = np.frombuffer(data, np.uint8)
    windows, grams, span = len(letters) - WINDOW + 1, len(letters) - GRAM + 1, WINDOW - GRAM + 1
    sums, other = _sums(letters, 0), _sums(letters, 1)
    # The smallest hash in each run of grams, the last of equals, by running minima of blocks from both sides.
    hashes = _mixed((sums[GRAM:] - sums[:grams]) * _INVERSES[:grams])
    ranked = np.full(-(-grams // span) * span, ~_U(0))
    ranked[:grams] = (hashes & ~_U(0xFFFFF)) | (_U(0xFFFFF) - np.arange(grams, dtype=np.uint64))
    ranked = ranked.reshape(-1, span)
    onward = np.minimum.accumulate(ranked, axis=1).ravel()
    back = np.minimum.accumulate(ranked[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:windows], onward[span - 1 : span - 1 + windows])
    anchor = (_U(0xFFFFF) - (least & _U(0xFFFFF))).astype(np.int64)
    low = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    high = np.concatenate([low[1:] - 1, [windows - 1]])
    anchor = anchor[low]
    # Windows that reach SIDE bytes to the left of the anchor share those, all others as many to its right.
    left, right = low <= anchor - SIDE, high > anchor - SIDE
    kind = np.concatenate(
        [
            _hash(sums, anchor[left] - SIDE, anchor[left] + GRAM),
            ~_hash(sums, anchor[right], anchor[right] + GRAM + SIDE),
        ]
    )
    low, high, anchor = (
        np.concatenate([low[left], np.maximum(low, anchor - SIDE + 1)[right]]),
        np.concatenate([np.minimum(high, anchor - SIDE)[left], high[right]]),
        np.concatenate([anchor[left], anchor[right]]),
    )
    place = _mixed((anchor - low).astype(np.uint64) + _U(1))
    first = _hash(sums, low, high + WINDOW) ^ place
    return kind, first, _hash(other, low, high + WINDOW) ^ place, low + offset, high + offset


# Dealing


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _all_stretches(texts: DataFrame) -> DataFrame:
    """The stretches of all texts. Of those that are equal within a few texts, all are ``known`` to be repeated, and only one
    is ``sent`` on, so runs of one pattern and common passages don't meet in one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = [stretches(_unpacked(packed)) for packed in part["packed"]]
                rows = np.repeat(part["row"].to_numpy(), [len(x[0]) for x in found])
                kind, first, second, low, high = (np.concatenate(columns) for columns in zip(*found, strict=True))
                order = np.lexsort((second, first, kind))
                kind, first, second, rows, low, high = (x[order] for x in (kind, first, second, rows, low, high))
                again = np.zeros(len(kind), bool)
                again[1:] = (kind[1:] == kind[:-1]) & (first[1:] == first[:-1]) & (second[1:] == second[:-1])
                known = again.copy()
                known[:-1] |= again[1:]
                yield pa.RecordBatch.from_arrays(
                    [*map(_long, (kind, first, second, rows, low)), pa.array(high - low, pa.int32()), pa.array(known), pa.array(~again)],
                    names=["kind", "first", "second", "row", "low", "more", "known", "sent"],
                )

    return texts.select("row", "packed").mapInArrow(
        run, "kind bigint, first bigint, second bigint, row bigint, low bigint, more int, known boolean, sent boolean"
    )


def _judge(found: DataFrame) -> DataFrame:
    """Stretches that are repeated as a whole, and one for each text of surroundings that have several."""
    of_kind = Window.partitionBy("kind")
    by_text = of_kind.orderBy("first", "second", "row", "low")

    def same(neighbour) -> Column:
        agree = (neighbour("first").over(by_text) == F.col("first")) & (neighbour("second").over(by_text) == F.col("second"))
        return F.coalesce(agree, F.lit(False))

    several = (F.min("first").over(of_kind) != F.max("first").over(of_kind)) | (
        F.min("second").over(of_kind) != F.max("second").over(of_kind)
    )
    repeated = F.col("before") | F.col("behind") | F.col("known")
    judged = (
        found.filter("sent")
        .withColumns({"before": same(F.lag), "behind": same(F.lead), "several": several})
        .select("kind", "row", "low", "more", repeated.alias("repeated"), (~F.col("before") & F.col("several")).alias("fetch"))
        .filter("repeated OR fetch")
    )
    others = found.filter("NOT sent").select("kind", "row", "low", "more", F.lit(True).alias("repeated"), F.lit(False).alias("fetch"))
    return judged.unionByName(others)


def _fetched(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """``shard, row, low, bytes`` of the stretches asked for; where ``shard`` is null, of each of their windows."""
    wanted = asked.groupBy("row").agg(F.collect_list(F.struct("shard", "low", "more")).alias("wanted"))
    joined = texts.select("row", "packed").join(wanted, "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = _unpacked(batch["packed"][i])
                shards, rows, lows, parts = [], [], [], []
                for w in batch["wanted"][i].as_py():
                    low, past = w["low"], w["low"] + w["more"] + 1
                    spans = [(low, past)] if w["shard"] is not None else [(at, at + 1) for at in range(low, past)]
                    for start, stop in spans:
                        shards.append(w["shard"])
                        lows.append(start)
                        parts.append(data[start : stop - 1 + WINDOW])
                rows = [batch["row"][i].as_py()] * len(lows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards, pa.int64()), pa.array(rows, pa.int64()), pa.array(lows, pa.int64()), pa.array(parts, pa.binary())],
                    names=["shard", "row", "low", "bytes"],
                )

    return joined.mapInArrow(run, "shard bigint, row bigint, low bigint, bytes binary")


def repeated_windows(parts: list[bytes]) -> list[np.ndarray]:
    """For each part, which of its windows occur at another place of any part."""
    # 0 ends the text and 1 each part; no UTF-8 byte is above 244.
    text = np.frombuffer(b"".join(p.translate(_UP) + b"\x01" for p in parts) + b"\0", np.uint8).astype(np.int64)
    order = suffix_array(text, 256)
    previous, length = permuted_prefixes(text, order)
    repeated = length >= WINDOW
    repeated[previous[np.flatnonzero(repeated)]] = True
    starts = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return [repeated[at : at + len(p) - WINDOW + 1] for at, p in zip(starts, parts, strict=False)]


_UP = bytes(min(b + 2, 255) for b in range(256))


def _shard_spans(rows: pa.Table) -> pa.Table:
    flags = repeated_windows(rows["bytes"].to_pylist())
    own, low = rows["row"].to_numpy(), rows["low"].to_numpy()
    out: list[tuple[int, int, int]] = []
    for i, found in enumerate(flags):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], found, [0]])))
        out += [(own[i], low[i] + a, b - a - 1) for a, b in edges.reshape(-1, 2)]
    columns = [pa.array([x[k] for x in out], pa.int64()) for k in range(3)]
    return pa.Table.from_arrays(columns, names=["row", "low", "more"])


def _unpacked(packed: pa.BinaryScalar) -> bytes:
    return zstandard.decompress(packed.as_buffer())


def _packed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", "text")

    def make(text: str) -> list[tuple]:
        return [(zstandard.compress(text.encode("utf-8", "surrogatepass"), 3),)]

    return by_row(rows, make, "packed binary")


# The operator


def spans(texts: DataFrame) -> DataFrame:
    """``row, low, more``: ranges of places where a repeated window starts."""
    marks = saved(_judge(saved(_all_stretches(texts), "stretches")), "marks")
    asked = marks.filter("fetch").select("kind", "row", "low", "more")
    shards = max(1, -(-asked.count() // SHARD_STRETCHES))
    wide = saved(asked.groupBy("kind").agg(F.count("*").alias("n")).filter(F.col("n") > KIND_STRETCHES), "wide")
    dealt = asked.join(wide, "kind", "left").withColumn("shard", F.when(F.col("n").isNull(), F.pmod(F.xxhash64("kind"), F.lit(shards))))
    fetched = saved(_fetched(texts, dealt), "fetched")
    in_shards = fetched.filter("shard IS NOT NULL").groupBy("shard").applyInArrow(_shard_spans, "row bigint, low bigint, more bigint")
    single = fetched.filter("shard IS NULL").select("row", "low", F.sha2("bytes", 256).alias("window"))
    often = saved(single.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "often")
    alone = single.join(often, "window").select("row", "low", F.lit(0).cast("bigint").alias("more"))
    whole = marks.filter("repeated").select("row", "low", F.col("more").cast("bigint").alias("more"))
    return whole.unionByName(in_shards).unionByName(alone)


def cut(data: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left, given ``(low, more)`` ranges of windows."""
    kept, removed, runs, at = [], 0, 0, 0
    end = 0
    for low, more in sorted(ranges):
        stop = low + more + WINDOW
        if low > end or not runs:
            kept.append(data[at:low])
            runs += 1
            removed += stop - low
        else:
            removed += max(0, stop - end)
        at = end = max(end, stop)
    kept.append(data[at:])
    return removed, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts_too: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, what is left).

    Every byte of the UTF-8 text that a 200-byte string covers which starts anywhere else too, in the same document or another, goes;
    strings are judged on the input. Matches never cross documents, so texts of fewer bytes are left alone. A null text is empty.
    Rows that repeat an id, or have none, are documents of their own, so equal long ones lose everything. An empty table gives an
    empty result. Other columns are not read. What is left may be cut inside a character, so ``kept`` is binary.
    """
    texts = saved(_packed(docs, doc_id, text), "texts")
    found = saved(spans(texts), "spans")
    per_row = found.groupBy("row").agg(F.collect_list(F.struct("low", "more")).alias("ranges"))
    joined = texts.join(per_row, "row", "left").select("doc_id", "packed", "ranges")
    schema = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 128) for i in range(0, batch.num_rows, 128)):
                out = []
                for packed, ranges in zip(part["packed"], part["ranges"], strict=True):
                    data = _unpacked(packed)
                    removed, runs, kept = cut(data, [(r["low"], r["more"]) for r in ranges.as_py() or []])
                    out.append((len(data), removed, runs, hashlib.sha256(kept).hexdigest(), kept))
                kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * texts_too
                columns = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names=["doc_id", *schema, *["kept"] * texts_too])

    kind = texts.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * texts_too
    return joined.mapInArrow(run, out)
