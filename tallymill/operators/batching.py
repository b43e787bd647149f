"""Numbered, by default overlapping, row batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.position import BlockIndex, drop_position, empty_like
from tallymill.schema import BATCH_SPAN

_COPIES_PER_TASK = 1 << 16


def slice_rows(positioned: DataFrame, start: int, end: int, index: BlockIndex | None = None) -> DataFrame:
    """Rows ``start`` up to, not including, ``end`` in source order, clamped to the table.

    With an index no row of the table is read to find the two ends.
    """
    if start < 0 or end < start:
        raise ValueError(f"not a row range: [{start}, {end})")
    cuts = (index or BlockIndex.of(positioned)).cuts([start, end])
    first, past = cuts[start], cuts[end]
    if first is None or start == end:
        return drop_position(empty_like(positioned))
    rows = positioned if start == 0 else positioned.filter(first.at_or_after())
    if past is not None:
        rows = rows.filter(past.before())
    return drop_position(rows)


def limit_prefix(positioned: DataFrame, rows: int, index: BlockIndex | None = None) -> DataFrame:
    """The first rows in source order."""
    return slice_rows(positioned, 0, rows, index)


def batch_slice(
    positioned: DataFrame, size: int, batch: int, span: int = BATCH_SPAN, index: BlockIndex | None = None
) -> DataFrame:
    """The rows of one batch: ``span`` steps of ``size`` rows, so that batches overlap unless span is 1."""
    _check_batching(size, span)
    if batch < 1:
        raise ValueError(f"batches count from 1, got {batch}")
    start = (batch - 1) * size
    return slice_rows(positioned, start, start + span * size, index)


def count_batches(rows: int, size: int) -> int:
    """As many batches as start inside a table of so many rows, so that every row is in one."""
    _check_batching(size, 1)
    return -(-rows // size)


def rows_outside(rows: int, size: int, batches: int, span: int = BATCH_SPAN) -> int:
    """How many of so many rows lie behind the last of so many batches."""
    return max(0, rows - (batches + span - 1) * size)


def with_segment(positioned: DataFrame, size: int, segments: int, index: BlockIndex | None = None) -> DataFrame:
    """Number consecutive runs of ``size`` rows from 0; rows behind the last run are left out.

    A batch is the union of its segments, so each row has to be stored once only. The number is worked out from the rank of
    the row, so the plan is the same for any number of segments.
    """
    return with_segment_rank(positioned, size, segments, index).drop("_rank")


def with_segment_rank(positioned: DataFrame, size: int, segments: int, index: BlockIndex | None = None) -> DataFrame:
    """``with_segment``, and the rank of each row as ``_rank``."""
    if size < 1 or segments < 1:
        raise ValueError("size and number of segments must be positive")
    ranked = (index or BlockIndex.of(positioned)).with_rank(positioned)
    inside = ranked.filter(F.col("_rank") < size * segments)
    return drop_position(inside.withColumn("segment", F.expr(f"CAST(_rank div {size} AS INT)")))


def batches_of(segment: Column, batches: int, span: int = BATCH_SPAN) -> Column:
    """Array of the batches that hold a segment."""
    first = F.greatest(segment - F.lit(span - 2), F.lit(1))
    last = F.least(segment + F.lit(1), F.lit(batches))
    return F.sequence(first, last)


def fan_out(
    positioned: DataFrame,
    size: int,
    batches: int | None = None,
    span: int = BATCH_SPAN,
    index: BlockIndex | None = None,
) -> DataFrame:
    """All batches at once, told apart by the column ``batch``: one scan, no shuffle of rows.

    Without a number of batches there are as many as the table needs. With one, rows behind the last batch are
    in none; ``rows_outside`` counts them.
    """
    _check_batching(size, span)
    index = index or BlockIndex.of(positioned)
    batches = count_batches(index.rows, size) if batches is None else batches
    if batches == 0:
        return drop_position(empty_like(positioned)).withColumn("batch", F.lit(0))
    segmented = with_segment(positioned, size, batches + span - 1, index)
    return segmented.withColumn("batch", F.explode(batches_of(F.col("segment"), batches, span))).drop("segment")


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference by column position.

    Copies are counted before the shuffle and written out again at the end, where a row with very many
    copies is spread over tasks.
    """
    columns = left.columns
    signed = left.withColumn("_sign", _long(1)).union(
        right.withColumn("_sign", _long(-1))
    )
    counted = signed.groupBy(*columns).agg(F.sum("_sign").alias("_copies")).filter("_copies > 0")
    few = counted.filter(F.col("_copies") <= _COPIES_PER_TASK)
    many = (
        counted.filter(F.col("_copies") > _COPIES_PER_TASK)
        .withColumn("_from", F.explode(F.sequence(_long(0), F.col("_copies") - 1, _long(_COPIES_PER_TASK))))
        .withColumn("_copies", F.least(F.col("_copies") - F.col("_from"), _long(_COPIES_PER_TASK)))
        .repartition(*columns, "_from")
        .drop("_from")
    )
    copies = F.sequence(_long(1), F.col("_copies"))
    return few.union(many).withColumn("_copy", F.explode(copies)).select(*columns)


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _check_batching(size: int, span: int) -> None:
    if size < 1 or span < 1:
        raise ValueError(f"batch size and span must be positive, got {size} and {span}")
