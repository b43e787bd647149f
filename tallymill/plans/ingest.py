"""From positioned raw rows to landed, protected batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.tokens import TokenKeys, encrypt_columns
from tallymill.operators.batching import batch_slice, count_batches, rows_outside, with_segment_rank
from tallymill.operators.cleaning import drop_step
from tallymill.operators.position import BlockIndex
from tallymill.schema import BATCH_SPAN, PROTECTED_COLUMNS
from tallymill.sources.files import write_batch, write_table


def protect(rows: DataFrame, keys: TokenKeys, partitions: int | None = None) -> DataFrame:
    """Rows as they are landed: without ``step``, account names as tokens.

    Tokens are costly, so a source of a few large splits may be dealt out to ``partitions`` tasks first.
    """
    dealt = rows if partitions is None else rows.repartition(partitions)
    return encrypt_columns(drop_step(dealt), PROTECTED_COLUMNS, keys)


def ingest_batch(
    positioned: DataFrame,
    root: str,
    size: int,
    batch: int,
    keys: TokenKeys,
    span: int = BATCH_SPAN,
    partitions: int | None = None,
    index: BlockIndex | None = None,
) -> None:
    """Land one batch. Running it again replaces the batch. With an index only the files of the batch are read."""
    write_batch(protect(batch_slice(positioned, size, batch, span, index), keys, partitions), root, batch)


def ingest_all(
    positioned: DataFrame,
    root: str,
    size: int,
    keys: TokenKeys,
    batches: int | None = None,
    span: int = BATCH_SPAN,
    partitions: int | None = None,
    index: BlockIndex | None = None,
) -> int:
    """Land all batches in one pass, as disjoint segments that batches share.

    Without a number of batches there are as many as the table needs. Returns the number of rows that lie behind the
    last batch and are not landed: 0 unless ``batches`` is given and too small.

    Splits of the source are runs of ranks, so no more files are written than there are splits and segments together, without
    a shuffle. ``partitions`` deals rows out by runs of ranks too.
    """
    index = index or BlockIndex.of(positioned)
    segments = max(1, count_batches(index.rows, size)) if batches is None else batches + span - 1
    segmented = with_segment_rank(positioned, size, segments, index)
    if partitions is not None:
        landed_rows = max(1, min(index.rows, size * segments))
        task = F.floor(F.col("_rank") * partitions / landed_rows).cast("int")
        segmented = segmented.withColumn("_task", task).repartitionById(partitions, "_task").drop("_task")
    write_table(protect(segmented.drop("_rank"), keys), root, "segment")
    return 0 if batches is None else rows_outside(index.rows, size, batches, span)
