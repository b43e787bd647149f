"""The whole way from raw rows to published tables."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame

from tallymill.functions.tokens import TokenKeys
from tallymill.operators.position import BlockIndex
from tallymill.plans.ingest import ingest_all, ingest_batch
from tallymill.plans.transform import transform_all, transform_batch
from tallymill.schema import BATCH_SPAN


def run_batch(
    positioned: DataFrame,
    landed: str,
    served: str,
    size: int,
    batch: int,
    keys: TokenKeys,
    span: int = BATCH_SPAN,
    partitions: int | None = None,
    index: BlockIndex | None = None,
) -> str:
    """Ingest, transform and publish one batch. Errors reach the caller."""
    ingest_batch(positioned, landed, size, batch, keys, span, partitions, index)
    return transform_batch(positioned.sparkSession, landed, batch, keys, served)


def run_all(
    positioned: DataFrame,
    landed: str,
    served: str,
    size: int,
    keys: TokenKeys,
    batches: int | None = None,
    span: int = BATCH_SPAN,
    strict: bool = False,
    partitions: int | None = None,
    index: BlockIndex | None = None,
) -> str:
    """All batches in one pass over the source, published as one snapshot.

    Without a number of batches every row is in one. With one that is too small, a warning says how many rows stay out.
    """
    outside = ingest_all(positioned, landed, size, keys, batches, span, partitions, index)
    if outside:
        warnings.warn(f"{outside} rows lie behind batch {batches} and are in none", stacklevel=2)
    return transform_all(positioned.sparkSession, landed, keys, served, batches, span, strict)
