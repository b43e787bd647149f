"""From landed batches to the four served tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.functions.tokens import TokenKeys, decrypt_columns
from tallymill.operators import contract, metrics
from tallymill.operators.batching import batches_of
from tallymill.operators.cleaning import clean, label_and_name
from tallymill.plans.publish import Snapshot
from tallymill.schema import (
    BATCH_SPAN,
    FLAGGED_FRAUD_ACCURACY,
    FRAUD_BY_TYPE,
    FRAUD_STATS,
    PROTECTED_COLUMNS,
    TRANSFORMED_DATA,
)
from tallymill.scratch import remove, scratch_path
from tallymill.sources.files import read_batch, write_table
from tallymill.sources.layout import Layout


def metric_tables(transformed: DataFrame, path: str, *by: str) -> dict[str, DataFrame]:
    """The three metric tables. Their common summary is written to ``path`` first, so the rows are read once."""
    spark = transformed.sparkSession
    write_table(metrics.summarize(transformed, *by), path)
    summary = spark.read.parquet(path)
    return {
        FRAUD_BY_TYPE: metrics.fraud_by_type(summary, *by),
        FRAUD_STATS: metrics.fraud_stats(summary, *by),
        FLAGGED_FRAUD_ACCURACY: metrics.flagged_fraud_accuracy(summary, *by),
    }


def transform_batch(
    spark: SparkSession, landed: str, batch: int, keys: TokenKeys, served: str, strict: bool = False
) -> str:
    """Clean one landed batch and publish its tables; ``strict`` also enforces the rules on values, counted during the write.

    Cleaning shuffles the batch, so its result is written once and the metrics read a few columns of it.
    Nothing becomes visible before all checks have passed.
    """
    cleaned = contract.require_columns(clean(read_batch(spark, landed, batch), keys))
    snapshot = Snapshot(spark, served)
    watch = contract.Watch(cleaned) if strict else None
    transformed = snapshot.write(TRANSFORMED_DATA, watch.rows if watch else cleaned, batch)
    if watch:
        watch.enforce()
        contract.require_unique_keys(transformed)
    summary = scratch_path(spark, "summary")
    for name, table in metric_tables(transformed, summary).items():
        snapshot.write(name, table, batch)
    remove(spark, summary)
    return snapshot.announce([batch])


def drop_duplicates_by_batch(segmented: DataFrame, batches: int, span: int = BATCH_SPAN) -> DataFrame:
    """Within each batch, one row of each group of equal rows.

    A row is not shuffled for every batch: the batches of equal rows meet as bits of one number, combined before the
    shuffle, and are spelled out afterwards. A number holds ``_WORD`` batches; only a row whose own batches lie in two of
    them goes twice.
    """
    columns = [name for name in segmented.columns if name != "segment"]
    first = F.greatest(F.col("segment") - (span - 1), F.lit(0))
    last = F.least(F.col("segment"), F.lit(batches - 1))
    words = F.sequence(F.floor(first / _WORD).cast("int"), F.floor(last / _WORD).cast("int"))
    in_words = segmented.filter(first <= last).withColumn("_word", F.explode(words))
    low = F.greatest(first - F.col("_word") * _WORD, F.lit(0))
    high = F.least(last - F.col("_word") * _WORD, F.lit(_WORD - 1))
    one = F.lit(1).cast("bigint")
    bits = F.call_function("shiftleft", F.call_function("shiftleft", one, high - low + 1) - 1, low)
    distinct = in_words.groupBy(*columns, "_word").agg(F.bit_or(bits).alias("_bits"))
    places = F.sequence(F.lit(0), F.lit(min(batches, _WORD) - 1))
    touched = F.filter(places, lambda place: F.call_function("shiftright", F.col("_bits"), place).bitwiseAND(one) == 1)
    batch = (F.col("_word") * _WORD + F.col("_place") + 1).cast("int")
    return distinct.withColumn("_place", F.explode(touched)).withColumn("batch", batch).drop("_word", "_bits", "_place")


#: Batches that the bits of one number stand for.
_WORD = 62


def _laid_out(cleaned: DataFrame, counts: DataFrame, batches: int, span: int) -> DataFrame:
    """Rows where their files are written, if the tasks that hold them now would write very many.

    The rows of a batch are at most those of its segments, which the landed files tell by themselves.
    """
    of_batch = counts.withColumn("batch", F.explode(batches_of(F.col("segment"), batches, span)))
    layout = Layout(of_batch.groupBy("batch").agg(F.sum("rows").alias("rows")))
    tasks = int(cleaned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return layout.apply(cleaned) if layout.wanted(tasks) else cleaned


def _for_every_batch(table: DataFrame, batches: int) -> DataFrame:
    """Add a row of nulls for a batch without rows."""
    numbers = table.sparkSession.range(1, batches + 1, numPartitions=1).select(F.col("id").cast("int").alias("batch"))
    return numbers.join(table, "batch", "left")


def transform_all(
    spark: SparkSession,
    landed: str,
    keys: TokenKeys,
    served: str,
    batches: int | None = None,
    span: int = BATCH_SPAN,
    strict: bool = False,
) -> str:
    """Clean all batches that were landed as segments and publish their tables as one snapshot.

    Without a number of batches, one starts with each landed segment; where they were landed by number, give the same
    number here. ``strict`` also enforces the rules on values, and unique keys within each batch.
    """
    landed_rows = spark.read.parquet(landed)
    counts = landed_rows.groupBy("segment").agg(F.count(F.lit(1)).alias("rows"))
    if batches is None:
        batches = 1 + (counts.agg(F.max("segment")).first()[0] or 0)
    segments = decrypt_columns(landed_rows, PROTECTED_COLUMNS, keys)
    cleaned = label_and_name(drop_duplicates_by_batch(segments, batches, span))
    contract.require_columns(cleaned.drop("batch"))
    cleaned = _laid_out(cleaned, counts, batches, span)
    snapshot = Snapshot(spark, served)
    watch = contract.Watch(cleaned) if strict else None
    transformed = snapshot.write(TRANSFORMED_DATA, watch.rows if watch else cleaned)
    if watch:
        watch.enforce()
        contract.require_unique_keys(transformed, "batch")
    summary = scratch_path(spark, "summary")
    tables = metric_tables(transformed, summary, "batch")
    snapshot.write(FRAUD_BY_TYPE, tables[FRAUD_BY_TYPE])
    for name in (FRAUD_STATS, FLAGGED_FRAUD_ACCURACY):
        snapshot.write(name, _for_every_batch(tables[name], batches))
    remove(spark, summary)
    return snapshot.announce(range(1, batches + 1))
