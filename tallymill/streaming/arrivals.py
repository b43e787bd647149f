"""New CSV files, each taken once as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallymill.functions.tokens import TokenKeys, decrypt_columns, encrypt_columns
from tallymill.operators import metrics
from tallymill.operators.cleaning import clean, drop_step, label_and_name
from tallymill.plans.ingest import protect
from tallymill.plans.publish import read_published
from tallymill.plans.transform import transform_batch
from tallymill.schema import CSV_SCHEMA, FRAUD_BY_TYPE, PROTECTED_COLUMNS
from tallymill.sources.files import REJECTED_LINE, read_batch, write_batch


def read_arrivals(
    spark: SparkSession,
    source: str,
    schema: T.StructType = CSV_SCHEMA,
    files_per_trigger: int | None = None,
    mode: str = "FAILFAST",
    rejects: bool = False,
) -> DataFrame:
    """Rows of the files in a folder as a stream; flags are text, as in ``read_csv``.

    A file whose header differs from the schema is an error, and so is a malformed value. All files that are new make one
    step unless ``files_per_trigger`` limits it; leave it out where each step becomes a batch. With ``rejects`` a line that does
    not fit is kept as text in ``REJECTED_LINE`` instead; ``land_arrivals`` puts such lines beside the others.
    """
    if rejects:
        schema, mode = T.StructType([*schema.fields, T.StructField(REJECTED_LINE, T.StringType())]), "PERMISSIVE"
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("mode", mode)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("columnNameOfCorruptRecord", REJECTED_LINE).csv(source)


def drop_copies(arriving: DataFrame, remembered: str = "30 days") -> DataFrame:
    """Rows without those that are copies of a row that arrived before, in the same step or an earlier one.

    The state holds a digest of each row for as long as ``remembered`` after the step that it arrived in; time is that of the
    steps, so no row is ever late and dropped for that. A copy that arrives later still is a new row. Keep the state in RocksDB
    (``spark.sql.streaming.stateStore.providerClass``) where it does not fit into memory.
    """
    rows = drop_step(arriving)
    digest = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    marked = rows.withColumns({"_digest": digest, "_arrived": F.current_timestamp()})
    return marked.withWatermark("_arrived", remembered).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest", "_arrived")


def land_arrivals(arriving: DataFrame, landed: str, checkpoint: str, keys: TokenKeys) -> StreamingQuery:
    """Land the files that are new since the last run, then stop.

    The checkpoint remembers the files that were read and the file sink logs what each step wrote, so a step
    that is run again after a failure adds nothing twice. Where lines may be rejected, rows and rejects lie in folders of
    their own, and the text of a reject is protected like the names that it may hold; ``read_landed`` reads them.
    """
    rows, folders = protect(arriving, keys), []
    if REJECTED_LINE in arriving.columns:
        rows = encrypt_columns(rows, [REJECTED_LINE], keys).withColumn("rejected", F.col(REJECTED_LINE).isNotNull())
        folders = ["rejected"]
    return (
        rows.writeStream.format("parquet")
        .partitionBy(*folders)
        .option("path", landed)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_landed(spark: SparkSession, landed: str, keys: TokenKeys, rejects: bool = False) -> DataFrame:
    """The rows that ``land_arrivals`` has landed where lines may be rejected, or the rejected lines, decrypted."""
    found = spark.read.parquet(landed).filter(F.col("rejected") == rejects).drop("rejected")
    if rejects:
        return decrypt_columns(found.select(REJECTED_LINE), [REJECTED_LINE], keys).withColumnRenamed(REJECTED_LINE, "line")
    return decrypt_columns(found.drop(REJECTED_LINE), PROTECTED_COLUMNS, keys)


def count_arrivals(
    arriving: DataFrame, landed: str, summaries: str, checkpoint: str, keys: TokenKeys, remembered: str = "30 days"
) -> StreamingQuery:
    """Land each row that is new, once, with the summary of each step beside it; then stop.

    ``fraud_by_type_counted`` adds the summaries up, so that no transaction is read again. A step that is run again replaces
    its folders, from the state as it was before.
    """

    def count(rows: DataFrame, step: int) -> None:
        write_batch(protect(rows, keys), landed, step + 1)
        stored = decrypt_columns(read_batch(rows.sparkSession, landed, step + 1), PROTECTED_COLUMNS, keys)
        write_batch(metrics.summarize(label_and_name(stored)).coalesce(1), summaries, step + 1)

    return (
        drop_copies(arriving, remembered)
        .writeStream.foreachBatch(count)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def fraud_by_type_counted(spark: SparkSession, summaries: str) -> DataFrame:
    """Fraud by type over all that ``count_arrivals`` has counted, out of its summaries."""
    return metrics.fraud_by_type(metrics.add_up(spark.read.parquet(summaries)))


def publish_arrivals(
    arriving: DataFrame, landed: str, served: str, checkpoint: str, keys: TokenKeys
) -> StreamingQuery:
    """Make each step of new files a batch of its own: land, transform and publish it, then stop.

    Batches are numbered by the stream from 1. A step that is run again replaces its batch directory, and of
    two snapshots of a batch the newer counts.
    """

    def publish(rows: DataFrame, step: int) -> None:
        write_batch(protect(rows, keys), landed, step + 1)
        transform_batch(rows.sparkSession, landed, step + 1, keys, served)

    return (
        arriving.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def fraud_by_type_of_batches(spark: SparkSession, served: str) -> DataFrame:
    """Fraud by type over all published batches, added up from their own summaries; no transaction is read.

    Copies count once within a batch. Meant for batches of arrivals, which do not overlap.
    """
    batches = read_published(spark, served, FRAUD_BY_TYPE, history=True)
    total, frauds = (F.sum(name).alias(name) for name in ("total_transactions", "fraudulent_transactions"))
    rate = F.col("fraudulent_transactions") / F.col("total_transactions") * 100
    return batches.groupBy("transType").agg(total, frauds).withColumn("fraud_rate", rate)


def fraud_by_type_so_far(spark: SparkSession, landed: str, keys: TokenKeys) -> DataFrame:
    """Fraud by type over all that has landed."""
    return metrics.fraud_by_type(metrics.summarize(clean(spark.read.parquet(landed), keys)))
