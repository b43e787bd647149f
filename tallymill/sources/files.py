"""CSV and Parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.operators.position import POSITION, BlockIndex
from tallymill.schema import CSV_SCHEMA

# Six digits, so that a written file gives back the microseconds it was given.
_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_SUCCESS_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = CSV_SCHEMA, mode: str = "FAILFAST"
) -> DataFrame:
    """Read CSV files with a header line, whose columns may come in any order.

    Columns that the schema does not name stay text, and so do flags by default. A value that is not of its column's type is
    an error; with ``mode="PERMISSIVE"`` it becomes null. Without a schema the types are inferred, at the price of
    one more scan.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", False).option("mode", mode).schema(_as_in_header(reader, path, schema)).csv(path)


def _as_in_header(reader: DataFrameReader, path: str, schema: T.StructType) -> T.StructType:
    types = {field.name: field.dataType for field in schema}
    return T.StructType([T.StructField(name, types.get(name, T.StringType())) for name in reader.csv(path).columns])


#: The text of a line that does not fit the schema; null in all others.
REJECTED_LINE = "_rejected_line"


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType = CSV_SCHEMA) -> DataFrame:
    """``read_csv``, but a line with a malformed value, or too many or few of them, is kept as text in ``REJECTED_LINE``.

    Whether a line fits is only known from all its columns: write the frame as it is, as ``stage_csv_with_rejects`` does, and
    choose columns afterwards.
    """
    reader = spark.read.option("header", True)
    typed = _as_in_header(reader, path, schema).add(REJECTED_LINE, T.StringType())
    return (
        reader.option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED_LINE)
        .schema(typed)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", _TIMESTAMP_FORMAT).csv(path)


def stage_csv(csv: DataFrame, path: str) -> DataFrame:
    """Land CSV rows as Parquet with their positions, so that all later steps read columns and skip files.

    One pass without a shuffle. The order is that of the text: by file, block and line. The index of the blocks is kept inside
    the folder; ``BlockIndex.load`` reads it.
    """
    (
        csv.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .write.mode("overwrite")
        .parquet(path)
    )
    staged = csv.sparkSession.read.parquet(path)
    BlockIndex.stage(staged, path)
    return staged


@dataclass(frozen=True)
class Staged:
    """A staged CSV source: its rows with their positions, the lines that were rejected, and how many there are of each."""

    rows: DataFrame
    rejects: DataFrame
    row_count: int
    reject_count: int


def stage_csv_with_rejects(csv: DataFrame, path: str) -> Staged:
    """``stage_csv`` for the lines that fit the schema, and the others beside them, in one pass over the text.

    ``rejects`` has ``line, _file, _block, _row``. Each task writes its rows ahead of its rejects, so that the numbers of the rows
    within a block have no gaps, and counts both while it writes.
    """
    seen = Observation()
    rejected = F.col(REJECTED_LINE).isNotNull()
    parsed = csv.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    ).withColumn("rejected", rejected)
    numbered = parsed.sortWithinPartitions("rejected", "_line").withColumn("_row", F.monotonically_increasing_id())
    counted = numbered.drop("_line").observe(
        seen, F.count_if(F.col("rejected")).alias("rejects"), F.count_if(~F.col("rejected")).alias("rows")
    )
    write_table(counted, path, "rejected")
    spark = csv.sparkSession
    stored = counted.drop("rejected").schema
    good, bad = (f"{path}/rejected={value}" for value in ("false", "true"))
    rows = _read_if_there(spark, good, stored, seen.get["rows"]).drop(REJECTED_LINE)
    if seen.get["rows"]:
        BlockIndex.stage(rows, good)
    rejects = _read_if_there(spark, bad, stored, seen.get["rejects"]).select(F.col(REJECTED_LINE).alias("line"), *POSITION)
    return Staged(rows, rejects, seen.get["rows"], seen.get["rejects"])


def _read_if_there(spark: SparkSession, path: str, schema: T.StructType, rows: int) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if rows else spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, *partition_by: str, success_marker: bool = True) -> None:
    """Write a Parquet table in place of what was there, with or without a ``_SUCCESS`` file beside it."""
    writer = df.write.mode("overwrite").option(_SUCCESS_MARKER, str(success_marker).lower())
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "static")
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write the partitions that occur in the frame and leave the others of the table alone."""
    (
        df.write.mode("overwrite")
        .partitionBy(*partition_by)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def batch_path(root: str, batch: int) -> str:
    return f"{root.rstrip('/')}/batch={batch}"


def write_batch(df: DataFrame, root: str, batch: int) -> None:
    """Write one batch directory. An empty batch is written too, and replaces an older one."""
    write_table(df, batch_path(root, batch), success_marker=False)


def read_batch(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """Read one batch directory with the columns it has itself; others are not even listed."""
    return spark.read.parquet(batch_path(root, batch))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
