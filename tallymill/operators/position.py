"""Source positions: a total order over rows that needs neither a sort nor a key.

A position is ``(_file, _block, _row)``. Rows of one ``(_file, _block)`` are numbered without gaps, so the row
at any rank of the whole table follows from the row counts of the blocks alone, and a range of ranks becomes a
range of positions: a plain filter, whose bounds on ``_file`` also prune the files that are read. The other way round, a row's
rank is its number in the block and the rank of the block's first row.

Attach positions where the table is read, before any filter. A ``BlockIndex`` holds the row counts of the blocks; staged
tables keep one beside them, so that no later step counts rows again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymill.scratch import file_sizes, scratch_path

POSITION = ("_file", "_block", "_row")


@dataclass(frozen=True)
class Cut:
    """The position of the row at one rank."""

    file: str
    block: int
    row: int

    def at_or_after(self) -> Column:
        """Whether a row lies at or behind this cut."""
        file, block, row = (F.col(name) for name in POSITION)
        return (file >= self.file) & (
            (file > self.file) | (block > self.block) | ((block == self.block) & (row >= self.row))
        )

    def before(self) -> Column:
        """Whether a row lies ahead of this cut."""
        file, block, row = (F.col(name) for name in POSITION)
        return (file <= self.file) & (
            (file < self.file) | (block < self.block) | ((block == self.block) & (row < self.row))
        )


def with_source_position(df: DataFrame) -> DataFrame:
    """Add the position of each row of a Parquet table, read straight from its files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.lit(0).cast("bigint").alias("_block"),
        F.col("_metadata.row_index").alias("_row"),
    )


def drop_position(df: DataFrame) -> DataFrame:
    return df.drop(*POSITION)


class StaleIndexError(RuntimeError):
    """A stored index is not of the files that lie beside it."""


#: Blocks whose starts are sent to every task, at a few dozen bytes each. A table of more blocks is joined by shuffle.
BROADCAST_BLOCKS = 1_000_000

_INDEX = "_blocks"
_FILES = "_block_files"


class BlockIndex:
    """How many rows each block of a table has, and the rank of its first row, as a small table of its own.

    ``blocks`` has a row for each block: ``_file, _block, first_row, block_rows, start, _key``.
    """

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        found = blocks.agg(
            F.count(F.lit(1)).alias("blocks"), F.count_distinct("_key").alias("keys"), F.sum("block_rows").alias("rows")
        ).first()
        self.rows = found["rows"] or 0
        self._broadcast = found["blocks"] <= BROADCAST_BLOCKS
        self._by_key = found["keys"] == found["blocks"]

    @classmethod
    def of(cls, positioned: DataFrame, path: str | None = None) -> BlockIndex:
        """Count the rows of each block, reading the position columns only, and write the counts.

        The running sum is over one row per block.
        """
        spark = positioned.sparkSession
        path = path or scratch_path(spark, "blocks")
        counts = positioned.groupBy("_file", "_block").agg(
            F.min("_row").alias("first_row"), F.count(F.lit(1)).alias("block_rows")
        )
        in_order = Window.orderBy("_file", "_block")
        starts = counts.withColumn("start", F.sum("block_rows").over(in_order) - F.col("block_rows"))
        starts.withColumn("_key", F.xxhash64("_file", "_block")).coalesce(1).write.mode("overwrite").parquet(path)
        return cls(spark.read.parquet(path))

    @classmethod
    def stage(cls, positioned: DataFrame, path: str) -> BlockIndex:
        """Index the staged table at ``path`` and keep the index inside its folder, with the sizes of the files it is of."""
        spark = positioned.sparkSession
        index = cls.of(positioned, f"{path}/{_INDEX}")
        sizes = sorted(file_sizes(spark, path).items())
        spark.createDataFrame(sizes, "name string, bytes bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/{_FILES}")
        return index

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BlockIndex:
        """The index of a staged table, without a look at its rows; raises if its files are others than were indexed."""
        indexed = {row["name"]: row["bytes"] for row in spark.read.parquet(f"{path}/{_FILES}").collect()}
        if indexed != file_sizes(spark, path):
            raise StaleIndexError(f"the files of {path} have changed since they were indexed; stage the table again")
        return cls(spark.read.parquet(f"{path}/{_INDEX}"))

    def cuts(self, ranks: Sequence[int]) -> dict[int, Cut | None]:
        """The positions of the rows with the given 0-based ranks; None for a rank past the end."""
        wanted = F.array(*[F.lit(rank).cast("bigint") for rank in sorted(set(ranks))])
        inside = F.filter(wanted, lambda rank: (rank >= F.col("start")) & (rank < F.col("start") + F.col("block_rows")))
        hits = self.blocks.select(
            F.explode(inside).alias("rank"), "_file", "_block", (F.col("first_row") - F.col("start")).alias("shift")
        )
        cuts: dict[int, Cut | None] = dict.fromkeys(ranks)
        for hit in hits.collect():
            cuts[hit["rank"]] = Cut(hit["_file"], hit["_block"], hit["rank"] + hit["shift"])
        return cuts

    def with_rank(self, positioned: DataFrame) -> DataFrame:
        """Add each row's 0-based rank in the table as ``_rank``.

        The starts of the blocks go to every task under one number per block, or are joined by shuffle where there are too
        many of them, and by their names where two blocks share a number.
        """
        starts = self.blocks.select("_key", "_file", "_block", (F.col("start") - F.col("first_row")).alias("_shift"))
        if self._by_key:
            starts, keyed = starts.select("_key", "_shift"), positioned.withColumn("_key", F.xxhash64("_file", "_block"))
            by = ["_key"]
        else:
            starts, keyed, by = starts.drop("_key"), positioned, ["_file", "_block"]
        ranked = keyed.join(F.broadcast(starts) if self._broadcast else starts, by)
        return ranked.withColumn("_rank", F.col("_row") + F.col("_shift")).drop("_shift", "_key")


def stage_in_key_order(
    df: DataFrame, keys: Sequence[str | Column], path: str, partitions: int | None = None
) -> DataFrame:
    """Write a positioned table in the order of ``keys`` and read it back with positions in that order.

    One range shuffle, into ``partitions`` or else as many as ``spark.sql.shuffle.partitions`` says. Nulls come first;
    equal keys keep their source order, which also spreads a key that holds a large share of the rows over many
    partitions. The index of its blocks is staged with it.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(key).asc_nulls_first() if isinstance(key, str) else key for key in keys]
    order += [F.col(name) for name in POSITION]
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    (
        ranged.withColumns(
            {
                "_file": F.lit(""),
                "_block": F.spark_partition_id().cast("bigint"),
                "_row": F.monotonically_increasing_id(),
            }
        )
        .write.mode("overwrite")
        .parquet(path)
    )
    staged = spark.read.parquet(path)
    BlockIndex.stage(staged, path)
    return staged


def find_cuts(positioned: DataFrame, ranks: Sequence[int]) -> dict[int, Cut | None]:
    """The positions of the rows with the given 0-based ranks, by counting the blocks of a table without an index."""
    return BlockIndex.of(positioned).cuts(ranks)


def empty_like(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))
