"""Where rows go before a partitioned write, so that files follow the bytes and not tasks times batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.scratch import scratch_path

#: Rows of one file: some hundred megabytes of transactions.
ROWS_PER_FILE = 1_000_000

#: Batches whose places are sent to every task; more of them are joined by shuffle.
BROADCAST_BATCHES = 1_000_000


class Layout:
    """A place for each file of a table that is written by batches.

    A batch has as many files as its rows need, and at least one. Files lie one behind the other in the order of batches; tasks
    take ranges of that line of about equal numbers of rows. So small batches share a task, and a large one is
    dealt out to many.
    """

    def __init__(self, counts: DataFrame, by: str = "batch", rows_per_file: int = ROWS_PER_FILE):
        """``counts`` has a row for each value of ``by`` with its number of ``rows``, or a bound of it."""
        spark = counts.sparkSession
        self.by, self.rows_per_file = by, rows_per_file
        files = F.greatest(F.expr(f"CAST(ceil(rows / {rows_per_file}) AS BIGINT)"), F.lit(1).cast("bigint"))
        line = Window.orderBy(by)
        path = scratch_path(spark, "layout")
        sized = counts.filter(F.col(by).isNotNull()).select(by, F.col("rows").cast("bigint").alias("_rows"), files.alias("_files"))
        sized.withColumn("_from", F.sum("_rows").over(line) - F.col("_rows")).coalesce(1).write.parquet(path)
        self.places = spark.read.parquet(path)
        found = self.places.agg(F.count(F.lit(1)).alias("batches"), F.sum("_files").alias("files"), F.sum("_rows").alias("rows")).first()
        self.batches, self.files, self.rows = found["batches"], found["files"] or 0, found["rows"] or 0

    def wanted(self, tasks: int) -> bool:
        """Whether as many tasks, each with rows of all batches, would write far more files than the rows need."""
        return tasks * self.batches > 4 * self.files

    def apply(self, df: DataFrame, place: Column | None = None) -> DataFrame:
        """Shuffle rows to the tasks that write their files.

        ``place`` is the 0-based number of a row in its batch; without it rows are dealt to the files of
        their batch by a hash of all columns. Rows of a batch without a count share one task.
        """
        spark = df.sparkSession
        shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
        by_bytes = -(-self.rows // self.rows_per_file)
        tasks = max(1, min(self.files, max(by_bytes, shuffled)))
        places = F.broadcast(self.places) if self.batches <= BROADCAST_BATCHES else self.places
        if place is None:
            number = F.pmod(F.xxhash64(*df.columns), F.col("_files"))
        else:
            number = F.least(F.floor(place / self.rows_per_file), F.col("_files") - 1)
        line = F.col("_from") + F.col("_rows") / F.col("_files") * number
        task = F.least(F.floor(line * tasks / max(1, self.rows)), F.lit(tasks - 1).cast("bigint")).cast("int")
        placed = df.join(places, self.by, "left").withColumn("_task", F.coalesce(task, F.lit(0)))
        return placed.repartitionById(tasks, "_task").select(*df.columns)
