"""Publishing the served tables so that readers see all of a run or nothing of it."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators.contract import TEXT_TYPES, conform
from tallymill.schema import FLAGGED_FRAUD_ACCURACY, FRAUD_BY_TYPE, FRAUD_STATS, TRANSFORMED_DATA
from tallymill.scratch import create_once, remove
from tallymill.sources.files import batch_path, write_table
from tallymill.sources.jdbc import CONNECTIONS, Load, publish

SERVED_TABLES = (TRANSFORMED_DATA, FRAUD_BY_TYPE, FRAUD_STATS, FLAGGED_FRAUD_ACCURACY)
_LOG = "published"
_CLAIMS = "_claims"


class Snapshot:
    """Tables of one run, written in their final place but not read by anyone before they are announced."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = f"s{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}/snapshot={self.name}"

    def write(self, table: str, rows: DataFrame, batch: int | None = None) -> DataFrame:
        """Write a table of one batch, or of many batches told apart by ``batch``; returns what was written.

        Rows lie in a directory for each batch. Metric tables hold a few rows for each batch and are one file.
        """
        path, partitions = self._path(table), []
        if table != TRANSFORMED_DATA:
            rows = rows.coalesce(1) if batch is None else rows.coalesce(1).withColumn("batch", F.lit(batch))
        elif batch is None:
            partitions = ["batch"]
        else:
            path = batch_path(path, batch)
        write_table(rows, path, *partitions)
        return self.spark.read.schema(rows.schema).parquet(path)

    def announce(self, batches: Iterable[int]) -> str:
        """Make the tables visible: one small file, which is there as a whole or not at all.

        Its version is one above the newest in the log, so the order is that of announcement and no clock counts. A run
        first takes a version by creating its claim, which the file system grants once; a version whose run dies
        before its entry is written stays without one.
        """
        entries = [(self.name, batch) for batch in batches]
        log = self.spark.createDataFrame(entries, "snapshot string, batch int").coalesce(1)
        version = _last_version(self.spark, self.root) + 1
        while not create_once(self.spark, f"{self.root}/{_LOG}/{_CLAIMS}/{version}"):
            version += 1
        log.write.mode("errorifexists").parquet(f"{self.root}/{_LOG}/version={version}")
        return self.name


def _last_version(spark: SparkSession, root: str) -> int:
    try:
        log = spark.read.parquet(f"{root}/{_LOG}")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0
    return log.agg(F.max("version")).first()[0]


def _newest(spark: SparkSession, root: str) -> DataFrame:
    """``batch, version, snapshot`` of the run of each batch that was announced last."""
    last = F.max(F.struct("version", "snapshot")).alias("last")
    return spark.read.parquet(f"{root}/{_LOG}").groupBy("batch").agg(last).select("batch", "last.*")


def read_published(spark: SparkSession, root: str, table: str, history: bool = False) -> DataFrame:
    """A served table: of the batch announced last, or with ``history`` of every batch as announced last.

    The history is one read of the table, joined with the log; runs that the log does not name are not read.
    """
    root = root.rstrip("/")
    newest = _newest(spark, root)
    if not history:
        snapshot, batch = newest.agg(F.max(F.struct("version", "snapshot", "batch")).alias("last")).select(
            "last.snapshot", "last.batch"
        ).first()
        path = f"{root}/{table}/snapshot={snapshot}"
        return spark.read.option("basePath", path).parquet(path).filter(F.col("batch") == batch).drop("batch")
    rows = spark.read.parquet(f"{root}/{table}")
    columns = [name for name in rows.columns if name not in ("snapshot", "batch")]
    return rows.join(newest, ["snapshot", "batch"], "left_semi").select(*columns, "batch")


def expire(spark: SparkSession, root: str, unchanged_for: float) -> list[str]:
    """Delete the snapshots that no batch is read from; returns their names.

    Only what was written more than ``unchanged_for`` seconds ago goes: choose more than the longest run or read takes, as
    a run that is not announced yet looks like a failed one.
    """
    root = root.rstrip("/")
    used = {row["snapshot"] for row in _newest(spark, root).select("snapshot").distinct().collect()}
    before = (time.time() - unchanged_for) * 1000
    gone = set()
    for table in SERVED_TABLES:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
        for found in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
            name = found.getPath().getName().removeprefix("snapshot=")
            if name not in used and found.getModificationTime() < before:
                remove(spark, found.getPath().toString())
                gone.add(name)
    return sorted(gone)


def publish_jdbc(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str],
    truncate: bool = False,
    declared_types: bool = False,
    connections: int = CONNECTIONS,
) -> None:
    """Replace the database tables: all are loaded first and then take their places together.

    A load that fails leaves all of them as they were. The transactions are sent over up to ``connections`` connections at a
    time. With ``declared_types`` they are stored in the types of the contract, not in those of the frame.
    """
    loads: list[Load] = []
    try:
        for name in SERVED_TABLES:
            if name != TRANSFORMED_DATA:
                loads.append(Load(tables[name].coalesce(1), url, name, properties, truncate, 1))
            elif declared_types:
                loads.append(Load(conform(tables[name]), url, name, properties, truncate, connections, column_types=TEXT_TYPES))
            else:
                loads.append(Load(tables[name], url, name, properties, truncate, connections))
    except BaseException:
        for load in loads:
            load.abandon()
        raise
    publish(loads)
