"""Command line: the jobs of the pipeline, for ``spark-submit`` or ``python -m tallymill``.

The key, the batch size and the database account come from the environment, as the batch number may not be
known before the job starts and secrets do not belong on a command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tallymill.functions.tokens import TokenKeys
from tallymill.operators.position import BlockIndex, with_source_position
from tallymill.plans.ingest import ingest_all, ingest_batch
from tallymill.plans.publish import SERVED_TABLES, expire, publish_jdbc, read_published
from tallymill.plans.transform import transform_all, transform_batch
from tallymill.schema import BATCH_SPAN
from tallymill.sources.files import read_batch, read_csv, read_csv_with_rejects, stage_csv, stage_csv_with_rejects
from tallymill.sources.jdbc import CONNECTIONS
from tallymill.streaming.arrivals import land_arrivals, publish_arrivals, read_arrivals

# Environment variables that the jobs read.
SIZE_VARIABLE = "BATCH_SIZE"
USER_VARIABLE = "DB_USER"
PASSWORD_VARIABLE = "DB_PASSWORD"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallymill", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    stage = commands.add_parser("stage", help="land raw CSV files as Parquet, once for all batches")
    stage.add_argument("source")
    stage.add_argument("staged")
    stage.add_argument("--infer-types", action="store_true")
    stage.add_argument("--rejects", action="store_true", help="keep lines that do not fit the schema beside the rows")

    for name, help_text in (("ingest", "land one batch"), ("ingest-all", "land all batches in one pass")):
        command = commands.add_parser(name, help=help_text)
        if name == "ingest":
            command.add_argument("batch", type=int)
        else:
            command.add_argument("--batches", type=int, help="as many as the table needs unless given")
        command.add_argument("--partitions", type=int, help="deal rows out to so many tasks before names are protected")
        command.add_argument("--source", required=True, help="staged CSV, or a Parquet table")
        command.add_argument("--landed", required=True)
        command.add_argument("--span", type=int, default=BATCH_SPAN)
        command.add_argument("--preview", action="store_true", help="print the schema and five rows")

    for name, help_text in (("transform", "publish one batch"), ("transform-all", "publish all batches")):
        command = commands.add_parser(name, help=help_text)
        if name == "transform":
            command.add_argument("batch", type=int)
        else:
            command.add_argument("--batches", type=int, help="as given to ingest-all")
            command.add_argument("--span", type=int, default=BATCH_SPAN)
        command.add_argument("--strict", action="store_true", help="enforce the rules on values")
        command.add_argument("--landed", required=True)
        command.add_argument("--served", required=True)
        _database_options(command)
        command.add_argument("--preview", action="store_true", help="print the published tables")

    arrivals = commands.add_parser("arrivals", help="land CSV files that are new since the last run")
    arrivals.add_argument("source")
    arrivals.add_argument("landed")
    arrivals.add_argument("checkpoint")
    arrivals.add_argument("--served", help="make the new files a batch and publish it")
    _database_options(arrivals)

    old = commands.add_parser("expire", help="delete snapshots that no batch is read from")
    old.add_argument("served")
    old.add_argument("--unchanged-for", type=float, required=True, help="seconds; more than any run or read takes")
    return parser


def _database_options(command: argparse.ArgumentParser) -> None:
    command.add_argument("--jdbc-url", help="replace the tables of this database as well")
    command.add_argument("--truncate", action="store_true", help="keep the database tables as declared")
    command.add_argument("--declared-types", action="store_true", help="store contract types in the database")
    command.add_argument("--connections", type=int, default=CONNECTIONS, help="to the database, at a time")


def _positioned(spark: SparkSession, path: str) -> tuple[DataFrame, BlockIndex | None]:
    """A staged table with its index, or a Parquet table whose rows have to be counted."""
    table = spark.read.parquet(path)
    if "_row" not in table.columns:
        return with_source_position(table), None
    return table, BlockIndex.load(spark, path)


def _batch_size() -> int:
    size = os.environ.get(SIZE_VARIABLE)
    if not size:
        raise ValueError(f"{SIZE_VARIABLE} is not set")
    return int(size)


def _preview(table: DataFrame, rows: int = 5) -> None:
    table.printSchema()
    table.show(rows)


def _ingest(spark: SparkSession, options: argparse.Namespace) -> None:
    (rows, index), keys = _positioned(spark, options.source), TokenKeys.from_environment(spark)
    if options.command == "ingest":
        ingest_batch(rows, options.landed, _batch_size(), options.batch, keys, options.span, options.partitions, index)
        landed = read_batch(spark, options.landed, options.batch)
    else:
        size, batches = _batch_size(), options.batches
        outside = ingest_all(rows, options.landed, size, keys, batches, options.span, options.partitions, index)
        if outside:
            print(f"{outside} rows lie behind batch {batches} and are in none")
        landed = spark.read.parquet(options.landed)
    if options.preview:
        _preview(landed)


def _transform(spark: SparkSession, options: argparse.Namespace) -> None:
    keys = TokenKeys.from_environment(spark)
    if options.command == "transform":
        transform_batch(spark, options.landed, options.batch, keys, options.served, options.strict)
    else:
        transform_all(spark, options.landed, keys, options.served, options.batches, options.span, options.strict)
    tables = {name: read_published(spark, options.served, name) for name in SERVED_TABLES}
    if options.preview:
        for table in tables.values():
            _preview(table)
    _to_database(tables, options)


def _to_database(tables: dict[str, DataFrame], options: argparse.Namespace) -> None:
    if options.jdbc_url:
        account = {"user": os.environ.get(USER_VARIABLE), "password": os.environ.get(PASSWORD_VARIABLE)}
        properties = {name: value for name, value in account.items() if value}
        publish_jdbc(tables, options.jdbc_url, properties, options.truncate, options.declared_types, options.connections)


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    if options.command == "stage":
        if options.rejects:
            staged = stage_csv_with_rejects(read_csv_with_rejects(spark, options.source), options.staged)
            print(f"{staged.row_count} rows in {options.staged}/rejected=false, {staged.reject_count} lines rejected")
            return
        raw = read_csv(spark, options.source, schema=None) if options.infer_types else read_csv(spark, options.source)
        stage_csv(raw, options.staged)
    elif options.command in ("ingest", "ingest-all"):
        _ingest(spark, options)
    elif options.command in ("transform", "transform-all"):
        _transform(spark, options)
    elif options.command == "expire":
        expire(spark, options.served, options.unchanged_for)
    else:
        keys = TokenKeys.from_environment(spark)
        arriving = read_arrivals(spark, options.source)
        if options.served:
            query = publish_arrivals(arriving, options.landed, options.served, options.checkpoint, keys)
        else:
            query = land_arrivals(arriving, options.landed, options.checkpoint, keys)
        query.awaitTermination()
        if options.served:
            _to_database({name: read_published(spark, options.served, name) for name in SERVED_TABLES}, options)


if __name__ == "__main__":
    session = SparkSession.builder.appName("tallymill").getOrCreate()
    try:
        run(session)
    finally:
        session.stop()
