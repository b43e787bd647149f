"""Reading tables and keeping intermediate ones."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str, kept: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, and lost executors cost no second run.

    The path is added to ``kept``, for a caller that removes its tables after use.
    """
    path = scratch_path(df.sparkSession, label)
    if kept is not None:
        kept.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def matching(docs: DataFrame, doc_id: str, mark: Column, listed: DataFrame, how: str) -> DataFrame:
    """``key, doc``: the rows of ``docs`` whose id and mark are (``left_semi``) or are not (``left_anti``) in ``listed``.

    ``listed`` has two columns, an id and a mark; null ids match each other. A row travels as one value under one key, so no name
    among its columns matters, and what follows by ``key`` needs no second shuffle. ``select("doc.*")`` gives the columns back.
    """
    id_name, mark_name = listed.columns

    def key(own: Column, marked: Column) -> Column:
        # Of one type on both sides, null or not: what differs in that would be cast, and shuffled anew by what follows.
        return F.struct(*[F.coalesce(x.cast("string"), F.lit("")) for x in (own, marked)], own.isNull()).alias("key")

    rows = docs.select(key(F.col(f"`{doc_id}`"), mark), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    keys = listed.select(key(F.col(id_name), F.col(mark_name)))
    return rows.join(keys, "key", how)


def by_row(df: DataFrame, make: Callable[[str], list[tuple]], schema: str) -> DataFrame:
    """Any number of rows for each row of ``df``, whose last column is a text.

    ``make`` sees the text; each tuple that it returns follows the other columns. Those, ids among them, stay in Arrow, so
    that a null among them turns no number into a float. ``schema`` names the columns of the tuples.
    """
    names = df.columns[:-1]
    kinds = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)
    added = [x.split()[0] for x in schema.split(", ")]
    types = [_ARROW[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, _TEXTS) for i in range(0, batch.num_rows, _TEXTS)):
                which, rows = [], []
                for i, text in enumerate(part.column(len(names)).to_pylist()):
                    found = make(text)
                    which += [i] * len(found)
                    rows += found
                taken = part.select(names).take(pa.array(which, pa.int64()))
                columns = zip(*rows, strict=True) if rows else [[]] * len(added)
                arrays = [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*taken.columns, *arrays], names=[*names, *added])

    return df.mapInArrow(run, f"{kinds}, {schema}")


#: Texts that a worker holds as Python objects at a time.
_TEXTS = 256

_ARROW = {
    "bigint": pa.int64(),
    "double": pa.float64(),
    "binary": pa.binary(),
    "string": pa.string(),
    "boolean": pa.bool_(),
}
