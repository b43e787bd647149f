"""Exact dedup with a heavy-hitter split.

Misra-Gries counters, one summary per partition, find every digest that may hold a given share of the rows. The few
candidates are counted exactly; those that do hold the share are broadcast together with the row that stays, so
their copies are removed where they are read. All other digests go through an ordinary shuffle, in which no group is
larger than that share.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import lowered, matching, saved, whole_text

#: A digest with this share of all rows or more is heavy.
HEAVY_SHARE = 1 / 256
#: Counters of each summary; four per possible heavy digest.
COUNTERS = 1023


def text_digest(text: str = "text") -> Column:
    """SHA-256, as lower-case hex, of the UTF-8 text with A-Z in lower case; null counts as empty."""
    return F.sha2(lowered(whole_text(text)).cast("binary"), 256)


def misra_gries(batches: Iterator[pd.DataFrame], counters: int = COUNTERS) -> Iterator[pd.DataFrame]:
    """At most ``counters`` digests of a partition; a digest's count falls short by rows / (counters + 1) at most."""
    held = pd.Series(dtype="int64")
    for batch in batches:
        held = held.add(batch["digest"].value_counts(), fill_value=0)
        if len(held) > counters:
            held = held - held.nlargest(counters + 1).iloc[-1]
            held = held[held > 0]
    yield pd.DataFrame({"digest": held.index.astype(str), "least": held.to_numpy("int64")})


def heavy_winners(rows: DataFrame, share: float = HEAVY_SHARE, counters: int = COUNTERS) -> DataFrame:
    """``digest, size, winner`` of the digests that hold ``share`` of ``rows`` or more: 1 / share of them at most.

    Summed over partitions, a digest's count falls short by N / (counters + 1) at most. So every heavy digest is among
    the candidates, and there are at most 1 / (share - 1 / (counters + 1)) candidates.
    """
    total = rows.agg(F.count("*").alias("total")).first()["total"]
    slack = share - 1 / (counters + 1)
    candidates = (
        rows.select("digest")
        .mapInPandas(lambda batches: misra_gries(batches, counters), "digest string, least bigint")
        .groupBy("digest")
        .agg(F.sum("least").alias("least"))
        .filter(F.col("least") >= slack * total)
        .select("digest")
    )
    return (
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("size"), F.max(F.struct("doc_id", "row")).alias("winner"))
        .filter(F.col("size") >= share * total)
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as the empty text, which forms a group like any
    other. The largest ``doc_id`` of a group stays; a null id loses against any other. Of rows that also repeat the id,
    exactly one is ``kept``. An empty table gives an empty result. Other columns are not read.
    """
    rows = saved(
        docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "digests",
    )
    winners = saved(heavy_winners(rows), "heavy")
    heavy = rows.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("size", F.count("*").over(group))
        .withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
    )
    return heavy.unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns."""
    kept = exact_groups(docs, doc_id, text).filter("kept").select("doc_id", "text_sha256")
    # Rows that repeat id and text meet the same key; one of them is let through.
    return matching(docs, doc_id, text_digest(text), kept, "left_semi").dropDuplicates(["key"]).select("doc.*")
