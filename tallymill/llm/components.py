"""Connected components by contraction, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import saved
from tallymill.scratch import remove


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; nodes have one root exactly when links connect them.

    In a round every node points to the smallest node beside it, pointers jump until each reaches the end of its chain, and the
    links are those between the ends. A node that no other is smaller than stays where it is, but one of its neighbours
    has found a smaller one by the next round, so at least half of the nodes that still have links go with every two rounds; a
    chain of n pointers takes about log2(n) jumps. Each step is written, and tables of earlier ones are removed.
    """
    spark, older = links.sparkSession, []

    ordered = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = saved(ordered, "links", older)
    roots = None
    while roots is None or not edges.isEmpty():
        newer: list[str] = []
        both = edges.select("a", "b").union(edges.select("b", "a"))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("to"))
        moves = _ends(saved(nearest, "moves", older), older)
        if roots is None:
            found = moves.select("node", F.col("to").alias("root"))
        else:
            step = moves.select(F.col("node").alias("root"), "to")
            found = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = saved(found, "roots", newer)
        for_a, for_b = moves.toDF("a", "na"), moves.toDF("b", "nb")
        between = (
            edges.join(for_a, "a")
            .join(for_b, "b")
            .filter("na <> nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
            .distinct()
        )
        edges = saved(between, "links", newer)
        for path in older:
            remove(spark, path)
        older = newer
    return roots


def _ends(moves: DataFrame, kept: list[str]) -> DataFrame:
    """Pointers ``node, to`` led to the ends of their chains, by pointing to where the pointed to point."""
    while True:
        further = moves.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = saved(moves.join(further, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "jumps", kept)
        if jumped.filter("moved").isEmpty():
            return jumped.drop("moved")
        moves = jumped.drop("moved")
