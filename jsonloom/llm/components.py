"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonloom.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from each node that has an edge.

    ``edges`` has bigint columns a and b. Large-star and small-star steps alternate: the first links the larger
    neighbours of a node to the smallest, the second its smaller ones, until no edge changes; a step keeps at most one
    edge for each that it gets, and the number of steps grows with the logarithm of the longest path. Each step's edges
    are written to the shared folder, so nothing is computed twice when an executor is lost.
    """

    def starred(pairs: DataFrame, large: bool) -> DataFrame:
        """pairs: node, other. Each other is linked to the smallest of the node and its others."""
        least = pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        linked = pairs.join(least, "node")
        kept = linked.where("other > node") if large else linked
        return kept.select(F.col("other").alias("a"), F.col("least").alias("b"))

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def summary(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row.n, row.h

    now = cut_lineage(ordered(edges))
    state = summary(now)
    while state[0]:
        both = now.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(now.select("b", "a"))
        large = ordered(starred(both, large=True))
        down = large.select(F.col("a").alias("node"), F.col("b").alias("other"))
        small = starred(down, large=False).unionAll(
            down.groupBy("node").agg(F.min("other").alias("b")).select(F.col("node").alias("a"), "b")
        )
        now = cut_lineage(ordered(small))
        last, state = state, summary(now)
        if state == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
