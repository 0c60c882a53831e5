"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonloom.session import cut_lineage


def groups(edges: DataFrame) -> DataFrame:
    """``node, group``: of every node of ``edges`` (columns a and b, one type) the smallest node it is connected with.

    Each step links all neighbours of a node, and the node, to the smallest of them: larger ones as they are, then those
    that became smaller. A step's edges are no more than those it began with, and are written to the shared folder.
    """

    def steps(pairs: DataFrame, only_larger: bool) -> DataFrame:
        least = pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        if only_larger:
            linked = pairs.where("other > node").join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b"))
        else:
            linked = pairs.join(least, "node").select(F.col("other").alias("a"), F.col("least").alias("b")).unionAll(
                least.select(F.col("node").alias("a"), F.col("least").alias("b"))
            )
        return linked.where("a <> b").distinct()

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    last, current = None, state(now)
    while current != last:
        both = now.selectExpr("a as node", "b as other").unionAll(now.selectExpr("b as node", "a as other"))
        larger = steps(both, True).selectExpr("greatest(a, b) as node", "least(a, b) as other").distinct()
        now = cut_lineage(steps(larger, False).selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct())
        last, current = current, state(now)
    alone = edges.selectExpr("a as node").unionAll(edges.selectExpr("b as node")).distinct()
    found = now.selectExpr("a as n", "b as g")
    return alone.join(found, alone["node"] == found["n"], "left").select("node", F.coalesce("g", "node").alias("group"))
