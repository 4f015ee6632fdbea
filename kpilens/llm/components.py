"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); root is the smallest node reachable.

    Each round is two aggregates (minimum neighbour) and two joins; a hub's rows are combined
    before the shuffle and AQE splits its join. Rounds go on until the edge set stays the same,
    about log(path length) times. Nodes without an edge do not appear.
    """
    e = stored(edges.where(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _mark(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low2, "u")
        small = (hung.select("u", F.col("m").alias("v"))
                 .union(hung.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))
                 .where(F.col("u") != F.col("v")).distinct())
        e = stored(small, "edges")
        new = _mark(e)
        if new == mark:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        mark = new


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
