"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from semestra.llm.storage import dropped, stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least node it knows."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every node and its neighbours below are linked to the least of these."""
    least = _least(pairs)
    below = pairs.join(least, "u").where("v <> m")
    return below.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``root`` (least node of its component) for every node of an edge.

    Nodes are of any ordered type. Loops and rows with a null end are ignored; repeated
    edges count once; no edges give no rows. Each round is written to the shared folder,
    and the rounds grow with the logarithm of the longest chain.
    """
    ends = edges.select(F.col(first).alias("a"), F.col(second).alias("b")).where("a <> b")
    pairs = stored(
        ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars"
    )
    mark = None
    while True:
        after = stored(_small_star(_large_star(pairs).distinct()).distinct(), "stars")
        dropped(pairs)
        pairs = after
        now = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if now == mark:
            break
        mark = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
