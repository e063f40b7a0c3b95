"""Connected components of an edge table, by alternating large and small stars, without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.grouping import materialised


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (large: all larger ones; small: all smaller ones) are tied to its least neighbour."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    tied = both.join(least, "u")
    moved = tied.filter(F.col("v") > F.col("u")) if large else tied.filter(F.col("v") != F.col("m")).select("u", "v", "m")
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(tied.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v), root the least node that it reaches.

    Every pass is written to the shared folder, so lineage stays short. A hub's neighbours are summed up
    before the shuffle (a minimum), and the join with them is one that Spark can split.
    """
    now = materialised(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = materialised(_star(_star(now, True), False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
