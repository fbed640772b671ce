"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node.

    Each round writes its edges, so lineage stays short and a lost executor
    costs a re-read.  The driver sees two numbers a round.
    """
    e = stored(edges.filter(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", free=True)
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Large star: larger neighbours go to the least of the neighbourhood.
        large = (both.join(least, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        # Small star: smaller neighbours and the node itself do.
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.unionByName(root.select("a", F.col("m").alias("b"))).distinct(), "edges", free=True)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
