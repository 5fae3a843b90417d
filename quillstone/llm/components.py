"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import checkpointed, join_counted


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b); root is the smallest node of its component.

    A large star links each node's larger neighbours to its smallest; a small star its smaller ones.
    Both are group-bys that keep a minimum first, so no neighbour list is gathered, and the minima of nodes
    with very many links are broadcast. The number of rounds grows with the logarithm of the component size;
    lineage is cut after each.
    """
    links = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        n = F.count(F.lit(1)).alias("n")
        low = checkpointed(both.groupBy("a").agg(F.min("b").alias("m"), n).select("a", F.least("a", "m").alias("m"), "n"))
        total = low.agg(F.sum("n")).first()[0] or 0
        large = checkpointed(join_counted(both, low, "a", total).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        down = checkpointed(large.groupBy("a").agg(F.min("b").alias("m"), n))
        small = join_counted(large, down, "a", total).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        links = checkpointed(small)
        # A round that changes no link has reached stars: then every node is linked to its root alone.
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
