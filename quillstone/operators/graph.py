"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.operators.skew import dealt_join, kept


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges(a, b); root is the smallest node of its component.

    In each round a node takes the smallest root among its own and its neighbours', then the root of that root, so rounds grow with the logarithm of the
    longest path. Minima are taken before rows are shuffled; a root of very many nodes is dealt out; lineage is cut after each round.
    """
    both = kept(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("root")))
    while True:
        seen = dealt_join(labels.select(F.col("node").alias("b"), "root"), both, ["b"], ["a"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("low"))
        lower = kept(labels.join(seen, "node", "left").select("node", F.least("root", "low").alias("root")))
        onward = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = kept(dealt_join(onward, lower, ["root"], ["node"]).select("node", F.col("next").alias("root")))
        changed = jumped.join(labels.withColumnRenamed("root", "old"), "node").filter("root <> old").limit(1).count()
        labels = jumped
        if not changed:
            return labels
