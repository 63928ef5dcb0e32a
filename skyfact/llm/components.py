"""Connected components of a graph that lies in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfact.llm.shared import stored


def _link_to_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours are linked to the least of node and neighbours.

    Only the least neighbour is gathered per node, so a node with very many of them is one row in
    the join, and its edges can be split.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = edges.join(least, "u")
    if larger_only:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Edges (u, v) -> node, root: the least node that can be reached, for every node of an edge."""
    tidy = lambda df: df.filter(F.col("u") > F.col("v")).distinct()
    now = stored(tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), label)
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        stars = tidy(_link_to_least(both, larger_only=True))
        nxt = stored(tidy(_link_to_least(stars, larger_only=False)), label)
        # done when every node has one edge and no root has any
        many = nxt.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        chained = nxt.select(F.col("v").alias("u")).join(nxt.select("u"), "u", "left_semi")
        done = many.isEmpty() and chained.isEmpty()
        now = nxt
        if done:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
