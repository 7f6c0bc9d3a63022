"""Connected components of a distributed edge list by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintide.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Every round points each node at its smallest neighbour, follows the pointers to their roots and contracts
    the edges to roots, so a star takes one round and a path a logarithmic number. Pointers go to smaller nodes
    only, hence the last root is the smallest node. Every round's tables are stored in the shared folder.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = labels.withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        roots = stored(roots.withColumn("root", F.least("node", "root")), "pointers")
        while True:
            above = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stored(roots.join(above, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "pointers")
            roots = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        up = roots.select(F.col("node").alias("component"), "root")
        labels = stored(
            labels.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "labels"
        )
        for end in ("a", "b"):
            edges = edges.join(roots.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("root", end)
        edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    return labels
