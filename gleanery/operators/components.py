"""Connected components by hooking and doubling: rounds grow with the logarithm of a component's breadth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.lineage import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the edges (a, b), two columns of one type; the label is the least node.

    In each round every label takes the least label that an edge connects it with, and then twice
    the steps from label to label. Minima are aggregated before they are shuffled.
    """
    edges = cut(edges.select("a", "b").distinct())
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    at = cut(nodes.withColumn("label", F.col("node")))
    while True:
        left = at.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = at.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        apart = cut(edges.join(left, "a").join(right, "b").where("la <> lb").select("la", "lb").distinct())
        if apart.isEmpty():
            return at
        hooks = apart.select(F.greatest("la", "lb").alias("label"), F.least("la", "lb").alias("to"))
        hooks = cut(hooks.groupBy("label").agg(F.min("to").alias("to")))
        while True:
            # A label's least neighbour is smaller than it, so steps end at a label without one.
            next_ = hooks.select(F.col("label").alias("to"), F.col("to").alias("further"))
            stepped = cut(hooks.join(next_, "to", "left").select("label", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
            hooks = stepped.select("label", "to")
            if stepped.where("moved").isEmpty():
                break
        at = cut(at.join(hooks, "label", "left").select("node", F.coalesce("to", "label").alias("label")))
