"""Connected components of links, as alternating joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the least node reachable.

    Each step first hooks the larger neighbours of a node to its least neighbour, then the
    smaller ones, until the links form stars. Minima are aggregated before they are shuffled.
    """
    edges = written(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v <> u").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("label")).distinct()
            )
        before = state
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = written(large.where("v <> u").distinct())
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = written(small.select(F.col("e.u").alias("v"), F.col("e.m").alias("u")).where("v <> u").distinct())
