"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadfeat.llm.shared import discard, store


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: for every node on an edge the smallest node it reaches.

    ``edges`` has long columns ``a`` and ``b``; loops and repeats are allowed, nodes without an edge
    do not appear. Alternates the large-star and small-star steps until every node points at its
    component's smallest node. Minima are partial aggregates, so a hub with very many neighbours is
    no hot group. Each round is written to the shared folder; nothing is collected.
    """
    links = edges.where("a != b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low"))
    links = store(links.distinct(), "components")
    while True:
        both = links.selectExpr("node as u", "low as v").union(links.selectExpr("low as u", "node as v"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("node"), F.col("m").alias("low")).distinct()
        parent = large.groupBy("node").agg(F.min("low").alias("m"))
        hooked = large.join(parent, "node").where("low != m").select(F.col("low").alias("node"), F.col("m").alias("low"))
        after = store(hooked.union(parent.select("node", F.col("m").alias("low"))).distinct(), "components")
        discard(links)
        links = after
        split = links.groupBy("node").agg(F.min("low").alias("x"), F.max("low").alias("y")).where("x < y")
        chained = links.join(links.select(F.col("node").alias("low")), "low", "left_semi")
        if split.select("node").union(chained.select("node")).isEmpty():
            return links.select("node", F.col("low").alias("component"))
