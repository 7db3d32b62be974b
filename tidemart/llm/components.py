"""Connected components of an edge table by alternating star contractions.

Each round links every node's larger neighbours to its smallest neighbour, then
every node's smaller neighbours to the smallest one; the edge table never grows
and ends as stars around the smallest node of each component after a number of
rounds that is logarithmic in practice. Every round is a grouped minimum
(partially aggregated before its shuffle) and an equi join that the planner may
split, and is written to the shared folder so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import write_and_read


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; ``edges`` has columns a and b of one type.

    Loops and null ends are dropped; the component is its smallest node.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct()
    pairs = write_and_read(pairs, "cc")
    before = None
    for _ in range(max_rounds):
        state = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == before:
            return pairs.groupBy("v").agg(F.min("u").alias("u")).select(
                F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
                pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        before = (state["n"], state["h"])
        # large star: neighbours in both directions, smallest m; larger neighbours go to m
        both = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("w")).agg(F.min("u").alias("m0")).select(
            "w", F.least("w", "m0").alias("m"))
        large = both.where("u > v").join(least, F.col("v") == F.col("w")).select(
            F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        large = write_and_read(large, "cc")
        # small star: a node's smaller neighbours and itself go to the smallest
        least = large.groupBy(F.col("v").alias("w")).agg(F.min("u").alias("m"))
        small = large.join(least, F.col("v") == F.col("w")).select(
            F.explode(F.array("u", "v")).alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        pairs = write_and_read(small, "cc")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
