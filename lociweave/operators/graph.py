"""Connected components by alternating large-star and small-star steps, all joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.storage import written


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of each component, for every node that an edge names.

    Edges with a null end are ignored, self-loops name a node.  Every round rewrites the edges so that they point at
    smaller nodes; minima are taken by aggregates that combine before the shuffle, so a hub costs no single task, and
    the edges of a round are written to the shared folder, which cuts the plan.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).dropna()
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = written(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(floor.select("u", F.col("m").alias("v"))).distinct(), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark or not found[0]:
            break
        mark = found
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    root = now.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(root, nodes.node == root.u, "left").select("node", F.coalesce("component", "node").alias("component"))
