"""Connected components by alternating large and small stars.

Every round is two grouped minima and two joins over the links; the links of a round are
written to the shared checkpoint folder, so a lost executor costs one round at most. No
component is ever gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import cut_lineage


def _towards_minimum(links: DataFrame, large: bool) -> DataFrame:
    """Link every larger (large) or no larger (small) neighbour of a node to the node's least neighbour."""
    if large:
        sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = sides.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of a table of links (u, v longs); root is the component's least node."""
    current = cut_lineage(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(rounds):
        seen = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == state or not seen[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
        current = cut_lineage(_towards_minimum(_towards_minimum(current, True), False))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
