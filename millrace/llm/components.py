"""Connected components of an edge table, without bringing edges or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.workspace import materialize


def _least(edges: DataFrame) -> DataFrame:
    """For each node the smallest of itself and its neighbours; counted before it is shuffled."""
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge.

    ``edges`` has the columns ``u`` and ``v`` of any one orderable type; direction, repeats and loops do not matter.
    Rounds of large-star and small-star link every node to smaller and smaller nodes until each hangs
    directly on its root; their number grows with the logarithm of the longest path. Every round is written
    down, so that a lost executor costs a part of one round only. The driver sees one number for each round.
    """
    both = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = materialize(both.distinct(), "edges")
    while True:
        # large star: every larger neighbour of a node is linked to the node's smallest
        around = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(around).select("u", F.least("u", "least").alias("least"))
        large = around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = materialize(large.distinct(), "edges")
        # small star: a node and its smaller neighbours are linked to the smallest of them
        least = _least(large)
        joined = large.join(least, "u")
        small = joined.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(joined.select("u", F.col("least").alias("v")))
        after = materialize(small.distinct(), "edges")
        moved = after.join(current, ["u", "v"], "left_anti").limit(1).count()
        moved = moved or current.join(after, ["u", "v"], "left_anti").limit(1).count()
        current = after
        if not moved:
            break
    roots = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
