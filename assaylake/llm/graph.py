"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least reachable node, for all nodes of ``edges`` (``a``, ``b``; null in neither).

    Each round a node takes the least label of its neighbours and then its label's label, so labels travel along paths
    at doubling speed. Rounds are stored; the last is the one that changed nothing. A hub is no hot spot: its
    neighbours' labels are reduced where they are before they meet.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    labels = stored(
        nodes.join(least, F.col("node") == F.col("a"), "left").select("node", F.least("node", "m").alias("component")), "labels"
    )
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("m"))
        moved = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", F.col("component").alias("old"), F.least("component", "m").alias("component")
        )
        moved = stored(moved, "labels")
        jump = moved.select(F.col("node").alias("at"), F.col("component").alias("next"))
        jumped = moved.join(jump, F.col("component") == F.col("at")).select(
            "node", F.least("component", "next").alias("component"), F.col("old")
        )
        jumped = stored(jumped, "labels")
        if jumped.where("component <> old").isEmpty():
            return jumped.select("node", "component")
        labels = jumped.select("node", "component")
