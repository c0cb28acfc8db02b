"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for edges ``u, v``; a component is named by its smallest node.

    Each round gives a node the smallest label among its neighbours, then that label's own
    label, so long chains shrink by more than half a round. Labels are written to the shared folder
    every round. Loops and repeated edges do no harm; nodes without edges do not appear.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = stored(both.distinct(), "edges")
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
    labels = stored(labels.select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        seen = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("component").alias("low"))
        near = labels.join(seen, labels.node == seen.u).select(
            "node", F.col("component").alias("old"), F.least("component", "low").alias("component")
        )
        near = stored(near, "labels")
        of = near.select(F.col("node").alias("at"), F.col("component").alias("further"))
        jumped = near.join(of, near.component == of.at).select(
            "node", F.col("further").alias("component"), (F.col("further") != F.col("old")).alias("moved")
        )
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("moved").limit(1).count() == 0:
            return labels
