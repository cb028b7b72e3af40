"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least reachable node) of every node of the edges; checkpointed.

    Every round takes the least label among a node and its neighbours, then the label's own label, until
    nothing changes.  Links are combined before they are shuffled, so a node with very many neighbours is split.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("to")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("to"))).distinct().checkpoint()
    labels = both.groupBy("node").agg(F.least("node", F.min("to")).alias("component")).checkpoint()
    while True:
        near = (both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("component").alias("least")))
        moved = labels.join(near, "node").select("node", "component", F.least("component", "least").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        after = (moved.join(jump, "next", "left")
                 .select("node", F.col("component").alias("was"), F.least("next", F.coalesce("beyond", "next")).alias("component")).checkpoint())
        labels = after.select("node", "component")
        if after.where("was <> component").isEmpty():
            return labels
