"""Entities from links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minutesmith.runtime import keep


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, entity): connected components, by minima of neighbours until nothing changes; each round is written to the shared folder."""
    both = keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "linking-links")
    labels = keep(nodes.select("node", F.col("node").alias("entity")), "linking-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("entity").alias("least"))
        stepped = labels.join(near, "node", "left").select("node", F.least("entity", F.coalesce("least", "entity")).alias("via"), "entity")
        # Pointer jump: take the label of the label.
        jumped = stepped.join(labels.select(F.col("node").alias("via"), F.col("entity").alias("top")), "via", "left").select("node", F.least("via", F.coalesce("top", "via")).alias("entity"), (F.least("via", F.coalesce("top", "via")) < F.col("entity")).alias("moved"))
        labels = keep(jumped, "linking-labels")
        if labels.where("moved").limit(1).count() == 0:
            return labels.select("node", "entity")
        labels = labels.select("node", "entity")
