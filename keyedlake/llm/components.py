"""Connected components of an edge table, by minimum labels and pointer jumping in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is the least node reachable.

    Each round takes the least label of a node and its neighbours, then the label's
    own label.  Labels are written to the shared folder each round, which cuts lineage.
    """
    both = staged(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "edges")
    labels = staged(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), "label"), "other").select("node", "label")
                .unionByName(labels).groupBy("node").agg(F.min("label").alias("near")))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        after = staged(near.join(jump, "near", "left").join(labels, "node")
                       .select("node", F.coalesce("far", "near").alias("label"), F.col("label").alias("before")),
                       "labels")
        labels = after.select("node", "label")
        if after.filter("label <> before").isEmpty():
            return labels
