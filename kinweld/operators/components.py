"""Connected components by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweld.sources.storage import discard, materialized


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) of every id of ``nodes``; component is the smallest id
    reachable over ``edges`` (a, b), in any direction.

    Each round a node takes the smallest label of its neighbours (aggregated
    on the map side before the join), then the label of its label, so long
    chains shrink by half. Rounds end when no label changes.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialized(both)
    jumped_last = None
    labels = both.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id"))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("least"))
        stepped = labels.join(near, labels["id"] == near["a"], "left").select("id", F.col("component").alias("was"), F.least("component", "least").alias("component"))
        up = stepped.select(F.col("id").alias("up"), F.col("component").alias("over"))
        jumped = stepped.join(up, F.col("component") == F.col("up"), "left").select("id", "was", F.least("component", "over").alias("component"))
        jumped, before = materialized(jumped), jumped_last
        labels, jumped_last = jumped.select("id", "component"), jumped
        if before is not None:
            discard(before)
        if jumped.where("component <> was").isEmpty():
            break
    discard(both)
    found = labels.select(F.col("id").alias("linked"), "component")
    return nodes.select("id").join(found, F.col("id") == F.col("linked"), "left").select("id", F.coalesce("component", "id").alias("component"))
