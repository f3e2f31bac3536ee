"""Connected components of an edge table by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import heavy_keys, spread_join, written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b): the smallest node reachable.

    Each round takes the smallest label among a node's neighbours (summed
    map-side, so a hub costs one row per task) and then the label of that
    label, which halves chains. The rows of a hub, and of a label that many
    nodes have, are spread over tasks. Rounds go on until no label changes;
    each is written to the shared folder."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "links")
    nodes = written(both.groupBy(F.col("a").alias("b")).agg(F.count(F.lit(1)).alias("degree"),
                                                            F.min(F.least("a", "b")).alias("first")), "nodes")
    hubs = heavy_keys(nodes, "b", "degree")
    labels = nodes.select(F.col("b").alias("node"), F.col("first").alias("label"))
    while True:
        near = (spread_join(both, labels.withColumnRenamed("node", "b"), "b", hubs, "a")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near")))
        stepped = written(labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "_near").alias("label")), "labels")
        holders = stepped.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        tops = written(holders.join(labels.select(F.col("node").alias("label"), F.col("label").alias("top")), "label"), "tops")
        jumped = written(spread_join(stepped, tops.select("label", "top"), "label", heavy_keys(tops, "label", "n"), "node")
                         .select("node", "old", F.least("label", "top").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("old <> label").isEmpty():
            return labels
