"""Connected components by spreading the smallest label and following labels of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.storage import fresh_folder, stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: bigint); label is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then that node's own label, so the number of
    rounds grows with the logarithm of a component's width. Minima are combined before the shuffle, so a node with very
    many links is no problem. Null ends are left out. Every round is written to shared storage.
    """
    spark = links.sparkSession
    links = links.where("a is not null and b is not null and a <> b")
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = stored(edges, fresh_folder(spark, "edges"))
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label"))
    labels = stored(labels, fresh_folder(spark, "labels"))
    while True:
        offered = (
            edges.join(labels, edges.b == labels.node)
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("offer"))
        )
        nearer = labels.join(offered, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("near")
        )
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = nearer.join(jump, "near").select("node", "old", F.least("near", "far").alias("label"))
        moved = stored(moved, fresh_folder(spark, "labels"))
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels
