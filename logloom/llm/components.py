"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import checkpointed, compacted


def components(links: DataFrame) -> DataFrame:
    """node, label for the nodes of links (a, b); label is the component's least node.

    Each round takes the least label among a node and its neighbours and then
    the label of that label, so the rounds grow with the logarithm of a
    component's diameter. A hot node's neighbours meet in partial aggregates.
    """
    both = compacted(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = compacted(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")))
    parts = labels.rdd.getNumPartitions()
    while True:
        # Merged, as both sides grow with the links: a broadcast each round would pile up on the driver.
        around = both.join(labels.hint("merge"), both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(around.hint("merge"), labels["node"] == around["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = nearer.join(jump.hint("merge"), "label", "left").select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label"))
        moved = checkpointed(moved.coalesce(parts))
        labels = moved.select("node", "label")
        if moved.filter(F.col("old") != F.col("label")).isEmpty():
            return labels
