"""Connected components of a large edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Labels start at the smallest neighbour. Each round takes the minimum of the neighbours' labels (a
    partial aggregate, so a node with many edges is combined before the shuffle) and then jumps to the
    label of the label, which halves the length of every chain. Each round's labels are written to the
    shared folder; only the count of changes reaches the driver.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("component")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m")))
        least = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "m").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("cc"))
        new = materialise(least.join(jump, "c").select("node", "old", F.least("c", "cc").alias("component")))
        if not new.where(F.col("old") != F.col("component")).limit(1).count():
            return new.select("node", "component")
        labels = new.select("node", "component")
