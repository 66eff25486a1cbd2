"""Connected components of edge tables, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import checkpoint, release


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for all nodes of ``edges`` (a, b).

    Each round takes the least label among a node and its neighbours, then the label of that label;
    the number of rounds grows with the logarithm of the longest path.  Tables are checkpointed, so
    the joins shuffle plain tables, which adaptive execution splits where a node has many edges.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    both = checkpoint(both)
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = checkpoint(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("hook")))
        jump = hooked.select(F.col("node").alias("hook"), F.col("hook").alias("top"))
        moved = checkpoint(hooked.join(jump, "hook").select("node", F.col("top").alias("label"), (F.col("top") != F.col("label")).alias("moved")))
        labels = moved.select("node", "label")
        release(spark)
        if moved.filter("moved").isEmpty():
            return labels
