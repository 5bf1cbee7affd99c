"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.sqltext import save_shared


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest
    node reachable.

    Each round takes the smallest label among the neighbours and then the
    label of that label, so labels travel in doubling steps. A node with many
    edges is combined map-side, and labels are read from a written table, so a
    join on a frequent node can be split. Ends when a round changes nothing.
    """
    both = edges.select("a", "b").where("a <> b").distinct()
    both = save_shared(both.union(both.select("b", "a")).toDF("a", "b"), f"{name}-edges")
    labels = save_shared(both.select(F.col("a").alias("node")).distinct()
                         .withColumn("root", F.col("node")), f"{name}-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        low = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("next"))
        moved = save_shared(low.join(jump, "low").select(
            "node", F.least("low", "next").alias("root"),
            (F.least("low", "next") != F.col("old")).alias("moved")), f"{name}-labels")
        labels = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            return labels
