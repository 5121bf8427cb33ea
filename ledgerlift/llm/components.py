"""Connected components as joins: the smallest node that each node can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for all ends of the edges ``a``-``b``.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so the
    rounds grow with the logarithm of a component's diameter rather than with the diameter. Every round is
    staged; nothing is collected but the number of labels that changed. Edges with a null end are left out.
    """
    edges = edges.where("a is not null and b is not null")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "edges")
    labels = stage(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
        "labels",
    )
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        least = both.join(seen, "b").groupBy("a").agg(F.min("near").alias("near")).withColumnRenamed("a", "node")
        lower = labels.join(least, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("to"))
        target = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        moved = lower.join(target, "to").select("node", "was", F.least("to", "beyond").alias("label"))
        moved = stage(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> was").isEmpty():
            return labels
