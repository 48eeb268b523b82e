"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b); a component is its smallest node.

    Each round gives a node the smallest label beside it and then the label of its label,
    so that paths shrink by more than half; rounds end when no label changes. Neighbours
    are reduced by partial aggregation, a hot node is never gathered in one task.
    """
    both = materialize(
        edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a"))
    )
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select(
        "node", F.least("node", "n").alias("component")
    ))
    while True:
        beside = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("component").alias("least")
        )
        lower = labels.join(beside, F.col("node") == F.col("a")).select(
            "node", "component", F.least("component", "least").alias("least")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        next_labels = materialize(
            lower.join(jump, F.col("least") == F.col("via")).select(
                "node", F.least("least", "further").alias("component"), F.col("component").alias("old")
            )
        )
        changed = next_labels.filter(F.col("component") != F.col("old")).limit(1).count()
        labels = next_labels.select("node", "component")
        if not changed:
            return labels
