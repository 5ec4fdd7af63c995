"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.store import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); the label is its smallest reachable node.

    Each step takes the smallest label among neighbours and then that label's own
    label, so paths halve as they shrink.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")
    ))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        )
        nearer = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        heads = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        stepped = nearer.join(heads, nearer["label"] == heads["at"], "left").select(
            "node", F.least("label", F.coalesce("jump", "label")).alias("label"), "old"
        )
        stepped = stored(stepped)
        moved = stepped.filter("label <> old").limit(1).count()
        labels = stepped.select("node", "label")
        if not moved:
            return labels
