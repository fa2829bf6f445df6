"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of ``links``; the label is the component's least node.

    In every round a node takes the least label among its neighbours and then the
    label of its label, so long chains shrink by doubling. Each round is written to the
    shared folder; the driver sees only whether anything changed. Null ends and links
    of a node to itself are left out.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = materialize(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        heads = nearer.select(F.col("node").alias("head"), F.col("label").alias("head_label"))
        jumped = nearer.join(heads, F.col("label") == F.col("head")).select(
            "node", "was", F.least("label", "head_label").alias("label")
        )
        stored = materialize(jumped, "labels")
        labels = stored.select("node", "label")
        if stored.where("label < was").isEmpty():
            return labels
