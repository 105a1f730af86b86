"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links (a, b)``; the label is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then follows the label's own
    label, which halves long chains. Every round is staged, so lost executors cost one round.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stage(both, "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.least("label", "near").alias("next"), F.col("label").alias("was")
        )
        of = labels.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        jumped = stage(
            met.join(of, F.col("next") == F.col("n2"), "left").select(
                "node", F.least("next", F.coalesce("l2", "next")).alias("label"), "was"
            ),
            "labels",
        )
        done = jumped.where("label <> was").isEmpty()
        labels = jumped.select("node", "label")
        if done:
            return labels
