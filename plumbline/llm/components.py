"""Connected components of a link table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.shared import settled


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it can reach, for each node of ``links`` (``a``, ``b``).

    Each round takes the smallest label among a node's neighbours and then that label's own label,
    so long chains shorten by more than half. Rounds are written to the shared folder, which cuts
    lineage, and end when no label changes. Smallest labels combine before the shuffle, so a node
    with very many links is no hot group.
    """
    both = settled(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels-0")
    step = 0
    while True:
        step += 1
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        lower = (labels.join(near, labels.node == near.a)
                 .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = labels.select(F.col("node").alias("_up"), F.col("label").alias("_label"))
        nxt = settled(lower.join(up, lower.label == up["_up"])
                      .select("node", "old", F.least("label", "_label").alias("label")), f"labels-{step}")
        changed = nxt.filter("label <> old").limit(1).count()
        labels = nxt.select("node", "label")
        if not changed:
            return labels
