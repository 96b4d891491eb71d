"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlens.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of longs, neither null, to (node, component): the smallest
    node reachable. Nodes without a link are not in the result.

    Each round takes the smallest label among a node's neighbours and then its
    label's own label, so the rounds grow with the logarithm of the longest
    chain. Both sides of each join are checkpointed tables under a plain
    shuffle, which the engine can split where one node or label has very many
    rows; the smallest label is pre-aggregated before its shuffle.
    """
    both = checkpoint(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = checkpoint(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        target = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = checkpoint(lower.join(target, "label").select("node", "old", F.least("label", "next").alias("label")))
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
