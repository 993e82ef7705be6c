"""Connected components of an edge table that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b): node ids of one type. Returns (node, label): label is the smallest node reachable from node.

    Each round takes the smallest label among a node's neighbours, then follows that label one step further, so long chains
    shorten by half a round. Rounds are written to the shared folder; only the count of changed labels reaches the driver.
    Minima combine before the shuffle, so a node with very many edges isn't gathered anywhere. No edges: no rows.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("offered")), "b").groupBy(F.col("a").alias("node")).agg(F.min("offered").alias("offered"))
        lower = labels.join(heard, "node").select("node", F.col("label").alias("before"), F.least("label", "offered").alias("label"))
        step = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(lower.join(step, "label", "left").select("node", "before", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("label <> before").isEmpty():
            return labels
