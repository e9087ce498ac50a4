"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homegrid.session import drop_stored, stored_copy


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """``links`` (u, v) to one row (node, root) per node that has a link; root is its component's least node.

    Each round takes the least label among a node's neighbours and then the label of that
    label, so the rounds grow with the logarithm of the longest path. Labels are written to
    the shared folder each round; nothing but a count comes to the driver. An empty table
    gives no rows; links of a node with itself and repeated links change nothing.
    """
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = stored_copy(both.where("u is not null and v is not null").distinct(), f"{purpose}-links")
    labels = stored = stored_copy(edges.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("root")), purpose)
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("v"), "root"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        least = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = stored_copy(
            least.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("far", "root")).alias("root")),
            purpose,
        )
        drop_stored(stored)
        labels, stored = after.select("node", "root"), after
        if after.where("old <> root").isEmpty():
            drop_stored(edges)
            return labels
