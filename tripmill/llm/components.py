"""Connected components of a table of links, on executors only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.session import settle


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (columns a, b): component is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label's own
    label, so chains shorten by half; labels are stored between rounds. Only the
    number of changed labels comes to the driver.
    """
    both = links.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("_e"))
    edges = settle(both.select("_e.a", "_e.b").distinct(), "edges")
    labels = settle(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        lower = settle(
            labels.join(near, labels.node == near.a).select("node", F.col("component").alias("old"), F.least("component", "near").alias("component")),
            "lower",
        )
        roots = lower.select(F.col("node").alias("_root"), F.col("component").alias("_next"))
        jumped = lower.join(roots, lower.component == roots._root).select("node", "old", F.least("component", "_next").alias("component"))
        labels = settle(jumped, "labels")
        if not labels.where("component <> old").limit(1).count():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
