"""Connected components of a table of links, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b): component is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label of that
    label, so that paths shrink by half. Labels are written after every round: a lost
    executor costs a read, and the plan does not grow. A hub is summed up before the
    shuffle. No links give no rows.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = stored(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        closer = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        target = labels.select(F.col("node").alias("least"), F.col("label").alias("beyond"))
        after = stored(
            closer.join(target, "least").select(
                "node",
                F.least("least", "beyond").alias("label"),
                (F.least("least", "beyond") < F.col("label")).alias("moved"),
            ),
            "labels",
        )
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels.withColumnRenamed("label", "component")
