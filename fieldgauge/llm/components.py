"""Connected components by labels that travel along links, with every table on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) to (node, component): the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then that label's own
    label, which doubles the reach. Joins on a node with very many links can be split by
    adaptive execution; the grouping afterwards reduces in each task first. Rounds end
    when no label changes. No links give no rows.
    """
    links = stored(links.where("a <> b").distinct(), "links")
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("component")
        ),
        "labels",
    )
    while True:
        heard = both.join(labels, "node").select(F.col("other").alias("node"), "component")
        least = stored(
            labels.unionByName(heard).groupBy("node").agg(F.min("component").alias("component")), "labels"
        )
        jump = least.select(F.col("node").alias("component"), F.col("component").alias("further"))
        # A component is a node too, so every row finds its match.
        after = stored(
            least.join(jump, "component").select("node", F.col("further").alias("component")), "labels"
        )
        changed = after.join(labels.withColumnRenamed("component", "before"), "node").where("component <> before")
        if changed.isEmpty():
            return after
        labels = after
