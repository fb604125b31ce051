"""Connected components of an edge list by label spreading on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component: least node.

    Each round takes the least label of a node's neighbours, then the label of its
    label, so the rounds grow with the logarithm of a chain's length. Labels are
    written and read again each round; one number per round comes to the driver.
    """
    both = stored(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .where("node != other")
        .distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("component")),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("c")), "other")
        least = near.groupBy("node").agg(F.min("c").alias("m"))
        spread = labels.join(least, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "m").alias("c")
        )
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("cc"))
        new = stored(
            spread.join(jump, "c", "left").select(
                "node", "was", F.coalesce(F.least("c", "cc"), F.col("c")).alias("component")
            ),
            "labels",
        )
        changed = new.where("component != was").limit(1).count()
        labels = new.select("node", "component")
        if not changed:
            return labels
