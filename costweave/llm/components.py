"""Connected components of a graph held as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costweave.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for every linked node the smallest node it is connected with.

    ``links`` holds pairs ``a, b`` of integers. Nodes take the smallest label around
    them, then the label of their label, until a round changes nothing; the second
    step makes long chains short. Each round combines before it shuffles, and stores its
    labels, so a hub is no group in one task and no round is computed twice.
    """
    both = stage(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links"
    )
    labels = stage(
        both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels"
    )
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("around"))
        lowered = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "around").alias("low")
        )
        above = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        jumped = lowered.join(above, "low", "left").select(
            "node", "old", F.least("low", F.coalesce("lower", "low")).alias("label")
        )
        jumped = stage(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label < old").isEmpty():
            return labels
