"""Connected components of a graph that no task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerproof.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of that
    label, so long chains shorten quickly. Rounds are cut at a written table; a hot node is
    a key of map-side aggregates and splittable joins.
    """
    both = settle(
        links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = settle(labels.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        around = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearer = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("next"))
        of_label = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        jumped = nearer.join(of_label, "next", "left")
        new = jumped.select("node", F.least("next", "jump").alias("new"), "label")
        new = settle(new.select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
