"""Connected components by distributed label propagation with pointer jumping."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for all nodes of ``links`` (a, b: long).

    Every round takes the smallest label among a node and its neighbours, then the label's own label. Labels are
    written each round, so joins meet plain tables (Spark may split a node with very many links) and nothing is
    recomputed after a loss. The sum of all labels falls until it stays.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))).where(F.col("node") != F.col("other"))
    edges = stored(both.distinct(), "edges")
    labels = stored(edges.groupBy("node").agg(F.min("other").alias("low")).select(
        "node", F.least("node", "low").alias("component")), "labels")
    last = None
    while True:
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total == last:
            return labels
        last = total
        of_other = labels.select(F.col("node").alias("other"), "component")
        heard = edges.join(of_other, "other").select("node", "component").unionByName(labels)
        nearer = stored(heard.groupBy("node").agg(F.min("component").alias("component")), "labels")
        jump = nearer.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = stored(nearer.join(jump, "component").select(
            "node", F.least("component", "further").alias("component")), "labels")
