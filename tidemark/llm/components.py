"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node, label (its component's smallest node) of every node of edges (a long, b long).

    Every round takes the smallest label around each node and then the label of that
    label, so long chains shorten by halves.  Rounds are written to the shared folder.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        near = cut_lineage(labels.join(around, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("next")), "near")
        up = near.select(F.col("node").alias("next"), F.col("next").alias("top"))
        jumped = cut_lineage(near.join(up, "next").select("node", F.col("top").alias("label"), (F.col("top") != F.col("label")).alias("changed")), "labels")
        if not jumped.where("changed").limit(1).count():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
