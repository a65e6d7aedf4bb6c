"""Connected components of an edge table, kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govpub.llm.base import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, for all nodes of the edges (columns a and b).

    Smallest labels pass along the edges, then every node takes the label of its label, so long chains
    halve each time. Every round ends in a written table; only the number of changed rows reaches the driver. Minima are
    partially aggregated, joins on a popular node or label are split by AQE.
    """
    both = staged(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = staged(labels.join(near, "node").select(
            "node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "labels")
        if step.where("moved").isEmpty():
            return labels
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = staged(step.select("node", "label").join(up, "label").select("node", F.col("up").alias("label")), "labels")
