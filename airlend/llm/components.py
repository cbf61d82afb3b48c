"""Connected components of an undirected graph, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlend.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for all nodes of edges (a, b).

    Every round gives each node the least label among its own and its neighbours', then that label's own label,
    and writes the labels to the shared folder; it ends when no label changes. Sums of minima are taken before
    rows are shuffled, so a node with very many neighbours does no harm.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        heard = heard.groupBy("a").agg(F.min("label").alias("heard"))
        least = labels.join(heard.withColumnRenamed("a", "node"), "node")
        least = least.select("node", "label", F.least("label", "heard").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        new = least.join(jump, "next").select("node", "label", F.least("next", "further").alias("new"))
        new = stage(new, "labels")
        if new.where(F.col("new") != F.col("label")).isEmpty():
            return labels
        labels = new.select("node", F.col("new").alias("label"))
