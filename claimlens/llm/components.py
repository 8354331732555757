"""Connected components of a table of links, as joins (no collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimlens.llm.common import cut, few


def components(links: DataFrame, parts: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is
    the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so long chains shrink by powers; it ends when no label moves.
    ``parts``: tasks that the tables are worth at most.
    """
    edges = cut(links.select("a", "b").union(links.select("b", "a")).distinct(), parts)
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), parts)
    while True:
        heard = few(edges.join(labels.withColumnRenamed("node", "b"), "b"), parts).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        nearer = cut(labels.join(heard, "node").select("node", F.least("component", "heard").alias("component"), F.col("component").alias("was")), parts)
        further = nearer.select(F.col("node").alias("component"), F.col("component").alias("next"))
        nearer = cut(nearer.join(further, "component", "left").select(
            "node", F.least("component", F.coalesce("next", "component")).alias("component"), "was"), parts)
        moved = nearer.where("component <> was").limit(1).count()
        labels = nearer.select("node", "component")
        if not moved:
            return labels
