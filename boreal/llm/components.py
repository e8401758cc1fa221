"""Connected components of a table of links, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.llm.storage import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node reachable from it.

    Every round gives a node the smallest label among its neighbours, then follows labels one step
    (pointer jumping), until nothing changes; rounds grow with the logarithm of the longest chain for
    ordinary graphs. Minima are combined before the shuffle, so a node with many links is no hot group.
    Each round's labels are written to the shared folder. Null ends and loops link nothing.
    """
    # both directions from one evaluation: a link table may come out differently when computed again
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    edges = written(links.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
                    .select(both.alias("link")).select("link.*").distinct(), "links")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                     .select("node", F.least("node", "low").alias("component")), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        step = written(lower.join(jump, "component").select(
            "node", "old", F.least("component", "far").alias("component")), "labels")
        labels = step.select("node", "component")
        if step.filter("old != component").isEmpty():
            return labels
