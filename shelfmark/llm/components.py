"""Connected components of a graph given as a table of edges, by the smallest node of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import delete, written


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b) longs.  node, component for every node of an edge.

    Every round takes the smallest label among the neighbours and then the label of the label, so long chains halve; each round is a written
    table, and only a count of changed rows comes to the driver.  Sums and minima combine before the shuffle, so a hub is no burden.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "component-edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component")), "component-labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least"))
        down = labels.join(near, F.col("node") == F.col("a")).select("node", F.least("component", "least").alias("to"), F.col("component").alias("before"))
        up = labels.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
        step = down.join(up, F.col("to") == F.col("n2")).select("node", F.least("to", "c2").alias("component"), "before")
        new = written(step, "component-labels")
        changed = new.filter("component <> before").limit(1).count()
        delete(labels)
        labels = new.select("node", "component")
        if not changed:
            delete(both)
            return labels
