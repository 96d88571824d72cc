"""Connected components of a link table, on Spark.

Labels start at each node and fall to the least label among its neighbours; then every label
is replaced by the label of the node it names, which halves chains. Each round is a few
shuffles of narrow rows and is written to the shared folder; rounds grow with the logarithm
of the longest shortest path. A node with very many links costs one row per link and round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


class Forest(dict):
    """Union-find over the few nodes of one unit of work."""

    def root(self, x):
        while self.setdefault(x, x) != x:
            self[x] = self[self[x]]
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its least node) of every node with a link; nulls don't link."""
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = materialise(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near")))
        fallen = (labels.join(near, labels["node"] == near["a"])
                  .select("node", F.col("component").alias("was"), F.least("component", "near").alias("component")))
        target = labels.select(F.col("node").alias("t"), F.col("component").alias("beyond"))
        moved = materialise(
            fallen.join(target, fallen["component"] == target["t"])
            .select("node", "was", F.least("component", "beyond").alias("component")), "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> was").isEmpty():
            return labels
