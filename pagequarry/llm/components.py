"""Connected components of an edge list, on the executors, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagequarry.llm._common import written


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of every node of edges (a, b); keys of any ordered type.

    In each round a node takes the least label among its neighbours' and its own, then the label of
    its label. Rounds go on until nothing changes: about the logarithm of the longest chain.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("root")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("best"))
        near = labels.join(seen.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "best").alias("root"))
        jump = near.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = written(near.join(jump, "root", "left").select("node", "old", F.least("root", F.coalesce("next", "root")).alias("root")), "labels")
        labels = new.select("node", "root")
        if new.where("root <> old").isEmpty():
            return labels
