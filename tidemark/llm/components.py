"""Connected components of edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import materialize


def _contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges that hang together as before: each node keeps one to its smallest neighbour, and its other smaller neighbours get one to that neighbour. Edges with a null end are none."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    low = down.withColumn("low", F.min("b").over(Window.partitionBy("a")))
    return low.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """edges: a, b (long). Gives node, root: the smallest node of its component, for every node of an edge.

    Labels go to the smallest label next to them and then to their label's label, until none changes; each round is a
    written table, and the number of rounds grows with the logarithm of the longest path. Edges are contracted twice before
    that, so that the rounds carry about one edge a node, however many edges a node came with.
    """
    few = materialize(_contracted(_contracted(edges)), "edges")
    both = few.union(few.select("b", "a"))
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = materialize(step.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("root")), "labels")
        done = new.where(F.col("old") != F.col("root")).isEmpty()
        labels = new.select("node", "root")
        if done:
            return labels
