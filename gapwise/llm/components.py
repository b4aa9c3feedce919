"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """node, label: one label per component, for every node of `edges` (a, b).

    Contracts the graph round by round: each node takes the smallest name among
    itself and its neighbours, edges are renamed by it, and those within one name go.
    If names are random (hashes), a round leaves a fraction of the nodes, whatever
    the graph's shape. A node with many neighbours only ever takes part in a
    minimum, which is computed before the shuffle, and in joins that adaptive
    execution can split. Edges may repeat and may be loops; there may be none.
    """
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = labels.withColumn("label", F.col("node"))
    left = _between(edges)
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        to = staged(smallest.select(F.col("a").alias("label"), F.least("a", "m").alias("new")), "parents")
        labels = staged(labels.join(to, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")
        renamed = left
        for end in ("a", "b"):
            renamed = renamed.join(to.withColumnRenamed("label", end), end).drop(end).withColumnRenamed("new", end)
        left = _between(renamed)
    return labels


def _between(edges: DataFrame) -> DataFrame:
    """The edges between different nodes, once each and smaller end first."""
    ends = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return staged(ends.distinct(), "edges")
