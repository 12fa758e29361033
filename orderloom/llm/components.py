"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import materialise


def components(links: DataFrame, one: str = "a", other: str = "b") -> DataFrame:
    """``id, component``: for every linked node the smallest node it can reach.

    In each round a node points to the smallest node beside it and the pointers are followed twice
    over; links are then drawn between what the pointers lead to, until none is left. Each round
    goes to shared storage. Links are partially aggregated and joined on nodes, so that adaptive
    execution can split a node with very many. Nulls and links of a node to itself are passed over;
    repeated links count once.
    """
    a, b = F.col(one).alias("a"), F.col(other).alias("b")
    ends = links.select(a, b).where("a is not null and b is not null and a != b")
    edges = materialise(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    labels = None
    while labels is None or not edges.isEmpty():
        nearest = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("to"))
        for _ in range(2):
            next_one = nearest.select(F.col("id").alias("to"), F.col("to").alias("further"))
            nearest = nearest.join(next_one, "to", "left").select("id", F.coalesce("further", "to").alias("to"))
        nearest = materialise(nearest, "pointers")
        if labels is None:
            nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
            labels = nodes.join(nearest, "id", "left").select("id", F.coalesce("to", "id").alias("component"))
        else:
            moved = nearest.select(F.col("id").alias("component"), "to")
            labels = labels.join(moved, "component", "left")
            labels = labels.select("id", F.coalesce("to", "component").alias("component"))
        labels = materialise(labels, "labels")
        for end in ("a", "b"):
            moved = nearest.select(F.col("id").alias(end), "to")
            edges = edges.join(moved, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        edges = materialise(edges.distinct(), "links")
    return labels
