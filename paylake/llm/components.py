"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of an edge (a, b): the smallest id reachable.

    Each round sends every node to its smallest neighbour (if smaller than itself), follows
    that pointer on four steps, and replaces the edges by those between the nodes reached:
    stars collapse at once, chains shrink by the steps, and settled parts leave the graph.
    Neighbours are combined before the shuffle, so a node with many edges is one row per task.
    Every round is written to the shared folder, which cuts the lineage; the driver only
    sees whether edges are left.
    """
    def plain(a: str, b: str):
        return lambda df: df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()

    edges = materialize(edges.transform(plain("a", "b")), "cc-edges")
    labels = edges.select(F.col("a").alias("id"), F.col("a").alias("component")).limit(0)
    first = True
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("id"), F.col("b").alias("near")).unionByName(
            edges.select(F.col("b").alias("id"), F.col("a").alias("near")))
        step = materialize(ends.groupBy("id").agg(F.least("id", F.min("near")).alias("to")), "cc-step")
        for _ in range(2):
            on = step.select(F.col("id").alias("to"), F.col("to").alias("further"))
            step = materialize(step.join(on, "to").select("id", F.col("further").alias("to")), "cc-step")
        if first:
            labels = step.select("id", F.col("to").alias("component"))
            first = False
        else:
            on = step.select(F.col("id").alias("component"), "to")
            labels = materialize(labels.join(on, "component", "left").select("id", F.coalesce("to", "component").alias("component")),
                                 "cc-labels")
        edges = edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a").join(
            step.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
        edges = materialize(edges.transform(plain("ta", "tb")), "cc-edges")
    return labels
