"""Connected components by contraction, as joins and aggregates on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that is not itself the smallest of its component.

    ``edges`` holds ``(a, b)`` with comparable values; direction, order, copies, loops and
    nulls do not matter.  Every edge points from the larger to the smaller end.  A round
    keeps for each node its smallest neighbour (its parent), links the parents of a node to
    each other, and lets children skip to the parent of their parent, so chains halve.  It
    ends when every edge ends in a root.

    A node with many children is the lower end of its edges, where it is only a join key;
    both sides of that join are written tables, so adaptive execution splits it.
    """
    edge = staged(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low"))
        .distinct(),
        "component_edges",
    )
    while True:
        parent = staged(edge.groupBy("node").agg(F.min("low").alias("parent")), "component_parents")
        above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = parent.join(above, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("low"), F.col("above").isNotNull().alias("moved")
        )
        siblings = (
            edge.join(parent, "node")
            .filter(F.col("low") != F.col("parent"))
            .select(F.col("low").alias("node"), F.col("parent").alias("low"), F.lit(True).alias("moved"))
        )
        edge = staged(
            jumped.unionByName(siblings).groupBy("node", "low").agg(F.max("moved").alias("moved")), "component_edges"
        )
        if edge.filter("moved").isEmpty():
            return parent.select("node", F.col("parent").alias("root"))
