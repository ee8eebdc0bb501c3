"""Connected components by repeated contraction, in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import stage


def _through(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the parents of their ends, without loops."""
    u = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
    v = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
    return (
        edges.join(u, "a")
        .join(v, "b")
        .filter("pa != pb")
        .select(F.greatest("pa", "pb").alias("a"), F.least("pa", "pb").alias("b"))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of (a, b) edges; the root is the component's smallest node.

    Each round every node points to its smallest neighbour or itself, pointers are followed
    twice, and edges are redrawn between the nodes pointed to; each round's tables are stored
    in the shared folder. The rounds end when no edge is left, after about the logarithm of
    the longest chain."""
    edges = stage(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    found = None
    while found is None or not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        parents = stage(least.select("node", F.least("node", "parent").alias("parent")), "parents")
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("up"))
        parents = stage(parents.join(above, "parent").select("node", F.col("up").alias("parent")), "parents")
        edges = stage(_through(edges, parents), "edges")
        if found is None:
            found = parents.select("node", F.col("parent").alias("root"))
        else:
            step = parents.select(F.col("node").alias("root"), F.col("parent").alias("next"))
            found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return stage(found, "components")
