"""Connected components by alternating large and small stars.

Each step joins every edge with the least neighbour of one of its ends. Edges and least
neighbours are stored tables, so a vertex with very many edges is split among tasks, and
nothing of a component meets in one task. The number of steps grows with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the least of vertex and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large-star")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "small-star")
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of the edges (a, b); the root is the component's least vertex."""
    now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        total = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003), F.countDistinct("b")).first()
        if tuple(total) == before:
            break
        before = tuple(total)
        now = stored(_small(stored(_large(now), "edges")), "edges")
    return stored(now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct(), "roots")
