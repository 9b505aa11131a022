"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (a, b); the root is the smallest node of the component.

    Large-star and small-star steps in turn: every node's larger neighbours, then its smaller ones, move to its smallest
    neighbour. Each step is a partial minimum per node and a join back. The minimum of a node of any degree is spread over
    tasks; the join back brings the edges of a node, two numbers each, together. Every round is written to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    current = keep(edges.where("a <> b").select("a", "b").distinct())
    print_ = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = None
    while True:
        now = tuple(current.agg(*print_).first())
        if now == before or not now[0]:
            break
        before = now
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["node"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = keep(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
        small = large.join(least, large["a"] == least["node"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = keep(small.union(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct())
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct()
