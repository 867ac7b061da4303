"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _print(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them that tells edge sets apart."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(both: DataFrame, keep: str) -> DataFrame:
    """Each neighbour b of a that `keep` names is tied to the smallest of a and its neighbours."""
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where(keep).select(F.col("b").alias("a"), F.col("m").alias("b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long to (id, component): component is the smallest id that edges lead to; one row for each id with an edge to another.

    Alternates large-star and small-star steps until the edges stay the same; each step is written to the shared folder. The
    driver sees a count and a checksum only. Repeated edges, loops and edges in either direction are fine; nulls take no part.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _print(now)
    while seen[0]:
        large = staged(_star(_both_ways(now), "b > a").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select("b", "m").where("b <> m").toDF("a", "b")
        now = staged(small.union(least.toDF("a", "b")).distinct(), "small")
        print_now = _print(now)
        if print_now == seen:
            break
        seen = print_now
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return staged(now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots), "components")
