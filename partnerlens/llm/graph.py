"""Connected components on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerlens.llm.common import drop_path, written


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) for the nodes of edges (columns a and b).

    Large-star and small-star steps: every node ties its larger, then its
    smaller neighbours to the smallest of them, until nothing changes; the
    number of steps grows with the logarithm of a path's length. Only minima
    are grouped, so a node of very many edges is no hot spot. Nodes without an
    edge to another node are not returned.
    """
    spark = edges.sparkSession
    now, path = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    state, before = _state(now), None
    while state[0] and state != before:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.union(least.select("a", F.col("least").alias("b"))).filter("a > b").distinct()
        large, large_path = written(large, "edges")
        drop_path(spark, path)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least)
        now, path = written(small.filter("a > b").distinct(), "edges")
        drop_path(spark, large_path)
        state, before = _state(now), state
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node")).distinct()
    return nodes.union(roots.select("node", F.col("node").alias("component")))


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum of them."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
