"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import written


def _state(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
    return row["n"], row["sum"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_least"))
    return (both.where(F.col("b") > F.col("a")).join(least, "a")
            .select(F.col("b").alias("a"), F.least("a", "_least").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each smaller neighbour of a node, and the node, to the smallest of them.
    ``edges`` lead from the larger node ``a`` to the smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("_least"))
    others = (edges.join(least, "a").where(F.col("b") != F.col("_least"))
              .select(F.col("b").alias("a"), F.col("_least").alias("b")))
    return others.union(least.select("a", F.col("_least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node: ``node, component``.

    ``links`` has two columns of numbers, in any order, repeats allowed. Both steps are a
    minimum per node, combined before the shuffle, and a join that Spark splits where a
    node has many links, so no component and no neighbourhood is ever in one task. The
    number of rounds grows with the logarithm of the nodes.
    """
    a, b = (F.col(c) for c in links.columns)
    edges = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col("a") != F.col("b")).distinct(), "links")
    state = _state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
