"""Counting the pairs of an equi-join without producing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

WIDE = DecimalType(38, 0)


def join_count(left: DataFrame, right: DataFrame, on: str, name: str = "pairs") -> DataFrame:
    """Number of rows of ``left JOIN right USING (on)``.

    Both sides are counted per key and the counts are joined, so a key with a
    third of all rows contributes one row to the join instead of its pairs.
    Null keys match nothing, as in SQL.
    """
    a = left.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_a"))
    b = right.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_b"))
    pairs = F.sum(F.col("_a").cast(DecimalType(19, 0)) * F.col("_b").cast(DecimalType(19, 0)))
    return a.join(b, on).agg(F.coalesce(pairs.cast(WIDE), F.lit(0).cast(WIDE)).alias(name))


def self_join_count(df: DataFrame, key: str, name: str = "pairs") -> DataFrame:
    """Number of rows of a table joined with itself on ``key``."""
    return join_count(df, df, key, name)


def pair_count(df: DataFrame, key: str, name: str = "pairs") -> DataFrame:
    """The same number without any join: the sum of squared group sizes."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    n = F.col("_n").cast(DecimalType(19, 0))
    return sizes.agg(F.coalesce(F.sum(n * n).cast(WIDE), F.lit(0).cast(WIDE)).alias(name))
