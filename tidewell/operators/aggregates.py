"""Counts, averages, revenue and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.numbers import addable, as_money, minor_units
from tidewell.session import estimated_bytes


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def preview(df: DataFrame, n: int = 10, order_by: tuple[str, ...] = ()) -> DataFrame:
    """Some ``n`` rows; the first ones of ``order_by`` where it is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def avg_by_key(
    df: DataFrame,
    key: str,
    value: str | Column,
    digits: int | None = 2,
    limit: int | None = 10,
    name: str = "avg_value",
) -> DataFrame:
    """Mean of ``value`` per key, largest keys first."""
    value = F.col(value) if isinstance(value, str) else value
    mean = F.avg(value)
    if digits is not None:
        mean = F.round(mean, digits)
    out = df.groupBy(key).agg(mean.alias(name)).orderBy(F.desc(key))
    return out if limit is None else out.limit(limit)


def nested_avg(
    df: DataFrame,
    outer: str,
    inner: str,
    value: str | Column,
    limit: int | None = 10,
    digits: int | None = None,
    name: str = "avg_value",
) -> DataFrame:
    """Per ``outer``, the mean of the means of its ``inner`` groups, highest first."""
    value = F.col(value) if isinstance(value, str) else value
    means = df.groupBy(outer, inner).agg(F.avg(value).alias("_mean"))
    mean = F.avg("_mean") if digits is None else F.round(F.avg("_mean"), digits)
    out = means.groupBy(outer).agg(mean.alias(name)).orderBy(F.desc(name), outer)
    return out if limit is None else out.limit(limit)


def topk_rows(
    df: DataFrame, order_col: str, k: int = 10, tie_cols: tuple[str, ...] = ()
) -> DataFrame:
    """The ``k`` rows with the largest ``order_col``; ``tie_cols`` decide between equals."""
    return df.orderBy(F.desc(order_col), *tie_cols).limit(k)


def topk_groups(df: DataFrame, key: str, agg_col: Column, k: int | None, name: str) -> DataFrame:
    """The ``k`` groups with the largest aggregate; all of them, sorted, without ``k``."""
    out = df.groupBy(key).agg(agg_col.alias(name)).orderBy(F.desc(name), key)
    return out if k is None else out.limit(k)


def revenue_by_key(
    df: DataFrame, key: str, price: str, qty: str, name: str, k: int | None = None
) -> DataFrame:
    """Exact sum of ``price * qty`` per key, largest first."""
    return topk_groups(df, key, as_money(F.sum(revenue_units(price, qty))), k, name)


def revenue_units(price: str, qty: str) -> Column:
    """``price * qty`` in whole cents; multiplying longs is cheaper than decimals."""
    return addable(minor_units(F.col(price)) * F.col(qty).cast("long"))


def sum_by_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    lookup_on: str,
    key: str,
    amount: Column,
    name: str,
    k: int | None = None,
) -> DataFrame:
    """Sum of ``amount`` per ``key``, an attribute found in ``lookup``; largest first.

    A lookup table below Spark's broadcast limit is joined as it is, and the facts
    are not moved. Otherwise the facts are summed per join key first. A join key
    with a large share of all facts is then one row per task when it is shuffled,
    and the join sees each key once.
    """
    names = lookup.select(lookup_on, key)
    match = F.col(on) == F.col(lookup_on)
    per_on = facts.groupBy(on).agg(F.sum(amount).alias("_part"))
    # A sum of sums is the wider type, and both ways give that one.
    kind = per_on.agg(F.sum("_part").alias("_total")).schema["_total"].dataType
    if _spark_broadcasts(names):
        total = F.sum(amount).cast(kind)
        return topk_groups(facts.join(names, match), key, total, k, name)
    return topk_groups(per_on.join(names, match), key, F.sum("_part"), k, name)


def _spark_broadcasts(df: DataFrame) -> bool:
    """Whether Spark will broadcast ``df`` by itself, going by its size estimate."""
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    size = estimated_bytes(df)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return size is not None and size <= as_bytes(limit)


def avg_latest_n(
    df: DataFrame,
    id_col: str,
    value: str | Column,
    n: int = 10,
    digits: int | None = 2,
    name: str = "avg_value",
) -> DataFrame:
    """Mean of ``value`` over the ``n`` rows with the largest ids."""
    value = F.col(value) if isinstance(value, str) else value
    latest = df.select(id_col, value.alias("_value")).orderBy(F.desc(id_col)).limit(n)
    mean = F.avg("_value") if digits is None else F.round(F.avg("_value"), digits)
    return latest.agg(mean.alias(name))


def avg_recent_minutes(
    df: DataFrame,
    ts: str,
    value: str | Column,
    as_of: Column | None = None,
    minutes: int = 10,
    digits: int | None = 2,
    name: str = "avg_value",
) -> DataFrame:
    """Mean of ``value`` over the last ``minutes`` up to ``as_of`` (now by default)."""
    value = F.col(value) if isinstance(value, str) else value
    as_of = F.current_timestamp() if as_of is None else as_of
    since = as_of - F.make_dt_interval(mins=F.lit(minutes))
    recent = df.filter((F.col(ts) >= since) & (F.col(ts) <= as_of))
    mean = F.avg(value) if digits is None else F.round(F.avg(value), digits)
    return recent.agg(mean.alias(name), F.count("*").alias("n"))
