"""Stored pre-aggregates that are brought up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.deltas import fold, read_parts, write_delta

Aggregates = dict[str, tuple[str, Column | None]]

WHOLE = "decimal(38,0)"


def _moments(value: Column) -> Column:
    """Number, sum and sum of squares of whole numbers, from which mean and deviation follow.

    Sums of whole numbers are exact in any order and however often parts are merged, which a
    running mean and its squared deviations, as floating numbers, are not.
    """
    whole = value.cast("decimal(18,0)")
    return F.struct(F.count(value).alias("n"),
                    F.sum(whole).cast(WHOLE).alias("total"),
                    F.sum((whole * whole).cast(WHOLE)).cast(WHOLE).alias("squares"))


def _merged_moments(name: str) -> Column:
    return F.struct(*[F.sum(f"`{name}`.{part}").alias(part) for part in ("n", "total", "squares")])


# How rows become a partial result of each kind, and how partial results are merged.
FIRST = {
    "count": lambda c: F.count(F.lit(1) if c is None else c),
    "sum": F.sum, "min": F.min, "max": F.max, "moments": _moments,
}
MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max, "moments": _merged_moments}


def _partial(df: DataFrame, keys: list[str], aggs: Aggregates) -> DataFrame:
    return df.groupBy(*keys).agg(*[FIRST[kind](c).alias(n) for n, (kind, c) in aggs.items()])


def _merged(parts: DataFrame, keys: list[str], aggs: Aggregates) -> DataFrame:
    # Summing a decimal widens it; keep the stored type, or no later part would fit.
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    merged = [MERGE[kind](n).cast(kinds[n]).alias(n) for n, (kind, _) in aggs.items()]
    return parts.groupBy(*keys).agg(*merged)


def mean_of(moments: str, scale: int = 0) -> Column:
    """The mean of stored moments, of whole units of ``10**-scale``; null without values."""
    n, total = (F.col(f"{moments}.{part}").cast("double") for part in ("n", "total"))
    return F.when(n > 0, total / n / F.lit(float(10**scale)))


def deviation_of(moments: str, scale: int = 0) -> Column:
    """The sample standard deviation of stored moments; null for fewer than two values.

    Squared deviations come from the exact sums, as one difference of whole numbers, and from
    rounded ones only where that has over 38 digits.
    """
    n, total, squares = (F.col(f"{moments}.{part}").cast(WHOLE) for part in ("n", "total", "squares"))
    exact = F.try_subtract(F.try_multiply(n, squares), F.try_multiply(total, total)).cast("double")
    n, total, squares = (c.cast("double") for c in (n, total, squares))
    spread = F.greatest(F.coalesce(exact, n * squares - total * total), F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n * (n - 1))) / F.lit(float(10**scale)))


def rollup_refresh(
    df: DataFrame, target: str, keys: list[str], aggs: Aggregates, batch_id: int
) -> None:
    """Adds the rows of ``df`` to the rollup at ``target``.

    ``aggs`` maps a column name to a kind (count, sum, min, max, or moments of whole numbers)
    and an expression. Only the aggregated batch is written. The same ``batch_id``
    again replaces that batch, so a repeated run does not count twice.
    """
    write_delta(_partial(df, keys, aggs), target, batch_id)


def rollup_sink(target: str, keys: list[str], aggs: Aggregates):
    """`rollup_refresh` as a ``foreachBatch`` function for a stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rollup_refresh(batch, target, keys, aggs, batch_id)

    return write


def read_rollup(
    spark: SparkSession, target: str, keys: list[str], aggs: Aggregates
) -> DataFrame:
    return _merged(read_parts(spark, target), keys, aggs)


def compact_rollup(spark: SparkSession, target: str, keys: list[str], aggs: Aggregates) -> None:
    fold(spark, target, lambda parts: _merged(parts, keys, aggs))


# Levels of time, finest first. Each is made of the one before. Times are in seconds since 1970 in UTC.
PERIOD = "period_start"


def _day_of(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


LEVELS = {
    "hour": lambda s: F.floor(s / 3600) * 3600,
    "day": lambda s: F.floor(s / 86400) * 86400,
    "month": lambda s: F.unix_date(F.trunc(_day_of(s), "MM")).cast("long") * 86400,
}


def levels_refresh(
    df: DataFrame, target: str, ts: str, keys: list[str], aggs: Aggregates, batch_id: int,
) -> None:
    """Adds the rows of ``df`` to a rollup by hour, day and month, bottom-up.

    Only hours are aggregated from rows. A day's part of the batch is merged from the batch's
    hours as written, a month's from its days, so each level costs a fraction of the one below
    and nothing older is read. Repeating a batch replaces it at every level. Rows without a
    time are left out.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(ts).isNotNull())
    period = F.unix_seconds(F.col(ts).cast("timestamp"))
    below = None
    for level, start in LEVELS.items():
        source = rows if below is None else spark.read.parquet(f"{target}/{below}/delta/batch={batch_id}")
        own = source.withColumn(PERIOD, start(period if below is None else F.col(PERIOD)).cast("long"))
        grouped = (_partial if below is None else _merged)(own, [PERIOD, *keys], aggs)
        write_delta(grouped, f"{target}/{level}", batch_id)
        below = level


def levels_sink(target: str, ts: str, keys: list[str], aggs: Aggregates):
    """`levels_refresh` as a ``foreachBatch`` function for a stream."""

    def write(batch: DataFrame, batch_id: int) -> None:
        levels_refresh(batch, target, ts, keys, aggs, batch_id)

    return write


def read_level(
    spark: SparkSession, target: str, level: str, keys: list[str], aggs: Aggregates
) -> DataFrame:
    return read_rollup(spark, f"{target}/{level}", [PERIOD, *keys], aggs)


def compact_levels(spark: SparkSession, target: str, keys: list[str], aggs: Aggregates) -> None:
    for level in LEVELS:
        compact_rollup(spark, f"{target}/{level}", [PERIOD, *keys], aggs)
