"""Change records made from the orders table, decoded and applied."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from tidewell.functions.numbers import minor_units, money
from tidewell.operators import cdc, rollup
from tidewell.plans.tables import instant, table
from tidewell.session import new_dir
from tidewell.sources.files import in_order_of, spread
from tidewell.sources.topics import as_records
from tidewell.streaming.runner import run_to_end, scratch, start_query


def _replayed(spark: SparkSession, sf_dir: str, name: str, order: str) -> DataFrame:
    """A table as a stream of several micro-batches, in order of one of its columns."""
    return in_order_of(table(spark, sf_dir, name), order, new_dir(spark, f"{name}-in-order"))


ROW = StructType([
    StructField("id", LongType()),
    StructField("customer", LongType()),
    StructField("amount", DecimalType(18, 2)),
    StructField("status", StringType()),
])


def _envelope(op: str, amount: Column | None) -> Column:
    """One change as JSON text: urgent orders wrapped with a base64 amount, others bare."""
    key_only = F.struct(F.col("o_orderkey").alias("id"))

    def row(value: Column) -> Column:
        return F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer"),
            value.alias("amount"),
            F.col("o_orderstatus").alias("status"),
        )

    def change(value: Column | None) -> Column:
        if value is None:
            return F.struct(F.lit(op).alias("op"), key_only.alias("before"))
        return F.struct(F.lit(op).alias("op"), row(value).alias("after"))

    if amount is None:
        wrapped, bare = change(None), change(None)
    else:
        eight_bytes = F.unhex(F.lpad(F.hex(minor_units(amount)), 16, "0"))
        wrapped, bare = change(F.base64(eight_bytes)), change(amount)
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    wrapped_text = F.to_json(F.struct(wrapped.alias("payload")))
    return F.when(urgent, wrapped_text).otherwise(F.to_json(bare))


def change_records(orders: DataFrame) -> DataFrame:
    """Each order is created; status F is then updated by 10, status P deleted."""
    price = money(F.col("o_totalprice")).cast(DecimalType(18, 2))
    raised = (price + F.lit(10)).cast(DecimalType(18, 2))
    none = F.lit(None).cast("string")
    changes = F.array(
        _envelope("c", price),
        F.when(F.col("o_orderstatus") == "F", _envelope("u", raised)).otherwise(none),
        F.when(F.col("o_orderstatus") == "P", _envelope("d", None)).otherwise(none),
    )
    each = orders.select("o_orderkey", F.posexplode(changes).alias("_step", "_json"))
    return as_records(
        each.filter(F.col("_json").isNotNull()), "orders",
        F.col("o_orderkey"), F.col("_json"), F.col("o_orderkey") * 3 + F.col("_step"),
    )


def _decoded(orders: DataFrame) -> DataFrame:
    return cdc.cdc_decode(change_records(orders), ROW, {"amount": 2})


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    return spread(table(spark, sf_dir, "orders").select(*wanted))


def _amount_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn("amount", F.col("amount").cast("double"))


def cdc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(_orders(spark, sf_dir))
    return decoded.select(
        "offset", "op", "malformed",
        F.coalesce("after.id", "before.id").alias("id"),
        F.col("after.amount").cast("double").alias("amount"),
        F.col("after.status").alias("status"),
    )


def cdc_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the changes with a new row, which is what a detector reads."""
    decoded = _decoded(_orders(spark, sf_dir))
    return _amount_as_double(cdc.changed_rows(decoded, ("offset",)))


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = _decoded(_orders(spark, sf_dir))
    return _amount_as_double(cdc.cdc_apply(decoded, ["id"], ["offset"]))


def cdc_apply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mirror, kept by a stream and read after a compaction."""
    out, checkpoints = scratch(spark, "mirror")
    changes = _decoded(_replayed(spark, sf_dir, "orders", "o_orderkey"))
    sink = cdc.mirror_sink(out, ["id"], ["offset"])
    run_to_end(start_query(changes, "mirror", sink, checkpoints, "append"))
    cdc.compact_mirror(spark, out, ["id"])
    return _amount_as_double(cdc.read_mirror(spark, out, ["id"]))


def cdc_apply_stream_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mirror itself kept up to date: each micro-batch rewrites the buckets of its keys."""
    out, checkpoints = scratch(spark, "mirror-buckets")
    changes = _decoded(_replayed(spark, sf_dir, "orders", "o_orderkey"))
    sink = cdc.bucketed_mirror_sink(out, ["id"], ["offset"], buckets=16)
    run_to_end(start_query(changes, "mirror_buckets", sink, checkpoints, "append"))
    return _amount_as_double(cdc.read_bucketed_mirror(spark, out))


KEYS = ["event_type", "user_id"]


def _aggs() -> rollup.Aggregates:
    units = minor_units(F.col("value"))
    return {
        "n": ("count", None),
        "total": ("sum", units),
        "smallest": ("min", units),
        "largest": ("max", units),
    }


def rollup_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second of them twice, as after a failure; then a compaction."""
    events, target, aggs = table(spark, sf_dir, "events"), new_dir(spark, "rollup"), _aggs()
    middle = F.col("ts") < instant("2024-01-16 00:00:00")
    rollup.rollup_refresh(events.filter(middle), target, KEYS, aggs, 0)
    for _ in range(2):
        rollup.rollup_refresh(events.filter(~middle), target, KEYS, aggs, 1)
    rollup.compact_rollup(spark, target, KEYS, aggs)
    return rollup.read_rollup(spark, target, KEYS, aggs)


def rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoints = scratch(spark, "rollup")
    sink = rollup.rollup_sink(out, KEYS, _aggs())
    run_to_end(start_query(
        _replayed(spark, sf_dir, "events", "ts"), "rollup", sink, checkpoints))
    return rollup.read_rollup(spark, out, KEYS, _aggs())


def _level_rows(spark: SparkSession, target: str, aggs: rollup.Aggregates) -> DataFrame:
    def level(name: str) -> DataFrame:
        return rollup.read_level(spark, target, name, ["event_type"], aggs).select(
            F.lit(name).alias("level"), rollup.PERIOD, "event_type",
            F.col("amounts.n").alias("n"), rollup.mean_of("amounts", 2).alias("mean"),
            rollup.deviation_of("amounts", 2).alias("deviation"))

    return functools.reduce(DataFrame.unionByName, [level(name) for name in rollup.LEVELS])


def rollup_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and deviations by hour, day and month, in two batches of which the second is sent
    twice; then a compaction of every level."""
    events, target = table(spark, sf_dir, "events"), new_dir(spark, "levels")
    aggs = {"amounts": ("moments", minor_units(F.col("value")))}
    middle = F.col("ts") < instant("2024-01-16 12:30:00")
    for batch_id, rows in ((0, middle), (1, ~middle), (1, ~middle)):
        rollup.levels_refresh(events.filter(rows), target, "ts", ["event_type"], aggs, batch_id)
    rollup.compact_levels(spark, target, ["event_type"], aggs)
    return _level_rows(spark, target, aggs)


def rollup_levels_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoints = scratch(spark, "levels")
    aggs = {"amounts": ("moments", minor_units(F.col("value")))}
    sink = rollup.levels_sink(out, "ts", ["event_type"], aggs)
    run_to_end(start_query(
        _replayed(spark, sf_dir, "events", "ts"), "levels", sink, checkpoints))
    return _level_rows(spark, out, aggs)


QUERIES = {
    f.__name__: f
    for f in (
        cdc_decode, cdc_rows, cdc_apply, cdc_apply_stream, rollup_refresh, rollup_stream,
        cdc_apply_stream_bucketed, rollup_levels, rollup_levels_stream,
    )
}

_CHANGES = """
    SELECT o_orderkey * 3 AS "offset", 'c' AS op, false AS malformed, o_orderkey AS id,
           o_totalprice AS amount, o_orderstatus AS status, o_custkey AS customer FROM orders
    UNION ALL
    SELECT o_orderkey * 3 + 1, 'u', false, o_orderkey,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) + 10 AS DOUBLE), o_orderstatus, o_custkey
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey * 3 + 2, 'd', false, o_orderkey, NULL, NULL, NULL
    FROM orders WHERE o_orderstatus = 'P'"""

_MIRROR = """
    SELECT o_orderkey AS id, o_custkey AS customer, o_orderstatus AS status,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2))
                + CASE WHEN o_orderstatus = 'F' THEN 10 ELSE 0 END AS DOUBLE) AS amount
    FROM orders WHERE o_orderstatus <> 'P'"""

_ROLLUP = """
    SELECT event_type, user_id, count(*) AS n, CAST(sum(u) AS BIGINT) AS total,
           min(u) AS smallest, max(u) AS largest
    FROM (SELECT *, CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) AS u FROM events)
    GROUP BY event_type, user_id"""

_LEVELS = """
    SELECT level, period_start, event_type, count(*) AS n,
           CAST(sum(u) AS DOUBLE) / count(*) / 100 AS mean,
           CASE WHEN count(*) > 1 THEN
             sqrt(CAST(count(*) * sum(u * u) - sum(u) * sum(u) AS DOUBLE)
                  / (CAST(count(*) AS DOUBLE) * (count(*) - 1))) / 100 END AS deviation
    FROM (SELECT event_type, CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS HUGEINT) AS u, level,
                 CAST(epoch(date_trunc(level, ts)) AS BIGINT) AS period_start
          FROM events, (VALUES ('hour'), ('day'), ('month')) l(level))
    GROUP BY ALL"""

ORACLE = {
    "cdc_apply_stream_bucketed": _MIRROR,
    "rollup_levels": _LEVELS,
    "rollup_levels_stream": _LEVELS,
    "cdc_decode": f"""SELECT "offset", op, malformed, id, amount, status FROM ({_CHANGES})""",
    "cdc_rows": f"""
        SELECT "offset", id, customer, amount, status FROM ({_CHANGES}) WHERE op <> 'd'""",
    "cdc_apply": _MIRROR,
    "cdc_apply_stream": _MIRROR,
    "rollup_refresh": _ROLLUP,
    "rollup_stream": _ROLLUP,
}
