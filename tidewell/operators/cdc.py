"""Change records: decoding the envelope and mirroring the latest row per key."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewell.functions.numbers import any_decimal
from tidewell.functions.text import parsed_once
from tidewell.operators.buckets import BUCKETS, merge_batch, read_buckets
from tidewell.operators.deltas import fold, read_parts, write_delta

# How a time column may be encoded inside a change record.
TIME_ENCODINGS = ("text", "millis", "micros")


def _wire_schema(row: StructType, as_text: set[str]) -> StructType:
    fields = [
        StructField(f.name, StringType()) if f.name in as_text else f for f in row.fields
    ]
    change = [
        StructField("op", StringType()),
        StructField("before", StructType(fields)),
        StructField("after", StructType(fields)),
        StructField("ts_ms", LongType()),
    ]
    return StructType([*change, StructField("payload", StructType(change))])


def _time(text: Column, encoding: str) -> Column:
    if encoding == "text":
        return F.try_to_timestamp(text)
    number = text.try_cast("long")
    return F.timestamp_millis(number) if encoding == "millis" else F.timestamp_micros(number)


def cdc_decode(
    df: DataFrame,
    row_schema: StructType,
    decimals: dict[str, int] | None = None,
    decimal_encoding: str = "auto",
    times: dict[str, str] | None = None,
    value: str = "value",
) -> DataFrame:
    """Reads change records, bare or wrapped in ``payload``.

    Adds ``op``, ``before``, ``after``, ``ts_ms`` and ``malformed`` to the other
    columns of ``df``. ``decimals`` names the columns sent as decimals and their
    scale, ``times`` those sent as times and their encoding.
    """
    decimals, times = decimals or {}, times or {}
    if bad := set(times.values()) - set(TIME_ENCODINGS):
        raise ValueError(f"unknown time encoding {sorted(bad)}")
    schema = _wire_schema(row_schema, set(decimals) | set(times))
    wire = parsed_once(F.col(value).cast("string"), schema)

    def typed(row: Column) -> Column:
        columns = []
        for field in row_schema.fields:
            c = row[field.name]
            if field.name in decimals:
                scale = decimals[field.name]
                c = any_decimal(c, scale, decimal_encoding).try_cast(field.dataType)
            elif field.name in times:
                c = _time(c, times[field.name]).cast(field.dataType)
            columns.append(c.alias(field.name))
        return F.when(row.isNotNull(), F.struct(*columns))

    def either(name: str) -> Column:
        return F.coalesce(F.col("_wire")["payload"][name], F.col("_wire")[name])

    others = [c for c in df.columns if c != value]
    flat = df.select(*others, F.col(value).isNotNull().alias("_sent"), wire.alias("_wire")).select(
        *others,
        "_sent",
        either("op").alias("op"),
        either("before").alias("_before"),
        either("after").alias("_after"),
        either("ts_ms").alias("ts_ms"),
    )
    empty = F.col("op").isNull() & F.col("_after").isNull() & F.col("_before").isNull()
    return flat.select(
        *others,
        "op",
        typed(F.col("_before")).alias("before"),
        typed(F.col("_after")).alias("after"),
        "ts_ms",
        (F.col("_sent") & empty).alias("malformed"),
    )


def changed_rows(decoded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The new rows of the changes that have one; deletes have none."""
    return decoded.filter(F.col("after").isNotNull()).select(*keep, "after.*")


def latest_changes(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last change of each key: ``keys``, ``_order``, ``_op`` and ``_after``.

    A running maximum per key, so each task first reduces its own rows and a key
    with very many changes never meets in one place.
    """
    key_columns = [F.coalesce(F.col("after")[k], F.col("before")[k]).alias(k) for k in keys]
    rows = changes.select(
        *key_columns,
        F.struct(*[F.col(c) for c in order]).alias("_order"),
        F.col("op").alias("_op"),
        F.col("after").alias("_after"),
    )
    # A filter on the keys would be moved to the raw records and decode them
    # twice; records without a key, malformed ones among them, go afterwards.
    keyed = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return _latest(rows, keys, F.bool_or(keyed))


def _latest(rows: DataFrame, keys: list[str], wanted: Column | None = None) -> DataFrame:
    change = F.max_by(F.struct("_order", "_op", "_after"), "_order").alias("_c")
    keep = F.lit(True) if wanted is None else wanted
    merged = rows.groupBy(*keys).agg(change, keep.alias("_keep"))
    return merged.filter("_keep").select(*keys, "_c.*")


def _present(latest: DataFrame) -> DataFrame:
    gone = F.col("_op").eqNullSafe("d") | F.col("_after").isNull()
    return latest.filter(~gone).select("_after.*")


def cdc_apply(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The table after all ``changes``: the latest row per key, without the deleted.

    ``order`` must grow with each change of a key, as a topic's offset does when
    all records of a key are in one partition.
    """
    return _present(latest_changes(changes, keys, order))


def mirror_sink(target: str, keys: list[str], order: list[str]):
    """A ``foreachBatch`` function that adds each batch's latest changes to a mirror.

    A batch writes only its own changes, into a folder named by its id, so its
    cost does not grow with the mirror and a repeated batch replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_delta(latest_changes(batch, keys, order), target, batch_id)

    return write


def read_mirror(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The mirrored table: all parts merged by the latest change."""
    return _present(_latest(read_parts(spark, target), keys))


def compact_mirror(spark: SparkSession, target: str, keys: list[str]) -> None:
    """Folds all parts into one, so that reading stays cheap. Run it now and then."""
    fold(spark, target, lambda parts: _latest(parts, keys))


def bucketed_mirror_sink(target: str, keys: list[str], order: list[str], buckets: int = BUCKETS):
    """A ``foreachBatch`` function that keeps the mirror itself up to date, in buckets of keys.

    A batch rewrites the buckets of its keys and no others, so that reading costs no merging
    and nothing is ever folded as a whole. Deleted keys stay as marks, by which a change that
    arrives after its key's deletion is told from a new row.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = latest_changes(batch, keys, order)
        merge_batch(changes, target, keys, lambda rows: _latest(rows, keys), batch_id, buckets)

    return write


def read_bucketed_mirror(spark: SparkSession, target: str) -> DataFrame:
    """The mirrored table; each key has one row there already."""
    return _present(read_buckets(spark, target))
