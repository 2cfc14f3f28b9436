"""Records behind the watermark as a table, with what is on time handed on.

Spark drops late rows inside an aggregation and counts groups of them. Here a micro-batch is
split before any aggregation, by the watermark that the batches before it have left in a table.
The rule is Spark's: a row is late if the end of its window, or without windows its time, is
not after the watermark, which is the newest time so far less the delay. Here it holds from the
next batch on; in Spark a batch without rows, as it runs when rows stop, comes in between.

Layout under a target: ``rows/batch=<n>`` with a folder each for rows on time and late ones, and
``watermark/batch=<n>``, the mark after that batch, written last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.times import duration_micros, micros
from tidewell.operators.deltas import complete
from tidewell.session import remove_dir

LATE = "_late"


def _mark(spark: SparkSession, target: str, batch_id: int) -> int | None:
    """The watermark in microseconds that holds for a batch: that left by the one before."""
    done = [b for b in complete(spark, f"{target}/watermark") if b < batch_id]
    if not done:
        return None
    return spark.read.parquet(f"{target}/watermark/batch={done[-1]}").first()["mark"]


def _is_late(at: Column, mark: int | None, window: int | None) -> Column:
    """Also for rows without a time, which belong to no window."""
    if mark is None:
        return at.isNull()
    end = at if window is None else at - F.pmod(at, F.lit(window)) + window
    return at.isNull() | (end <= mark)


def split_sink(
    target: str,
    ts: str,
    delay: str,
    window: str | None = None,
    forward: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps late rows apart and hands the others on.

    ``forward`` gets the rows on time, as written, and the batch's id. A repeated batch is
    split by the same watermark and replaces its own rows.
    """
    width = None if window is None else duration_micros(window)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark(spark, target, batch_id)
        path = f"{target}/rows/batch={batch_id}"
        at = micros(F.col(ts).cast("timestamp"))
        batch.withColumn(LATE, _is_late(at, mark, width)).write.mode("overwrite").partitionBy(
            LATE).parquet(path)
        rows = spark.read.schema(_schema(batch)).parquet(path)
        if forward:
            forward(rows.filter(~F.col(LATE)).drop(LATE), batch_id)
        newest = rows.agg(F.max(at)).first()[0]
        seen = [m for m in (mark, None if newest is None else newest - duration_micros(delay))
                if m is not None]
        spark.createDataFrame([(max(seen, default=None),)], "mark long").coalesce(1).write.mode(
            "overwrite").parquet(f"{target}/watermark/batch={batch_id}")
        for old in complete(spark, f"{target}/watermark")[:-2]:
            remove_dir(spark, f"{target}/watermark/batch={old}")

    return write


def _schema(batch: DataFrame):
    return batch.withColumn(LATE, F.lit(False)).schema


def split_rows(spark: SparkSession, target: str, late: bool, schema=None) -> DataFrame:
    """The late rows so far, or those on time, with their ``batch``. Before the first batch
    there are none, which needs the rows' ``schema``."""
    done = complete(spark, f"{target}/rows")
    if not done:
        if schema is None:
            raise FileNotFoundError(f"no complete batch under {target}")
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
    paths = [f"{target}/rows/batch={b}" for b in done]
    rows = spark.read.option("basePath", f"{target}/rows").parquet(*paths)
    return rows.filter(F.col(LATE) == F.lit(late)).drop(LATE)


def late_counts(spark: SparkSession, target: str) -> DataFrame:
    """Per micro-batch its records and how many of them were late."""
    done = complete(spark, f"{target}/rows")
    rows = spark.read.option("basePath", f"{target}/rows").parquet(
        *[f"{target}/rows/batch={b}" for b in done])
    return rows.groupBy("batch").agg(
        F.count("*").alias("records"), F.count_if(F.col(LATE)).alias("late_records"))
