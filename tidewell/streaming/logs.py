"""JSON log records: parsing, running counts, windowed alerts and ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.functions.text import contains, parsed_once
from tidewell.functions.times import event_time
from tidewell.sources.schemas import LOGS
from tidewell.streaming.runner import start_query
from tidewell.streaming.segments import SEGMENT_AGE, SEGMENT_BYTES, segment_sink

CORRUPT = "_corrupt"


def parse_logs(
    df: DataFrame, schema: StructType = LOGS, value: str = "value", keep_corrupt: bool = False
) -> DataFrame:
    """The fields of each JSON record as columns.

    Text that is not a record gives a row of nulls, which no filter on its
    fields lets through. ``keep_corrupt`` adds that text as a column.
    """
    options = {}
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        options = {"columnNameOfCorruptRecord": CORRUPT}
    record = parsed_once(F.col(value).cast("string"), schema, options)
    return df.select(record.alias("record")).select("record.*")


def log_counts(
    logs: DataFrame,
    term: str = "vulnerability",
    severity: str = "High",
    key: str = "source_ip",
    name: str = "match_count",
    ordered: bool = True,
) -> DataFrame:
    """Matching records per key, most first; on a stream that needs complete mode.

    Spark samples what it sorts, which runs the counting of a micro-batch twice.
    A stream into a table should leave the sorting to its readers.
    """
    wanted = (F.col("severity") == severity) & contains(F.col("content"), term, ignore_case=True)
    counts = logs.filter(wanted).groupBy(key).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), key) if ordered else counts


def crash_monitor(
    logs: DataFrame,
    term: str = "crash",
    severities: tuple[str, ...] = ("High", "Critical"),
    key: str = "user_id",
    window: str = "10 seconds",
    watermark: str = "10 seconds",
    min_count: int = 2,
    name: str = "crash_count",
) -> DataFrame:
    """Keys with more than ``min_count`` matching records in one event-time window.

    In append mode a window is reported once, when the watermark has passed it.
    In update mode it is reported whenever its count has changed.
    """
    wanted = F.col("severity").isin(*severities) & contains(F.col("content"), term, True)
    counts = (
        logs.filter(wanted)
        .select(event_time(F.col("timestamp")).alias("event_time"), key)
        .withWatermark("event_time", watermark)
        .groupBy(F.window("event_time", window), key)
        .agg(F.count("*").alias(name))
    )
    return counts.filter(F.col(name) > min_count).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        key,
        name,
    )


def window_avg(
    df: DataFrame,
    ts: str,
    value: Column,
    keys: list[str],
    window: str = "10 minutes",
    watermark: str | None = None,
    digits: int | None = 2,
    name: str = "avg_value",
) -> DataFrame:
    """Mean of ``value`` per key and tumbling event-time window."""
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    mean = F.avg(value) if digits is None else F.round(F.avg(value), digits)
    means = df.groupBy(F.window(ts, window), *keys).agg(mean.alias(name))
    return means.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        name,
    )


def ingest_logs(
    records: DataFrame,
    target: str,
    checkpoint_root: str,
    trigger: str | None = None,
    max_records_per_file: int = 1_000_000,
    name: str = "ingest_logs",
    lower_content: bool = False,
) -> StreamingQuery:
    """Appends the records of a topic to a Parquet table with one folder per day.

    Records without a readable time are left out and counted in the query's
    progress as ``ingest.rejected``; `quarantine_logs` keeps them. ``lower_content`` also stores the text in
    lower case, on which a search in any case can be pushed to the reader.
    """
    rows = _accepted(records, lower_content).withColumn(
        "event_date", F.to_date(event_time(F.col("timestamp"))))
    return start_query(
        rows, name, "parquet", checkpoint_root, "append", trigger, path=target,
        partition_by=["event_date"],
        options={"maxRecordsPerFile": str(max_records_per_file)},
    )


def _accepted(records: DataFrame, lower_content: bool) -> DataFrame:
    parsed = parse_logs(records, keep_corrupt=True).observe(
        "ingest",
        F.count("*").alias("records"),
        F.count_if(F.col("timestamp").isNull()).alias("rejected"),
    )
    rows = parsed.filter(F.col("timestamp").isNotNull()).drop(CORRUPT)
    return rows.withColumn("content_lower", F.lower("content")) if lower_content else rows


def ingest_segments(
    records: DataFrame,
    target: str,
    checkpoint_root: str,
    trigger: str | None = None,
    name: str = "ingest_segments",
    lower_content: bool = False,
    segment_bytes: int = SEGMENT_BYTES,
    segment_age: str = SEGMENT_AGE,
) -> StreamingQuery:
    """`ingest_logs` into segments by ``event_time`` that roll by size and age.

    The table's files so have the size asked for, however small or large micro-batches are,
    and a search in a range of time opens those only whose times it can match.
    """
    rows = _accepted(records, lower_content).withColumn("event_time", event_time(F.col("timestamp")))
    sink = segment_sink(target, "event_time", segment_bytes, segment_age)
    return start_query(rows, name, sink, checkpoint_root, "append", trigger)


def quarantine_logs(
    records: DataFrame,
    target: str,
    checkpoint_root: str,
    trigger: str | None = None,
    name: str = "quarantine_logs",
) -> StreamingQuery:
    """Appends the records that `ingest_logs` leaves out to a table, as they came.

    A query of its own on the same topic, so that neither table waits for the other.
    """
    record = parsed_once(F.col("value").cast("string"), LOGS)
    refused = (
        records.select("*", record.alias("_record"))
        .filter(F.col("_record.timestamp").isNull())
        .drop("_record")
    )
    return start_query(refused, name, "parquet", checkpoint_root, "append", trigger, path=target)
