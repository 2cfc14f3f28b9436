"""Keyed record streams: Kafka topics, and files with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.files import parquet_stream
from tidewell.sources.schemas import TOPIC_RECORD


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``starting`` only matters for a query without a checkpoint."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """A topic as a stream with the columns of `TOPIC_RECORD`.

    Needs Spark's Kafka connector on the class path. Progress is kept in the
    query's checkpoint, so queries on one topic never share it out.
    """
    options = kafka_options(
        servers, topic, starting, fail_on_data_loss, max_offsets, min_partitions
    )
    return spark.readStream.format("kafka").options(**options).load()


def record_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet files holding `TOPIC_RECORD` rows, as a stream: a replayed topic."""
    return parquet_stream(spark, path, max_files=max_files, schema=TOPIC_RECORD)


def as_records(df: DataFrame, topic: str, key: Column, value: Column, offset: Column) -> DataFrame:
    """Rows in the shape a topic delivers them.

    Written to Kafka, all records with one key reach one partition in order.
    """
    return df.select(
        key.cast("string").cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
