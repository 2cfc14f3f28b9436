"""The tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.files import parquet_scan, parquet_stream


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_scan(spark, f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str, max_bytes: int | None = None) -> DataFrame:
    return parquet_stream(spark, f"{sf_dir}/{name}.parquet", max_bytes=max_bytes)


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def instant(text: str) -> Column:
    """A UTC time, whatever the session's zone."""
    return F.lit(f"{text}+00:00").cast("timestamp")
