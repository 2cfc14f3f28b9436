"""Database tables: full scans split over ranges, and incremental extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.deltas import complete


def jdbc_options(
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. With ``column`` the scan becomes ``partitions`` range queries."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(props or {})}
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a split scan needs lower and upper bounds of its column")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    elif partitions > 1:
        raise ValueError("more than one partition needs a column to split on")
    return options


def jdbc_bounds(
    spark: SparkSession, url: str, table: str, column: str, props: dict[str, str] | None = None
) -> tuple[int, int]:
    """Smallest and largest value of ``column``, computed by the database."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.format("jdbc").options(**jdbc_options(url, query, props)).load().first()
    return (0, 1) if row[0] is None else (int(row[0]), int(row[1]) + 1)


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A table over JDBC. Without given bounds a split scan asks the database for them."""
    if column is not None and (lower is None or upper is None):
        lower, upper = jdbc_bounds(spark, url, table, column, props)
    options = jdbc_options(url, table, props, column, lower, upper, partitions)
    return spark.read.format("jdbc").options(**options).load()


def extract_increment(source: DataFrame, target: str, id_col: str) -> int:
    """Appends the rows of ``source`` newer than the last extract; returns the new mark.

    Each extract is one folder named after the largest id in it, which also is
    the high-water mark for the next one. A folder only counts once Spark has
    marked it complete, so after a failure the same rows are extracted again.
    """
    spark = source.sparkSession
    mark = high_water_mark(spark, target)
    fresh = source if mark is None else source.filter(F.col(id_col) > mark)
    # The upper bound is fixed first, so rows that arrive meanwhile wait for the next run.
    top = fresh.agg(F.max(id_col)).first()[0]
    if top is None:
        return -1 if mark is None else mark
    folder = f"{target}/extracts/upto={int(top)}"
    fresh.filter(F.col(id_col) <= top).write.mode("overwrite").parquet(folder)
    return int(top)


def high_water_mark(spark: SparkSession, target: str) -> int | None:
    """The largest id extracted so far; unfinished extracts do not count."""
    return max(complete(spark, f"{target}/extracts"), default=None)


def read_extracts(spark: SparkSession, target: str) -> DataFrame:
    paths = [f"{target}/extracts/upto={m}" for m in complete(spark, f"{target}/extracts")]
    return spark.read.parquet(*paths)


def jdbc_incremental(
    spark: SparkSession,
    url: str,
    table: str,
    props: dict[str, str] | None,
    id_col: str,
    target: str,
    partitions: int = 1,
) -> int:
    """One periodic extract of a database table into Parquet; see `extract_increment`.

    The comparison with the mark is pushed into the database's query.
    """
    mark = high_water_mark(spark, target)
    lower, upper = jdbc_bounds(spark, url, table, id_col, props)
    if mark is not None:
        lower = max(lower, mark)
    source = jdbc_scan(spark, url, table, props, id_col, lower, max(upper, lower + 1), partitions)
    return extract_increment(source, target, id_col)
