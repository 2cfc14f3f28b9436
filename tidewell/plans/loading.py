"""Loading tables: files, ids and incremental extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.tables import table
from tidewell.session import new_dir
from tidewell.sources.files import csv_scan, save_table
from tidewell.sources.ids import assign_ids
from tidewell.sources.jdbc import extract_increment, read_extracts


def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers written as CSV files and loaded again with their types."""
    customer = table(spark, sf_dir, "customer")
    path = new_dir(spark, "csv")
    customer.write.option("header", True).csv(path)
    return csv_scan(spark, path, customer.schema)


def save_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders replaced as a Parquet table with one folder per status."""
    orders = table(spark, sf_dir, "orders")
    path = new_dir(spark, "orders")
    save_table(orders, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select(*orders.columns)


def ids_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_ids(table(spark, sf_dir, "customer"), "id", order_by=("c_custkey",))


def ids_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique but not dense ids; the check is how many there are. The numbered rows are
    written whole, as a load would."""
    path = new_dir(spark, "numbered")
    save_table(assign_ids(table(spark, sf_dir, "lineitem"), "id", dense=False), path)
    numbered = spark.read.parquet(path)
    return numbered.agg(F.count("id").alias("n"), F.countDistinct("id").alias("n_distinct"))


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extracts of the orders: at a time with half of the keys, and now."""
    orders = table(spark, sf_dir, "orders")
    half = (orders.agg(F.max("o_orderkey")).first()[0] or 0) // 2
    target = new_dir(spark, "extract")
    extract_increment(orders.filter(F.col("o_orderkey") <= half), target, "o_orderkey")
    extract_increment(orders, target, "o_orderkey")
    return read_extracts(spark, target)


QUERIES = {
    "csv_scan": csv_load,
    "save_table": save_and_read,
    "assign_ids": ids_dense,
    "assign_ids_unique": ids_unique,
    "incremental_extract": incremental_extract,
}

_ORDERS = "SELECT * FROM orders"

ORACLE = {
    "csv_scan": "SELECT * FROM customer",
    "save_table": _ORDERS,
    "assign_ids": """
        SELECT row_number() OVER (ORDER BY c_custkey) AS id, * FROM customer""",
    "assign_ids_unique": "SELECT count(*) AS n, count(*) AS n_distinct FROM lineitem",
    "incremental_extract": _ORDERS,
}
