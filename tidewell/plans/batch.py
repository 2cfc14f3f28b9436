"""Aggregations, top-k and pair counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.numbers import as_money, money
from tidewell.operators import aggregates as agg
from tidewell.operators import joins
from tidewell.plans.tables import as_double, instant, table

EVENTS_END = "2024-01-31 00:00:00"


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.row_count(table(spark, sf_dir, "lineitem"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.preview(table(spark, sf_dir, "customer"), 10, ("c_custkey",))


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ten rows without an order; which ones is Spark's choice, how many is not."""
    return agg.row_count(agg.preview(table(spark, sf_dir, "lineitem"), 10))


def avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    price = money(F.col("p_retailprice"))
    return as_double(agg.avg_by_key(part, "p_brand", price, name="avg_price"), "avg_price")


def nested_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written in SQL over a view, as the same query would be in a database.

    The means are decimals: a mean of doubles depends on the order of the rows, and
    one in the middle between two results would be rounded now up, now down.
    """
    table(spark, sf_dir, "customer").createOrReplaceTempView("tidewell_customer")
    return spark.sql("""
        SELECT c_nationkey, CAST(round(round(avg(avg_bal), 10), 4) AS double) AS avg_bal
        FROM (
            SELECT c_nationkey, c_mktsegment, avg(CAST(c_acctbal AS decimal(24, 12))) AS avg_bal
            FROM tidewell_customer
            GROUP BY c_nationkey, c_mktsegment
        )
        GROUP BY c_nationkey
        ORDER BY avg_bal DESC, c_nationkey
        LIMIT 10
    """)


def nested_avg_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the DataFrame API, without SQL text."""
    customer = table(spark, sf_dir, "customer")
    balance = money(F.col("c_acctbal"))
    means = agg.nested_avg(
        customer, "c_nationkey", "c_mktsegment", balance, limit=10, digits=2, name="avg_bal"
    )
    return as_double(means, "avg_bal")


def topk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.topk_rows(table(spark, sf_dir, "customer"), "c_acctbal", 10, ("c_custkey",))


def top1_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    ties = ("l_orderkey", "l_linenumber", "l_partkey")
    return agg.topk_rows(items, "l_extendedprice", 1, ties)


def top3_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agg.sum_by_lookup(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"),
        "l_partkey", "p_partkey", "p_type", F.col("l_quantity").cast("long"),
        "total_quantity", k=3,
    )


def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = agg.revenue_units("l_extendedprice", "l_quantity")
    out = agg.sum_by_lookup(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"),
        "l_partkey", "p_partkey", "p_type", revenue, "total_revenue",
    )
    return as_double(out.withColumn("total_revenue", as_money(F.col("total_revenue"))), "total_revenue")


def revenue_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by a column of the fact table itself."""
    items = table(spark, sf_dir, "lineitem")
    out = agg.revenue_by_key(items, "l_returnflag", "l_extendedprice", "l_quantity", "revenue")
    return as_double(out, "revenue")


def top_spenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = F.sum(money(F.col("o_totalprice")))
    out = agg.topk_groups(table(spark, sf_dir, "orders"), "o_custkey", spent, 20, "total_spent")
    return as_double(out, "total_spent")


def self_join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.self_join_count(table(spark, sf_dir, "customer"), "c_nationkey")


def join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of two different tables with the same key."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return joins.join_count(customer, supplier, "nation")


def pair_count_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.pair_count(table(spark, sf_dir, "customer"), "c_nationkey")


def avg_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return as_double(agg.avg_latest_n(events, "event_id", money(F.col("value"))), "avg_value")


def avg_recent_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    out = agg.avg_recent_minutes(
        events, "ts", money(F.col("value")), instant(EVENTS_END), minutes=1440
    )
    return as_double(out, "avg_value")


QUERIES = {
    f.__name__: f
    for f in (
        row_count, preview, preview_rows, avg_by_key, nested_avg, nested_avg_frame, topk_rows, top1_price,
        top3_quantity, revenue_by_category, revenue_by_key, top_spenders, self_join_count,
        join_count, pair_count_rewrite, avg_latest_n, avg_recent_minutes,
    )
}

ORACLE = {
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "preview": "SELECT * FROM customer ORDER BY c_custkey LIMIT 10",
    "preview_rows": "SELECT least(10, count(*)) AS row_count FROM lineitem",
    "avg_by_key": """
        SELECT p_brand,
               CAST((2 * sum(u) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_price
        FROM (SELECT *, CAST(CAST(p_retailprice AS DECIMAL(18, 2)) * 100 AS BIGINT) AS u
              FROM part)
        GROUP BY p_brand ORDER BY p_brand DESC LIMIT 10""",
    "nested_avg": """
        SELECT c_nationkey, round(avg(avg_bal), 4) AS avg_bal FROM (
            SELECT c_nationkey, c_mktsegment,
                   CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_bal
            FROM customer GROUP BY c_nationkey, c_mktsegment)
        GROUP BY c_nationkey ORDER BY avg_bal DESC, c_nationkey LIMIT 10""",
    "nested_avg_frame": """
        SELECT c_nationkey, round(avg(avg_bal), 2) AS avg_bal FROM (
            SELECT c_nationkey, c_mktsegment,
                   CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_bal
            FROM customer GROUP BY c_nationkey, c_mktsegment)
        GROUP BY c_nationkey ORDER BY avg_bal DESC, c_nationkey LIMIT 10""",
    "topk_rows": "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10",
    "top1_price": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 1""",
    "top3_quantity": """
        SELECT p_type, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_type ORDER BY total_quantity DESC, p_type LIMIT 3""",
    "revenue_by_category": """
        SELECT p_type,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_quantity AS INTEGER))
                    AS DOUBLE) AS total_revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_type ORDER BY total_revenue DESC, p_type""",
    "revenue_by_key": """
        SELECT l_returnflag,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * CAST(l_quantity AS INTEGER))
                    AS DOUBLE) AS revenue
        FROM lineitem GROUP BY l_returnflag ORDER BY revenue DESC, l_returnflag""",
    "top_spenders": """
        SELECT o_custkey,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_spent
        FROM orders GROUP BY o_custkey ORDER BY total_spent DESC, o_custkey LIMIT 20""",
    "self_join_count": """
        SELECT CAST(count(*) AS DECIMAL(38, 0)) AS pairs
        FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey""",
    "join_count": """
        SELECT CAST(count(*) AS DECIMAL(38, 0)) AS pairs
        FROM customer JOIN supplier ON c_nationkey = s_nationkey""",
    "pair_count_rewrite": """
        SELECT CAST(sum(n * n) AS DECIMAL(38, 0)) AS pairs
        FROM (SELECT count(*) AS n FROM customer
              WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey)""",
    "avg_latest_n": """
        SELECT CAST((2 * sum(u) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_value
        FROM (SELECT CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) AS u
              FROM events ORDER BY event_id DESC LIMIT 10)""",
    "avg_recent_minutes": """
        SELECT CAST((2 * sum(u) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_value,
               count(*) AS n
        FROM (SELECT *, CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) AS u FROM events)
        WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00'""",
}
