from decimal import Decimal

from conftest import SMALL, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators import aggregates as agg
from tidewell.operators.joins import join_count, pair_count, self_join_count
from tidewell.plans.tables import table

PEOPLE = [
    ("Ann", "Sales", 100, "PT"), ("Bob", "Sales", 200, "PT"), ("Cid", "IT", 300, "PT"),
    ("Dee", "IT", 500, "ES"), ("Eve", "IT", 400, "ES"), ("Flo", "HR", 200, None),
]


def people(spark):
    return spark.createDataFrame(PEOPLE, "name string, department string, salary int, country string")


def test_counts_and_preview(spark):
    df = people(spark)
    assert rows(agg.row_count(df)) == [(6,)]
    assert agg.preview(df, 4).count() == 4
    assert [r.name for r in agg.preview(df, 2, ("name",)).collect()] == ["Ann", "Bob"]


def test_avg_by_key_descending(spark):
    got = agg.avg_by_key(people(spark), "department", "salary", limit=2).collect()
    assert [tuple(r) for r in got] == [("Sales", 150.0), ("IT", 400.0)]


def test_nested_avg_is_mean_of_means(spark):
    got = agg.nested_avg(people(spark), "country", "department", "salary").collect()
    # PT: Sales 150, IT 300 -> 225, although the mean of its rows is 200.
    assert [tuple(r) for r in got] == [("ES", 450.0), ("PT", 225.0), (None, 200.0)]


def test_topk_is_not_a_full_sort(spark):
    top = agg.topk_rows(people(spark), "salary", 2, ("name",))
    assert [r.name for r in top.collect()] == ["Dee", "Eve"]
    assert "TakeOrderedAndProject" in plan(top)


def test_topk_breaks_ties(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 5)], "id int, v int")
    assert [r.id for r in agg.topk_rows(df, "v", 2, ("id",)).collect()] == [1, 2]


ORDERS = [("Toys", 2, "0.10"), ("Toys", 3, "0.20"), ("Books", 5, "2000.00"), ("Food", 9, "0.01")]


def orders(spark):
    df = spark.createDataFrame(ORDERS, "category string, quantity int, price string")
    return df.withColumn("price", F.col("price").cast("decimal(10,2)"))


def test_revenue_is_exact(spark):
    got = agg.revenue_by_key(orders(spark), "category", "price", "quantity", "revenue").collect()
    assert [tuple(r) for r in got] == [
        ("Books", Decimal("10000.00")), ("Toys", Decimal("0.80")), ("Food", Decimal("0.09")),
    ]


def test_topk_groups(spark):
    got = agg.topk_groups(orders(spark), "category", F.sum("quantity"), 2, "n").collect()
    assert [tuple(r) for r in got] == [("Food", 9), ("Books", 5)]


def test_sum_by_lookup_sums_before_a_shuffled_join(spark):
    facts = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (9, 100)], "k int, v int")
    names = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, kind string")
    out = agg.sum_by_lookup(facts, names, "k", "id", "kind", F.col("v"), "total")
    assert rows(out) == [("a", 13)]
    text = plan(out)
    assert text.index("Join") < text.index("partial_sum(v")


def test_sum_by_lookup_does_not_move_facts_for_a_small_lookup(spark):
    items, part = table(spark, SMALL, "lineitem"), table(spark, SMALL, "part")
    args = (items, part, "l_partkey", "p_partkey", "p_type", F.col("l_quantity"), "total")
    small = agg.sum_by_lookup(*args)
    assert "BroadcastHashJoin" in plan(small) and "hashpartitioning(l_partkey" not in plan(small)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = agg.sum_by_lookup(*args)
        assert "hashpartitioning(l_partkey" in plan(large)
        assert rows(large) == rows(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_avg_latest_n(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 31)], "id long, v double")
    assert agg.avg_latest_n(df, "id", "v").first()[0] == 25.5
    assert agg.avg_latest_n(df.limit(0), "id", "v").first()[0] is None


def test_avg_recent_minutes_edges(spark):
    df = spark.createDataFrame(
        [("12:00:00", 1.0), ("11:50:00", 3.0), ("11:49:59", 100.0), ("12:00:01", 100.0)],
        "t string, v double",
    ).withColumn("ts", F.to_timestamp(F.concat(F.lit("2024-05-01 "), "t")))
    as_of = F.lit("2024-05-01 12:00:00").cast("timestamp")
    assert tuple(agg.avg_recent_minutes(df, "ts", "v", as_of).first()) == (2.0, 2)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.sampled_from(["a", "b", "c", None]), max_size=40),
    st.lists(st.sampled_from(["b", "c", "d", None]), max_size=40),
)
def test_pair_counts_equal_the_join(spark, left, right):
    a = spark.createDataFrame([(k,) for k in left], "k string")
    b = spark.createDataFrame([(k,) for k in right], "k string")
    assert join_count(a, b, "k").first()[0] == sum(x == y for x in left for y in right if x)
    own = sum(x == y for x in left for y in left if x)
    assert self_join_count(a, "k").first()[0] == own == pair_count(a, "k").first()[0]


def test_pair_counts_beyond_a_long(spark):
    # 3.2e9 rows per key would give more pairs than fit into 64 bits.
    counts = spark.range(4).select(F.lit(3_200_000_000).cast("decimal(19,0)").alias("n"))
    assert counts.agg(F.sum(F.col("n") * F.col("n"))).first()[0] == 4 * 3_200_000_000**2
    assert pair_count(spark.range(0).withColumnRenamed("id", "k"), "k").first()[0] == 0


def test_pair_count_has_no_join_and_the_join_no_pairs(spark):
    df = people(spark)
    assert "Join" not in plan(pair_count(df, "country"))
    text = plan(self_join_count(df, "country"))
    assert text.index("Join") < text.index("partial_count(1)")


def test_scan_reads_two_columns(spark):
    text = plan(agg.avg_by_key(table(spark, SMALL, "part"), "p_brand", "p_retailprice"))
    assert "ReadSchema: struct<p_brand:string,p_retailprice:double>" in text
