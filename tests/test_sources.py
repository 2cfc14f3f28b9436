import datetime as dt

import pytest
from conftest import SMALL, plan, rows
from pyspark.sql import functions as F

from tidewell.plans.tables import table
from tidewell.session import folder_bytes, list_dirs, new_dir, shared_root, size_shuffles
from tidewell.sources import jdbc, topics
from tidewell.sources.files import csv_scan, parquet_scan, parquet_stream, save_table
from tidewell.sources.ids import assign_ids
from tidewell.sources.schemas import ORDERS, PEOPLE, TOPIC_RECORD

PEOPLE_CSV = """first_name,last_name,gender,department,salary,country
Ann,Lee,Female,Sales,65000,PT
"Bob, Jr",Ray,Male,IT,112000,ES
"""


def test_csv_scan_is_typed(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text(PEOPLE_CSV)
    df = csv_scan(spark, str(path), PEOPLE)
    assert df.schema == PEOPLE
    assert rows(df)[1][0] == "Bob, Jr"
    assert df.agg(F.sum("salary")).first()[0] == 177000


def test_csv_scan_fails_on_a_bad_row(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text(PEOPLE_CSV + "Cid,Fox,Male,IT,many,ES\n")
    with pytest.raises(Exception, match="MALFORMED|many"):
        csv_scan(spark, str(path), PEOPLE).collect()


def test_csv_dates_and_decimals(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("x;Home & Garden;5;19.90;2024-02-29;PT\n")
    got = csv_scan(spark, str(path), ORDERS, header=False, sep=";").first()
    assert got.order_date == dt.date(2024, 2, 29) and str(got.price_per_unit) == "19.90"


def test_dense_ids_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    got = assign_ids(df, order_by=("k",))
    assert [(r.id, r.k) for r in got.orderBy("id").collect()] == [(i + 1, i) for i in range(1000)]


def test_dense_ids_with_empty_partitions(spark):
    df = spark.range(100).repartition(9).filter("id % 10 = 3")
    ids = [r.nr for r in assign_ids(df, "nr").collect()]
    assert sorted(ids) == list(range(1, 11))
    assert assign_ids(df.limit(0), "nr").count() == 0


def test_dense_ids_never_sort_all_rows_in_one_task(spark):
    text = plan(assign_ids(table(spark, SMALL, "orders").select("o_orderkey")))
    window = text.index("Window [")
    assert "SinglePartition" not in text[:window]


def test_unique_ids(spark):
    df = assign_ids(spark.range(100).repartition(5), "nr", dense=False)
    assert df.select("nr").distinct().count() == 100


def test_save_table_replaces(spark):
    path = new_dir(spark, "saved")
    save_table(spark.range(5).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    save_table(spark.range(3).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert rows(spark.read.parquet(path)) == [(0, 0), (1, 1), (2, 0)]
    save_table(spark.range(4), "tidewell_saved")
    assert spark.table("tidewell_saved").count() == 4


def test_times_become_instants_in_the_scan(spark):
    df = parquet_scan(spark, f"{SMALL}/events.parquet")
    assert dict(df.dtypes)["ts"] == "timestamp"
    pushed = df.filter(F.col("ts") > F.lit("2024-01-15").cast("timestamp")).select("user_id")
    assert "GreaterThan(ts" in plan(pushed)


def test_parquet_stream_of_a_file_and_of_a_folder(spark):
    from tidewell.streaming.runner import run_to_end, start_query
    from tidewell.streaming.sinks import batch_sink, read_batches

    folder = new_dir(spark, "events") + ".parquet"
    table(spark, SMALL, "events").repartition(3).write.parquet(folder)
    for path, batches in [(f"{SMALL}/events.parquet", 1), (folder, 3)]:
        out = new_dir(spark, "out")
        stream = parquet_stream(spark, path, max_files=1).select("event_id")
        run_to_end(start_query(stream, "copy", batch_sink(out), new_dir(spark, "cp")))
        got = read_batches(spark, out)
        assert got.count() == 1000 and got.select("batch").distinct().count() == batches


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "people", {"user": "u"})
    assert plain == {"url": "jdbc:x", "dbtable": "people", "fetchsize": "10000", "user": "u"}
    split = jdbc.jdbc_options("jdbc:x", "people", None, "id", 1, 1001, 8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "people", partitions=4)
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "people", column="id")


def test_increments_add_up(spark):
    target, source = new_dir(spark, "extract"), spark.range(1, 101).withColumn("v", F.col("id") * 2)
    assert jdbc.high_water_mark(spark, target) is None
    assert jdbc.extract_increment(source.filter("id <= 30"), target, "id") == 30
    assert jdbc.extract_increment(source.filter("id <= 30"), target, "id") == 30
    assert jdbc.extract_increment(source, target, "id") == 100
    assert list_dirs(spark, f"{target}/extracts") == ["upto=100", "upto=30"]
    assert rows(jdbc.read_extracts(spark, target)) == rows(source)


def test_kafka_options():
    options = topics.kafka_options("h:9092", "logs", max_offsets=5)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "5" and options["subscribe"] == "logs"
    assert topics.kafka_options("h", "t", "latest")["startingOffsets"] == "latest"


def test_records_have_the_topic_columns(spark):
    df = spark.range(3)
    records = topics.as_records(df, "t", F.col("id"), F.to_json(F.struct("id")), F.col("id"))
    assert [f.name for f in records.schema] == [f.name for f in TOPIC_RECORD]
    assert [f.dataType for f in records.schema] == [f.dataType for f in TOPIC_RECORD]
    path = new_dir(spark, "records")
    records.write.parquet(path)
    assert topics.record_files(spark, path).isStreaming


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_dir(spark, "a") != new_dir(spark, "a")


def test_shuffle_partitions_follow_the_input(spark):
    setting = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, folder_bytes(spark, SMALL)) == int(setting)
        assert size_shuffles(spark, 1 << 40) == 8193
        assert size_shuffles(spark, 100 << 40) == 20_000
        assert spark.conf.get("spark.sql.shuffle.partitions") == "20000"
        assert size_shuffles(spark, 1) == 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", setting)
