import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators.buckets import read_buckets
from tidewell.operators.detect import anomaly_batch, velocity_batch
from tidewell.session import new_dir
from tidewell.sources.files import parquet_stream
from tidewell.streaming import agents, carried, logs
from tidewell.streaming.runner import (
    late_data_report,
    run_agents,
    run_to_end,
    start_query,
    stream_progress,
)
from tidewell.streaming.sinks import (
    alert_sink,
    batch_sink,
    latest_updates,
    read_batches,
    read_last_batch,
    topic_records,
)

BASE = 1_768_142_570_000  # a multiple of ten seconds


def log(second, user="user_1", content="App CRASH now", severity="High", ip="10.0.0.1"):
    return {"timestamp": BASE + round(second * 1000), "status": "x", "severity": severity,
            "source_ip": ip, "user_id": user, "content": content}


class Topic:
    """Files that arrive one after the other, and a query that is resumed after each."""

    def __init__(self, spark, build, mode, **options):
        self.spark, self.build, self.mode, self.options = spark, build, mode, options
        self.source, self.out = new_dir(spark, "topic"), new_dir(spark, "out")
        self.checkpoints = new_dir(spark, "checkpoints")

    def arrive(self, records):
        if isinstance(records, list):
            texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
            records = self.spark.createDataFrame(texts, "value string").select(
                F.col("value").cast("binary"))
        records.coalesce(1).write.mode("append").parquet(self.source)
        stream = parquet_stream(self.spark, self.source, schema=records.schema)
        query = start_query(
            self.build(stream), "q", batch_sink(self.out), self.checkpoints, self.mode,
            **self.options)
        return run_to_end(query)

    def read(self):
        return read_batches(self.spark, self.out)


def crashes(stream):
    return logs.crash_monitor(logs.parse_logs(stream))


def found(df):
    got = df.select(F.unix_millis("window_start"), F.unix_millis("window_end"), "user_id", "crash_count")
    return sorted(((a - BASE) // 1000, (b - BASE) // 1000, u, n) for a, b, u, n in got.collect())


def test_parse_logs(spark):
    df = spark.createDataFrame([(json.dumps(log(0)),), ("{bad",), (None,)], "value string")
    got = logs.parse_logs(df)
    assert got.filter("user_id IS NOT NULL").count() == 1 and got.count() == 3
    kept = logs.parse_logs(df, keep_corrupt=True).filter("_corrupt IS NOT NULL")
    assert [r["_corrupt"] for r in kept.collect()] == ["{bad"]


def test_a_record_is_parsed_once(spark):
    from conftest import plan

    df = spark.createDataFrame([(json.dumps(log(0)),)], "value string")
    assert plan(logs.log_counts(logs.parse_logs(df))).count("from_json") == 1


def test_log_counts_over_restarts(spark):
    def counts(stream):
        return logs.log_counts(logs.parse_logs(stream))

    topic = Topic(spark, counts, "complete")
    text = "a Vulnerability found"
    topic.arrive([log(0, content=text, ip="a"), log(1, content=text, ip="b"), "junk",
                  log(1, content=text, ip="b"), log(1, content=text, severity="Low", ip="c")])
    assert rows(read_last_batch(spark, topic.out)) == [("a", 1), ("b", 2)]
    topic.arrive([log(2, content=text, ip="a"), log(2, content=text, ip="a"), log(2, ip="b")])
    assert rows(read_last_batch(spark, topic.out)) == [("a", 3), ("b", 2)]


def test_crash_monitor_matches_the_rules(spark):
    three = [log(s) for s in (0, 4, 9.999)]
    two = [log(s, user="user_2") for s in (0, 1)] + [log(10, user="user_2")]
    mild = [log(s, user="user_3", severity="Low") for s in (1, 2, 3)]
    other = [log(s, user="user_4", content="all fine") for s in (1, 2, 3)]
    critical = [log(s, user="user_5", severity="Critical", content="it crashed") for s in (1, 2, 3)]
    nobody = [log(s, user=None) for s in (1, 2, 3)]
    topic = Topic(spark, crashes, "update")
    topic.arrive(three + two + mild + other + critical + nobody + ["{bad"])
    got = topic.read()
    assert found(got.filter("user_id IS NOT NULL")) == [
        (0, 10, "user_1", 3), (0, 10, "user_5", 3)]
    assert got.filter("user_id IS NULL").count() == 1


def test_update_mode_reports_growing_counts(spark):
    topic = Topic(spark, crashes, "update")
    topic.arrive([log(s) for s in (0, 1, 2)])
    topic.arrive([log(3)])
    topic.arrive([log(4)])
    assert [r[3] for r in found(topic.read())] == [3, 4, 5]
    keys = ["window_start", "window_end", "user_id"]
    assert found(latest_updates(spark, topic.out, keys)) == [(0, 10, "user_1", 5)]


def test_append_mode_reports_a_window_once_when_complete(spark):
    topic = Topic(spark, crashes, "append")
    topic.arrive([log(s) for s in (0, 1, 2)])
    assert topic.read().count() == 0
    topic.arrive([log(5), log(19)])
    assert topic.read().count() == 0
    # The watermark is ten seconds behind the newest record: 20 ends the first window.
    topic.arrive([log(20)])
    assert found(topic.read()) == [(0, 10, "user_1", 4)]
    topic.arrive([log(60)])
    assert found(topic.read()) == [(0, 10, "user_1", 4)]


def test_late_records_within_and_beyond_the_watermark(spark):
    topic = Topic(spark, crashes, "append")
    topic.arrive([log(0), log(1), log(18)])
    topic.arrive([log(2)])
    query = topic.arrive([log(40)])
    assert found(topic.read()) == [(0, 10, "user_1", 3)]
    assert late_data_report(query).agg(F.sum("late_rows_dropped")).first()[0] == 0
    query = topic.arrive([log(s, user="user_9") for s in (3, 4, 5)])
    assert found(topic.read()) == [(0, 10, "user_1", 3)]
    report = late_data_report(query).collect()
    assert sum(r.late_rows_dropped for r in report) == 1
    assert sum(r.input_rows for r in report) == 3


def test_batch_and_stream_share_the_transform(spark):
    records = [log(s / 2, user=f"user_{s % 4}") for s in range(60)]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    topic = Topic(spark, crashes, "update")
    topic.arrive(records)
    assert found(crashes(df)) == found(topic.read()) != []


def test_window_avg_on_a_stream(spark):
    df = spark.createDataFrame(
        [("s1", 0, 18.0), ("s1", 599, 19.0), ("s1", 600, 30.0), ("s2", 1, 20.0)],
        "sensor string, second int, temperature double",
    ).select("sensor", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("second")).alias("at"), "temperature")
    topic = Topic(
        spark, lambda s: logs.window_avg(s, "at", F.col("temperature"), ["sensor"], watermark="1 minute"),
        "update",
    )
    topic.arrive(df)
    got = topic.read().select("sensor", F.minute("window_start").alias("m"), "avg_value")
    assert rows(got) == [("s1", 0, 18.5), ("s1", 10, 30.0), ("s2", 0, 20.0)]


def test_ingest_writes_one_folder_per_day_and_counts_rejects(spark):
    source, target = new_dir(spark, "topic"), new_dir(spark, "logs")
    day = 86_400
    records = [json.dumps(log(0)), json.dumps(log(day)), "{bad", json.dumps(log(day + 1))]
    spark.createDataFrame([(r,) for r in records], "value string").select(
        F.col("value").cast("binary")).coalesce(1).write.parquet(source)
    stream = parquet_stream(spark, source, schema=spark.read.parquet(source).schema)
    query = run_to_end(logs.ingest_logs(stream, target, new_dir(spark, "cp"), lower_content=True))
    got = spark.read.parquet(target)
    assert rows(got.groupBy("event_date").count().select("count")) == [(1,), (2,)]
    assert got.filter("content_lower LIKE '%crash%'").count() == 3
    seen = [p["observedMetrics"]["ingest"] for p in query.recentProgress if p["numInputRows"]]
    assert (seen[0]["records"], seen[0]["rejected"]) == (4, 1)


START = dt.datetime(2024, 1, 1)


def payments(spark, count=400):
    entries = [
        (i, 7 if i % 3 else i % 5, float(i * 37 % 90 + (4500 if i % 41 == 0 else 5)),
         START + dt.timedelta(seconds=i * 2 - i % 3))
        for i in range(count)
    ]
    return spark.createDataFrame(entries, "id long, user_id int, amount double, created_at timestamp")


def in_parts(df, parts):
    total = df.count()
    return [df.filter(F.col("id").between(total * p // parts, total * (p + 1) // parts - 1)) for p in range(parts)]


def sorted_payments(spark):
    df = payments(spark)
    # Ids follow time, so that arrival in id order is arrival in time order.
    return df.withColumn("created_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 2))


@pytest.mark.parametrize("parts", [1, 3])
def test_anomaly_stream_equals_batch(spark, parts):
    df = sorted_payments(spark)
    topic = Topic(spark, agents.anomaly_stream, "append")
    for part in in_parts(df, parts):
        topic.arrive(part)
    columns = ["user_id", "id", "created_at", "history_n", "history_avg", "is_anomaly"]
    assert rows(topic.read().select(*columns)) == rows(anomaly_batch(df).select(*columns))
    assert anomaly_batch(df).filter("is_anomaly").count() > 0


def test_zscore_stream_equals_batch(spark):
    df = sorted_payments(spark)
    topic = Topic(spark, lambda s: agents.anomaly_stream(s, zscore=2.5), "append")
    for part in in_parts(df, 2):
        topic.arrive(part)
    want = anomaly_batch(df, zscore=2.5)
    assert rows(topic.read().select("id", "is_anomaly")) == rows(want.select("id", "is_anomaly"))
    assert 0 < want.filter("is_anomaly").count() < 100


@pytest.mark.parametrize("parts", [1, 3])
def test_velocity_stream_equals_batch(spark, parts):
    df = sorted_payments(spark)
    topic = Topic(spark, agents.velocity_stream, "append")
    for part in in_parts(df, parts):
        topic.arrive(part)
    columns = ["user_id", "id", "created_at", "velocity", "score", "is_alert"]
    assert rows(topic.read().select(*columns)) == rows(velocity_batch(df).select(*columns))
    assert velocity_batch(df).filter("is_alert").count() > 0


def test_rows_out_of_order_within_a_batch_are_judged_in_time_order(spark):
    df = payments(spark).orderBy(F.rand(3))
    topic = Topic(spark, agents.anomaly_stream, "append")
    topic.arrive(df)
    columns = ["user_id", "id", "history_n", "history_avg", "is_anomaly"]
    assert rows(topic.read().select(*columns)) == rows(anomaly_batch(df).select(*columns))


def test_idle_users_are_forgotten(spark):
    topic = Topic(spark, lambda s: agents.velocity_stream(s, watermark="10 seconds"), "append")
    one = "id long, user_id int, amount double, created_at timestamp"

    def at(number, user, second):
        return spark.createDataFrame([(number, user, 1.0, START + dt.timedelta(seconds=second))], one)

    topic.arrive(at(0, 1, 0))
    topic.arrive(at(1, 2, 50))
    query = topic.arrive(at(2, 2, 200))
    states = [r.state_rows for r in stream_progress(query).orderBy("batch_id").collect()]
    assert states[0] == 2 and states[-1] == 1
    assert rows(topic.read().select("id", "velocity")) == [(0, 1), (1, 1), (2, 1)]


def test_rows_in_disorder_over_batches(spark):
    df = payments(spark, 300)
    parts = [df.filter(F.col("id") % 3 == part) for part in (2, 0, 1)]
    for watermark, all_rows in [("1 second", False), (None, True)]:
        topic = Topic(spark, lambda s: agents.velocity_stream(s, watermark=watermark), "append")
        for part in parts:
            topic.arrive(part)
        judged = topic.read().select("id").distinct().count()
        assert judged == 300 if all_rows else 100 <= judged < 300


def test_a_row_behind_the_newest_watermark_only(spark):
    """Two files in one run: the second batch is late by the first's watermark only."""
    source, out = new_dir(spark, "topic"), new_dir(spark, "out")
    one = "id long, user_id int, amount double, created_at timestamp"
    for number, second in enumerate([5000, 0, 1]):
        spark.createDataFrame(
            [(number, 1, 1.0, START + dt.timedelta(seconds=second))], one
        ).coalesce(1).write.mode("append").parquet(source)
    stream = parquet_stream(spark, source, max_files=1)
    run_to_end(start_query(
        agents.velocity_stream(stream, watermark="10 seconds"), "q", batch_sink(out),
        new_dir(spark, "cp")))
    assert 0 in {r.id for r in read_batches(spark, out).collect()}


def test_velocity_by_processing_time(spark):
    # All rows of a batch are read at one moment, however old their own times are.
    topic = Topic(
        spark, lambda s: agents.velocity_stream(s, time_mode="processing"), "append",
        no_data_batches=False)
    topic.arrive(payments(spark, 12))
    got = topic.read().groupBy("user_id").agg(F.count("*").alias("n"), F.min("velocity").alias("v"))
    assert all(r.n == r.v for r in got.collect())
    with pytest.raises(ValueError):
        agents.velocity_stream(payments(spark, 1), time_mode="wall")


def test_agents_are_independent_and_alerts_are_forwarded(spark):
    source, root = new_dir(spark, "topic"), new_dir(spark, "agents")
    df = sorted_payments(spark)
    df.write.parquet(source)
    flags = {"anomaly": "is_anomaly", "velocity": "is_alert"}
    forwarded = f"{root}/forwarded"
    queries = run_agents(
        parquet_stream(spark, source),
        {"anomaly": agents.anomaly_stream, "velocity": agents.velocity_stream},
        {n: alert_sink(f"{root}/{n}", flag, [batch_sink(f"{forwarded}/{n}")]) for n, flag in flags.items()},
        f"{root}/checkpoints",
    )
    for query in queries.values():
        run_to_end(query)
    want = {"anomaly": anomaly_batch(df), "velocity": velocity_batch(df)}
    for name, flag in flags.items():
        ids = rows(want[name].filter(flag).select("id"))
        assert ids and rows(read_batches(spark, f"{root}/{name}").select("id")) == ids
        assert rows(read_batches(spark, f"{forwarded}/{name}").select("id")) == ids


@pytest.mark.parametrize("split_rows", [50, 2_000_000])
def test_carried_anomalies_equal_batch(spark, split_rows):
    df, out, state = sorted_payments(spark), new_dir(spark, "out"), new_dir(spark, "state")
    sink = carried.anomaly_sink(out, state, split_rows=split_rows, buckets=4)
    for number, part in enumerate(in_parts(df, 4)):
        for _ in range(1 + number % 2):  # every other batch twice, as after a failure
            sink(part, number)
    columns = ["user_id", "id", "history_n", "history_avg", "is_anomaly"]
    assert rows(read_batches(spark, out).select(*columns)) == rows(anomaly_batch(df).select(*columns))
    kept = read_buckets(spark, f"{state}/users").groupBy("user_id").count()
    assert kept.agg(F.max("count")).first()[0] == 50


@pytest.mark.parametrize("dense_rows", [1, 5000])
def test_carried_velocities_equal_batch(spark, dense_rows):
    df, out, state = sorted_payments(spark), new_dir(spark, "out"), new_dir(spark, "state")
    sink = carried.velocity_sink(out, state, delay="1 second", dense_rows=dense_rows)
    for number, part in enumerate(in_parts(df, 3)):
        sink(part, number)
    columns = ["user_id", "id", "velocity", "score", "is_alert"]
    assert rows(read_batches(spark, out).select(*columns)) == rows(velocity_batch(df).select(*columns))
    # Half of a batch, and what its middle row can still see.
    assert spark.read.parquet(f"{state}/delta/batch=2").count() < df.count() / 3 / 2 + 40


def test_a_repeated_batch_is_written_once(spark):
    out = new_dir(spark, "alerts")
    sink = alert_sink(out, "id > 1")
    sink(spark.range(4), 0)
    sink(spark.range(4), 0)
    sink(spark.range(3), 1)
    assert rows(read_batches(spark, out)) == [(2, 0), (2, 1), (3, 0)]


def test_alerts_as_topic_records(spark):
    got = topic_records(spark.range(2).withColumn("score", F.lit(90)), "id", 7)
    assert rows(got) == [("0", '{"id":0,"score":90,"batch":7}'), ("1", '{"id":1,"score":90,"batch":7}')]


def test_progress_and_console(spark, capfd):
    source = new_dir(spark, "topic")
    spark.range(10).write.parquet(source)
    counts = parquet_stream(spark, source).groupBy((F.col("id") % 3).alias("k")).count()
    query = run_to_end(start_query(
        counts.orderBy(F.desc("count")), "shown", "console", new_dir(spark, "cp"), "complete"))
    assert stream_progress(query).agg(F.sum("input_rows")).first()[0] == 10


def test_interval_trigger(spark):
    source, out = new_dir(spark, "topic"), new_dir(spark, "out")
    spark.range(10).write.parquet(source)
    query = start_query(
        parquet_stream(spark, source), "timed", batch_sink(out), new_dir(spark, "cp"),
        trigger="1 second")
    try:
        query.processAllAvailable()
        assert read_batches(spark, out).count() == 10
    finally:
        query.stop()
