"""Streams over several micro-batches: order, progress, carried rows and compaction."""

import datetime as dt
import functools
import os
import random

import pytest
from conftest import SMALL, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewell.operators import search
from tidewell.operators.aggregates import sum_by_lookup
from tidewell.operators.buckets import read_buckets
from tidewell.operators.detect import anomaly_batch, velocity_batch
from tidewell.plans import streams
from tidewell.session import new_dir
from tidewell.sources import files
from tidewell.sources.files import in_order_of, parquet_stream, spread
from tidewell.streaming import agents, carried
from tidewell.streaming.runner import (
    ProgressLog,
    run_to_end,
    start_query,
    state_partitions,
    stream_progress,
)
from tidewell.streaming.sinks import batch_sink, read_batches, read_last_batch

SCHEMA = "id {id}, user_id long, amount decimal(10,2), created_at timestamp"
START = dt.datetime(2024, 1, 1)


def entries(spark, n=400, seed=1, kind="long"):
    rng = random.Random(seed)
    made = [(i, rng.randrange(5), rng.choice([1, 2, 700]), START + dt.timedelta(seconds=rng.randrange(900)))
            for i in range(n)]
    df = spark.createDataFrame(
        [(f"t{i:05}" if kind == "string" else i, u, None, at) for i, u, _, at in made],
        SCHEMA.format(id=kind))
    amounts = spark.createDataFrame(
        [(f"t{i:05}" if kind == "string" else i, a) for i, _, a, _ in made], f"id {kind}, a int")
    return df.join(amounts, "id").withColumn("amount", F.col("a").cast("decimal(10,2)")).drop("a")


def through(spark, stream, build=lambda s: s, name="q", sink=None, mode="append"):
    out, checkpoints = new_dir(spark, "out"), new_dir(spark, "checkpoints")
    query = run_to_end(start_query(build(stream), name, sink or batch_sink(out), checkpoints, mode))
    return out, query


def test_slices_come_in_order_of_time(spark):
    df = entries(spark).repartition(6)
    out, _ = through(spark, in_order_of(df, "created_at", new_dir(spark, "slices"), slices=5))
    got = read_batches(spark, out)
    spans = got.groupBy("batch").agg(F.min("created_at"), F.max("created_at")).orderBy("batch").collect()
    assert len(spans) >= 3
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
    assert rows(got.drop("batch")) == rows(df)


def test_a_slice_is_several_tasks_work(spark, monkeypatch):
    """Also where most ranges of time have no rows; the slices keep their order and number."""
    monkeypatch.setattr(files, "MIN_FILE_BYTES", 1)
    cores = spark.sparkContext.defaultParallelism
    few_times = entries(spark, seed=2).withColumn(
        "created_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 9))
    for made, per_slice in ((entries(spark), cores), (few_times, 2)):
        made.write.parquet(table := new_dir(spark, "table"))
        df, seen = spark.read.parquet(table), []

        def count_files(batch, batch_id):
            spans = batch.groupBy("file").agg(
                F.min("created_at").alias("a"), F.max("created_at").alias("b"))
            seen.append([(r.a, r.b) for r in spans.orderBy("a").toLocalIterator()])

        stream = in_order_of(df, "created_at", new_dir(spark, "slices"), slices=4)
        out, _ = through(spark, stream, lambda s: s.withColumn("file", F.input_file_name()), sink=count_files)
        assert len(seen) >= 4 and max(map(len, seen)) == per_slice
        spans = [span for batch in seen for span in batch]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        out, _ = through(spark, stream)
        assert rows(read_batches(spark, out).drop("batch")) == rows(df)


def test_files_of_a_slice_follow_its_size_and_the_cores():
    mb = 1024 * 1024
    assert [files.files_per_slice(s, 12) for s in (0, mb, 5 * mb, 30 * mb, 180 * mb)] == [1, 1, 5, 12, 12]
    assert files.files_per_slice(512 * mb, 12) == 16


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("slices", [1, 6])
def test_detectors_keep_every_row_and_flag(spark, slices, kind):
    df = entries(spark, kind=kind).repartition(5)

    def stream():
        return in_order_of(df, "created_at", new_dir(spark, "slices"), slices=slices)

    out, _ = through(spark, stream(), lambda s: agents.velocity_stream(s, high_amount=500))
    wanted = velocity_batch(df, high_amount=500).select("id", "velocity", "score", "is_alert")
    assert rows(read_batches(spark, out).select(*wanted.columns)) == rows(wanted)
    # A user's rows of one time are ordered by id, within one slice as in the batch.
    out, _ = through(spark, stream(), lambda s: agents.anomaly_stream(s, ratio=2.3, floor=100))
    wanted = anomaly_batch(df, ratio=2.3, floor=100).select("id", "history_n", "is_anomaly")
    assert rows(read_batches(spark, out).select(*wanted.columns)) == rows(wanted)
    assert wanted.filter("is_anomaly").count() > 0


def test_a_ratio_at_its_limit_in_batch_and_stream(spark):
    amounts = [0.2] * 5 + [0.46]
    df = spark.createDataFrame(
        [(i, 1, a, START + dt.timedelta(seconds=i)) for i, a in enumerate(amounts)],
        "id long, user_id long, amount double, created_at timestamp")
    rule = {"ratio": 2.3, "floor": 0.1}
    assert anomaly_batch(df, **rule).filter("is_anomaly").count() == 0
    out, _ = through(spark, in_order_of(df, "created_at", new_dir(spark, "s")),
                     lambda s: agents.anomaly_stream(s, **rule))
    assert read_batches(spark, out).filter("is_anomaly").count() == 0


def test_rows_that_cannot_be_judged_are_counted(spark):
    df = entries(spark, 40).withColumn("amount", F.when(F.col("id") % 4 != 0, F.col("amount")))
    path = new_dir(spark, "rows")
    df.coalesce(1).write.parquet(path)
    out, query = through(spark, parquet_stream(spark, path), agents.anomaly_stream)
    assert read_batches(spark, out).count() == 30
    seen = [r.observedMetrics["detector"] for r in query.recentProgress if r.observedMetrics]
    assert sum(s["rejected"] for s in seen) == 10


def test_all_progress_of_a_long_query_is_kept(spark):
    path = new_dir(spark, "many")
    spark.range(160).repartition(160).write.option("maxRecordsPerFile", 1).parquet(path)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 100)
    reports = ProgressLog(spark, "long-query", new_dir(spark, "reports"), every=50)
    stream = parquet_stream(spark, path, max_files=1)
    out, checkpoints = new_dir(spark, "out"), new_dir(spark, "checkpoints")
    query = run_to_end(start_query(stream, "long-query", "parquet", checkpoints, path=out))
    total = stream_progress(reports).agg(F.sum("input_rows"), F.countDistinct("batch_id")).first()
    reports.close()
    assert tuple(total) == (160, 160)
    with pytest.raises(ValueError):
        stream_progress(query)


def arrive(spark, source, rows_, sink, checkpoints, step):
    rows_.coalesce(1).write.mode("append").parquet(source)
    run_to_end(start_query(parquet_stream(spark, source), "carried", sink, checkpoints))


def test_one_future_time_discards_no_history(spark):
    def at(seconds):
        return START + dt.timedelta(seconds=seconds)

    first = [(i, 1, 1.0, at(i)) for i in range(5)] + [(50, 2, 1.0, dt.datetime(2099, 1, 1))]
    second = [(6, 1, 1.0, at(6)), (7, 3, 1.0, at(7))]
    kind = "id long, user_id long, amount double, created_at timestamp"
    source, out, state, checkpoints = (new_dir(spark, n) for n in ("src", "out", "state", "cp"))
    sink = carried.velocity_sink(out, state)
    for step, part in enumerate((first, second)):
        arrive(spark, source, spark.createDataFrame(part, kind), sink, checkpoints, step)
    wanted = velocity_batch(spark.createDataFrame(first + second, kind)).select("id", "velocity")
    assert rows(read_batches(spark, out).select("id", "velocity")) == rows(wanted)


def test_carried_state_stays_that_of_two_batches(spark):
    df = entries(spark, 120)
    stream = in_order_of(df, "created_at", new_dir(spark, "slices"), slices=12)
    out, state = new_dir(spark, "out"), new_dir(spark, "state")
    through(spark, stream, sink=carried.anomaly_sink(out, state, floor=100))
    for kind, most in (("manifest", 2), ("changes", 2)):
        kept = [n for n in os.listdir(f"{state}/users/{kind}") if n.startswith("batch=")]
        assert len(kept) <= most, kind
    users = read_buckets(spark, f"{state}/users")
    assert users.count() == users.select("id").distinct().count() <= 50 * df.select("user_id").distinct().count()
    wanted = anomaly_batch(df, floor=100).select("id", "history_n", "is_anomaly")
    assert rows(read_batches(spark, out).select(*wanted.columns)) == rows(wanted)


def test_a_stream_of_a_file_takes_no_neighbours(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "made"))
    made = next(p for p in (tmp_path / "made").iterdir() if p.name.endswith(".parquet"))
    for name in ("t.parquet", "t.parquet_old", "t.parquet2.parquet"):
        (tmp_path / name).write_bytes(made.read_bytes())
    out, _ = through(spark, parquet_stream(spark, str(tmp_path / "t.parquet")))
    assert read_batches(spark, out).count() == 3


def test_an_index_is_the_same_after_compaction(spark):
    docs = spark.createDataFrame(
        [(i, f"common word{i % 7} text {i}") for i in range(90)], "doc_id long, text string")
    stream = in_order_of(docs, "doc_id", new_dir(spark, "docs"), slices=4)
    target = new_dir(spark, "index")
    through(spark, stream, sink=search.index_sink("doc_id", "text", target, buckets=4))
    before = rows(search.read_index(spark, target).select("term", "doc_id", "tf"))
    assert len(before) > 90 * 3
    for _ in range(2):
        search.compact_index(spark, target)
        index = search.read_index(spark, target)
        assert rows(index.select("term", "doc_id", "tf")) == before
        assert search.lookup(index, "common").count() == 90


def test_a_lookup_sum_has_one_type(spark):
    facts = spark.range(50).select(
        (F.col("id") % 5).alias("k"), F.lit("1.25").cast("decimal(18,2)").alias("v"))
    names = spark.range(5).select("id", F.format_string("n%d", "id").alias("name"))
    kinds, totals = set(), []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = sum_by_lookup(facts, names, "k", "id", "name", F.col("v"), "total")
        kinds.add(got.schema["total"].dataType.simpleString())
        totals.append(rows(got))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(kinds) == 1 and totals[0] == totals[1]


def test_state_partitions_do_not_follow_cores(spark):
    assert state_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_spreading_does_not_run_what_it_spreads(spark):
    shuffled = spark.range(100).repartition(3, "id").groupBy("id").count()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    spread(shuffled)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == jobs


def test_registered_streams_run_several_batches(spark):
    out, _ = through(spark, streams.events_in_order(spark, SMALL))
    assert read_batches(spark, out).agg(F.countDistinct("batch")).first()[0] >= 3
    assert read_last_batch(spark, out).count() > 0


def alerts_in_every_slice(spark, monkeypatch):
    """A folder with a table of events, of which every tenth is an alert by its amount alone."""
    monkeypatch.setattr(
        streams, "_anomalies", lambda sdf: sdf.withColumn("is_anomaly", F.col("value") > 100))
    spark.range(270).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("ts"),
        F.when(F.col("id") % 10 == 9, 700.0).otherwise(1.0).alias("value"),
    ).write.parquet(f"{(folder := new_dir(spark, 'alerts'))}/events.parquet")
    return folder


def test_an_outbox_is_resumed_until_all_batches_are_sent(spark, monkeypatch):
    """Also where a table makes more batches, each with a failure, than replays have at least."""
    monkeypatch.setattr(streams, "in_order_of", functools.partial(in_order_of, slices=12))
    folder = alerts_in_every_slice(spark, monkeypatch)
    got = rows(streams.alert_outbox(spark, folder))
    wanted = [(name, e) for name in ("first", "second") for e in range(9, 270, 10)]
    assert got == sorted(wanted, key=repr)


def test_an_outbox_that_gets_no_further_raises(spark, monkeypatch):
    def never(*_):
        def write(batch, batch_id):
            raise ConnectionError("the table is away")
        return write

    monkeypatch.setattr(streams, "alert_sink", never)
    folder = alerts_in_every_slice(spark, monkeypatch)
    with pytest.raises(StreamingQueryException):
        streams.alert_outbox(spark, folder)
