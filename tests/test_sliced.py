"""Detectors whose work on one user is spread over slices of time."""

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators.detect import anomaly_batch, velocity_batch
from tidewell.session import new_dir
from tidewell.sources.files import in_order_of, parquet_stream
from tidewell.streaming import agents, sliced
from tidewell.streaming.runner import run_to_end, start_query, stream_progress
from tidewell.streaming.sinks import batch_sink, read_batches

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
ONE = "id long, user_id int, amount double, created_at timestamp"
ANOMALY = ["user_id", "id", "history_n", "history_avg", "is_anomaly"]
VELOCITY = ["user_id", "id", "created_at", "velocity", "score", "is_alert"]


def payments(spark, n=400):
    """Half of all rows are one user's; some share their time, some are dear."""
    at = F.timestamp_micros((F.lit(1_704_067_200) + F.floor(F.col("id") / 2) * 7) * 1_000_000)
    return spark.range(n).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 7).cast("int").alias("user_id"),
        F.when(F.col("id") % 29 == 0, F.lit(9000.0)).otherwise(F.col("id") % 50 + 1.25).alias("amount"),
        at.alias("created_at"))


def streamed(spark, df, build, slices=3):
    out = new_dir(spark, "out")
    stream = in_order_of(df, "created_at", new_dir(spark, "in"), slices)
    query = run_to_end(start_query(build(stream), "q", batch_sink(out), new_dir(spark, "cp")))
    return read_batches(spark, out), query


@pytest.mark.parametrize("zscore", [None, 2.0])
def test_sliced_anomalies_equal_batch(spark, zscore):
    df = payments(spark)
    got, _ = streamed(spark, df, lambda s: sliced.anomaly_sliced(s, zscore=zscore))
    want = anomaly_batch(df, zscore=zscore)
    assert rows(got.select(*ANOMALY)) == rows(want.select(*ANOMALY))
    assert want.filter("is_anomaly").count() > 0


@pytest.mark.parametrize("width", ["10 seconds", "1 minute"])
def test_sliced_velocities_equal_batch(spark, width):
    df = payments(spark)
    got, _ = streamed(spark, df, lambda s: sliced.velocity_sliced(s, slice_width=width, window="1 minute"))
    want = velocity_batch(df, window="1 minute")
    assert rows(got.select(*VELOCITY)) == rows(want.select(*VELOCITY))
    assert want.filter("is_alert").count() > 0


def test_no_task_holds_the_user_with_half_of_the_rows(spark):
    df, counts = payments(spark, 6000), []

    def per_task(batch, batch_id):
        found = batch.groupBy(F.spark_partition_id()).count().collect()
        counts.append(sorted(r["count"] for r in found))

    stream = in_order_of(df, "created_at", new_dir(spark, "in"), 1)
    run_to_end(start_query(
        sliced.velocity_sliced(stream, slice_width="1 minute", window="10 minutes"), "q", per_task,
        new_dir(spark, "cp"), partitions=8))
    tasks = counts[0]
    assert sum(tasks) == 6000 and len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]


def arriving(spark, build, batches, wait=0.0):
    source, out, cp = new_dir(spark, "in"), new_dir(spark, "out"), new_dir(spark, "cp")
    for batch in batches:
        values = [(i, u, 1.0, START + dt.timedelta(seconds=s)) for i, u, s in batch]
        spark.createDataFrame(values, ONE).coalesce(1).write.mode("append").parquet(source)
        stream = parquet_stream(spark, source, schema=spark.createDataFrame([], ONE).schema)
        query = run_to_end(start_query(build(stream), "q", batch_sink(out), cp, no_data_batches=False))
        time.sleep(wait)
    return read_batches(spark, out), query


def test_slices_out_of_reach_are_forgotten(spark):
    batches = [[(i, 1, i * 10) for i in range(30)], [(100, 1, 5000)], [(101, 1, 5001), (102, 1, 0)]]
    got, query = arriving(spark, lambda s: sliced.velocity_sliced(s, window="1 minute", delay="1 minute"), batches)
    last = stream_progress(query).orderBy(F.desc("batch_id")).first()
    assert last.state_rows < 10
    assert rows(got.filter("id >= 100").select("id", "velocity")) == [(100, 1), (101, 2), (102, 1)]


def test_idle_users_are_forgotten_by_a_timer(spark):
    batches = [[(0, 1, 0), (1, 1, 1)], [(2, 2, 2)], [(3, 1, 3), (4, 2, 4)]]
    for build, column, wanted in [
        (lambda s: sliced.anomaly_sliced(s, idle="1 second"), "history_n", [(0, 0), (1, 1), (2, 0), (3, 0)]),
        (lambda s: sliced.velocity_sliced(s, idle="1 second"), "velocity", [(0, 1), (1, 2), (2, 1), (3, 1)]),
    ]:
        got, _ = arriving(spark, build, batches, wait=1.5)
        assert rows(got.filter("id < 4").select("id", column)) == wanted


def test_a_window_is_whole_slices(spark):
    with pytest.raises(ValueError):
        sliced.velocity_sliced(payments(spark, 1), slice_width="7 seconds", window="1 minute")


def test_rows_in_any_order_and_incomplete_ones(spark):
    """Users and ids of text, rows of null users, and rows that can't be judged."""
    values = [(f"i{n}", None if n % 5 == 0 else f"u{n % 3}", None if n == 7 else 1.5, START + dt.timedelta(seconds=n * 13 % 90))
              for n in range(60)]
    schema = "id string, user_id string, amount double, created_at timestamp"
    df = spark.createDataFrame(values, schema)
    source = new_dir(spark, "in")
    df.coalesce(1).write.parquet(source)
    for build, want, columns in [
        (sliced.anomaly_sliced, anomaly_batch(df.dropna(subset=["amount"])), ANOMALY),
        (sliced.velocity_sliced, velocity_batch(df.dropna(subset=["amount"])), VELOCITY),
    ]:
        out = new_dir(spark, "out")
        stream = parquet_stream(spark, source, schema=df.schema)
        run_to_end(start_query(build(stream), "q", batch_sink(out), new_dir(spark, "cp")))
        assert rows(read_batches(spark, out).select(*columns)) == rows(want.select(*columns))


def test_a_call_serves_many_users(spark):
    """Rows kept follow lots and slices, not users and slices, of which there are many more."""
    n, users, slices = 6000, 1000, 12
    df = spark.range(n).select(
        "id", (F.col("id") % users).alias("user_id"), F.lit(1.5).alias("amount"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") * slices * 60 / n)).alias("created_at"))
    got, query = streamed(spark, df, lambda s: sliced.velocity_sliced(
        s, slice_width="1 minute", window="10 minutes", delay="1 hour"), slices=2)
    assert rows(got.select(*VELOCITY)) == rows(velocity_batch(df, window="10 minutes").select(*VELOCITY))
    # Per lot and slice an element for each of two micro-batches and uses, and one per user.
    last = stream_progress(query).orderBy(F.desc("batch_id")).first()
    assert last.state_rows <= users + agents.LOTS * 2 * (slices + 2)


def test_one_judge_call_tells_users_apart():
    rng = np.random.default_rng(3)
    units = rng.integers(1, 90_000, 60)
    who = np.array([f"={i % 7}" for i in range(60)], object)
    rule = (5, 3, 3.0, 10_000, None)
    messages = pd.DataFrame({
        "lot": 0, "who": who, "slice": 0, "kind": sliced.ROW, "row_id": np.arange(60),
        "row_at": np.arange(60) // 2, "units": units, "known": None})
    before = np.array([100, 200, 50_000], "int64")
    told = pd.DataFrame({
        "lot": 0, "who": ["=3"], "slice": 0, "kind": sliced.KNOWN, "row_id": None, "row_at": None,
        "units": None, "known": [before.tobytes()]})
    judged = pd.concat(sliced.AnomalyJudge(*rule).handleInputRows((0, 0), iter([messages, told]), None))
    for user in range(7):
        own = judged[judged["who"] == f"={user}"].sort_values("id")
        n, total, flagged = agents.flag_anomalies(
            before if user == 3 else np.array([], "int64"), units[who == f"={user}"], *rule)
        assert own["history_n"].tolist() == n.tolist() and own["history_sum"].tolist() == total.tolist()
        assert own["is_anomaly"].tolist() == flagged.tolist()


def test_large_user_numbers_beside_null_users(spark):
    large = 2**60
    values = [(i, None if i % 3 == 0 else large + i % 2, 1.5, START + dt.timedelta(seconds=i)) for i in range(30)]
    df = spark.createDataFrame(values, "id long, user_id long, amount double, created_at timestamp")
    for build, batch, columns in [
        (sliced.anomaly_sliced, anomaly_batch, ANOMALY), (sliced.velocity_sliced, velocity_batch, VELOCITY),
    ]:
        got, _ = streamed(spark, df, build)
        assert rows(got.select(*columns)) == rows(batch(df).select(*columns))


class State(dict):
    """A map state."""

    def getValue(self, who):
        return self.get(who)

    def updateValue(self, who, value):
        self[who] = value


def test_a_call_of_the_plain_velocity_detector_serves_many_users():
    judge = agents.VelocityScan(10, 2, 100, 70, "None")
    judge.users = State({("=1",): (np.array([1, 4, 5], "int64").tobytes(),)})
    chunk = pd.DataFrame({
        "lot": 0, "who": ["=2", "=1", "=2", ""], "row_id": [4, 3, 2, 1], "row_at": [9, 14, 7, 6],
        "units": [1, 200, 2, 3]})
    judged = pd.concat(judge.handleInputRows((0,), iter([chunk]), None)).sort_values("id")
    assert judged["velocity"].tolist() == [1, 1, 3, 2]
    assert judged["is_alert"].tolist() == [False, False, True, False]
    kept = {who: np.frombuffer(value[0], "int64").tolist() for (who,), value in judge.users.items()}
    assert kept == {"=1": [4, 5, 14], "=2": [7, 9], "": [6]}


def test_a_call_of_the_plain_detector_serves_many_users():
    """A lot's users are judged in one call, each by what the state has of them."""
    judge = agents.RecentJudge(5, 3, 3.0, 10_000, None)
    judge.users = State({("=1",): (np.array([100, 100, 100], "int64").tobytes(),)})
    chunk = pd.DataFrame({
        "lot": 0, "who": ["=2", "=1", "=2", ""], "row_id": [4, 3, 2, 1], "row_at": [9, 8, 7, 6],
        "units": [1, 20_000, 2, 3]})
    judged = pd.concat(judge.handleInputRows((0,), iter([chunk]), None)).sort_values("id")
    assert judged["history_n"].tolist() == [0, 0, 3, 1]
    assert judged["is_anomaly"].tolist() == [False, False, True, False]
    kept = {who: np.frombuffer(value[0], "int64").tolist() for (who,), value in judge.users.items()}
    assert kept == {"=1": [100, 100, 100, 20_000], "=2": [2, 1], "": [3]}
