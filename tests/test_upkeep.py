"""Tables that streams keep up to date: buckets, served values, segments, late rows, ledgers."""

import os
import random
import statistics

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidewell.operators import buckets, cdc, manifest, rollup
from tidewell.session import folder_bytes, new_dir
from tidewell.sources.files import parquet_stream
from tidewell.streaming import late, segments
from tidewell.streaming.runner import run_to_end, start_query
from tidewell.streaming.sinks import (
    Outbox,
    alert_sink,
    batch_sink,
    fan_out_sink,
    latest_updates,
    read_batches,
    read_last_batch,
    read_served,
    read_top,
    serving_sink,
)

CHANGE = "id long, _order long, _op string, _after struct<id:long,v:string>"


def newest(both):
    return cdc._latest(both, ["id"])


def changes(spark, values):
    """(id, order, value or None for a deletion)."""
    return spark.createDataFrame(
        [(i, n, "d" if v is None else "u", None if v is None else (i, v)) for i, n, v in values], CHANGE)


def written_bytes(spark, target, batch):
    return folder_bytes(spark, f"{target}/data/batch={batch}")


def test_a_batch_rewrites_its_own_buckets_at_a_flat_cost(spark):
    target = new_dir(spark, "buckets")
    table = {i: (0, f"v{i}") for i in range(1600)}
    first = changes(spark, [(i, n, v) for i, (n, v) in table.items()])
    assert buckets.merge_batch(first, target, ["id"], newest, 0, 16) == list(range(16))
    whole, rng, costs = written_bytes(spark, target, 0), random.Random(1), []
    for batch in range(1, 51):
        some = {i: f"b{batch}" for i in rng.sample(range(1600), 2)}
        touched = buckets.merge_batch(
            changes(spark, [(i, batch, v) for i, v in some.items()]), target, ["id"], newest, batch, 16)
        assert len(touched) <= 2
        table |= {i: (batch, v) for i, v in some.items()}
        costs.append(written_bytes(spark, target, batch))
        assert len(os.listdir(f"{target}/manifest")) <= 2
    got = {r.id: (r._order, r._after.v) for r in buckets.read_buckets(spark, target).collect()}
    assert got == table
    assert max(costs) < whole / 4
    assert statistics.mean(costs[-10:]) < 1.5 * statistics.mean(costs[:10])


def test_deletions_repeats_and_unfinished_batches(spark):
    target = new_dir(spark, "buckets")

    def merge(values, batch):
        buckets.merge_batch(changes(spark, values), target, ["id"], newest, batch, 4)

    def present():
        return rows(cdc.read_bucketed_mirror(spark, target))

    with pytest.raises(FileNotFoundError):
        buckets.read_buckets(spark, target)
    merge([(1, 1, "a"), (2, 1, "b"), (3, 1, "c")], 0)
    merge([(1, 5, None), (2, 2, "B")], 1)
    merge([(1, 5, None), (2, 2, "B")], 1)
    assert present() == [(2, "B"), (3, "c")]
    merge([(1, 4, "older than its deletion"), (4, 1, "d")], 2)
    assert present() == [(2, "B"), (3, "c"), (4, "d")]
    merge([(9, 1, "lost")], 3)
    for name in os.listdir(f"{target}/manifest/batch=3"):  # as if the batch had not ended
        os.remove(f"{target}/manifest/batch=3/{name}")
    assert present() == [(2, "B"), (3, "c"), (4, "d")]
    merge([(5, 1, "e")], 3)
    assert present() == [(2, "B"), (3, "c"), (4, "d"), (5, "e")]
    merge([], 4)
    assert len(present()) == 4


def test_served_values_and_top(spark):
    target = new_dir(spark, "served")
    sink = serving_sink(target, ["ip"], top=2, by="n", buckets=8)
    for batch, values in enumerate([[("a", 3), ("b", 2), ("c", 1)], [("c", 9)], [("b", 3), ("d", 1)]]):
        for _ in range(2):  # repeated, as after a failure
            sink(spark.createDataFrame(values, "ip string, n long"), batch)
    assert rows(read_served(spark, target)) == [("a", 3), ("b", 3), ("c", 9), ("d", 1)]
    assert rows(read_top(spark, target)) == [("a", 3), ("c", 9)]


def records(spark, first, n):
    return spark.range(first, first + n).select(
        (F.col("id") * 60).cast("timestamp").alias("at"), F.md5(F.col("id").cast("string")).alias("text"))


def files(spark, target):
    return segments.manifest(spark, target).orderBy("min_at").collect()


def test_segments_roll_by_size_and_hold_ranges_of_time(spark):
    target = new_dir(spark, "segments")
    sink = segments.segment_sink(target, "at", segment_bytes=40_000)
    for batch in range(12):
        sink(records(spark, batch * 300, 300), batch)
    closed = files(spark, target)
    assert len(closed) >= 2 and all(15_000 < f.file_bytes < 80_000 for f in closed)
    assert all(a.max_at < b.min_at for a, b in zip(closed, closed[1:]))
    assert len(os.listdir(f"{target}/open")) < 12
    everything = segments.read_segments(spark, target, "at")
    assert everything.count() == 3600 == everything.distinct().count()
    sink(records(spark, 3600, 9000), 12)  # a batch of many segments
    assert len(files(spark, target)) > len(closed) + 4
    hour = segments.read_segments(spark, target, "at", "1970-01-01 05:00:00", "1970-01-01 06:00:00")
    assert hour.count() == 60
    assert len(hour.inputFiles()) < len(segments.read_segments(spark, target, "at").inputFiles()) / 2
    assert "PushedFilters: [IsNotNull(at)" in hour._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_segments_roll_by_age_merge_when_small_and_repeat(spark):
    target, now = new_dir(spark, "segments"), [0.0]
    sink = segments.segment_sink(target, "at", 20_000, "24 hours", clock=lambda: now[0])
    now[0] = 4e9  # long after any file was written: each batch closes its segment
    for batch in range(8):
        sink(records(spark, batch * 100, 100), batch)
        sink(records(spark, batch * 100, 100), batch)
        assert segments.read_segments(spark, target, "at").count() == 100 * (batch + 1)
    sizes = [f.file_bytes for f in files(spark, target)]
    assert len(sizes) < 8 and max(sizes) > 2 * min(sizes)
    now[0] = 0.0
    sink(records(spark, 800, 10), 8)  # stays open
    assert segments.read_segments(spark, target, "at").count() == 810
    segments.roll(spark, target, "at", 20_000)
    assert segments.read_segments(spark, target, "at").count() == 810
    assert segments._open_paths(spark, target, segments._upto(spark, target)) == []
    assert segments.read_segments(spark, target, "at", since="1990-01-01 00:00:00").count() == 0


def test_manifest_is_folded(spark, monkeypatch):
    monkeypatch.setattr(manifest, "FOLD_EVERY", 3)
    target = new_dir(spark, "segments")
    sink = segments.segment_sink(target, "at", 3_000)
    for batch in range(9):
        sink(records(spark, batch * 100, 100), batch)
    assert len(os.listdir(f"{target}/manifest/base")) == 1
    assert segments.read_segments(spark, target, "at").distinct().count() == 900


def test_late_rows_are_those_that_an_aggregation_drops(spark):
    source, target, counted = new_dir(spark, "in"), new_dir(spark, "late"), new_dir(spark, "counted")
    kinds = {"n": ("count", None)}
    window = F.floor(F.unix_seconds("at") / 10).alias("w")
    sink = late.split_sink(target, "at", "10 seconds", "10 seconds", forward=lambda batch, i: rollup.rollup_refresh(
        batch.select(window), counted, ["w"], kinds, i))
    plain, cp, cp_plain = (new_dir(spark, name) for name in ("plain", "cp", "cp"))
    steps = [[1, 5, 12, 31], [2, 19, 22, 40, None], [29, 30, 3, 70], [59, 60, 41]]
    for seconds in steps:
        spark.createDataFrame([(s,) for s in seconds], "s int").select(
            F.col("s").cast("timestamp").alias("at")).coalesce(1).write.mode("append").parquet(source)
        stream = parquet_stream(spark, source, schema="at timestamp")
        run_to_end(start_query(stream, "late", sink, cp))
        windows = stream.withWatermark("at", "10 seconds").groupBy(F.window("at", "10 seconds")).count()
        run_to_end(start_query(windows, "plain", batch_sink(plain), cp_plain, "update"))
    own = rows(rollup.read_rollup(spark, counted, ["w"], kinds))
    spark_counts = latest_updates(spark, plain, ["window"]).select(
        F.floor(F.unix_seconds("window.start") / 10), "count")
    assert own == rows(spark_counts)
    refused = late.split_rows(spark, target, late=True).select("batch", F.unix_seconds("at"))
    wanted = [(1, 2), (1, 19), (1, None), (2, 29), (2, 3), (3, 41), (3, 59)]
    assert rows(refused) == sorted(wanted, key=repr)
    assert rows(late.late_counts(spark, target).select("batch", "late_records")) == [(0, 0), (1, 3), (2, 2), (3, 2)]
    assert late.split_rows(spark, new_dir(spark, "none"), True, "at timestamp").count() == 0


def test_an_outbox_sends_what_its_ledger_lacks(spark):
    out, got, away = new_dir(spark, "alerts"), {"a": [], "b": []}, {("b", 0), ("b", 1)}

    def receiver(name):
        def send(df, batch_id):
            if (name, batch_id) in away:
                away.discard((name, batch_id))
                raise ConnectionError(name)
            got[name] += [(r.id, batch_id) for r in df.collect()]
        return send

    sink = alert_sink(out, "id > 1", {"b": receiver("b"), "a": receiver("a")}, parts=3)
    for batch in (0, 1):
        with pytest.raises(ConnectionError):
            sink(spark.range(9), batch)
        sink(spark.range(9), batch)
        sink(spark.range(9), batch)
    wanted = sorted((i, b) for i in range(2, 9) for b in (0, 1))
    assert sorted(got["a"]) == sorted(got["b"]) == wanted
    assert os.listdir(f"{out}/sent/a") == ["batch=1"]
    assert rows(read_batches(spark, out).select("id", "batch")) == wanted


def test_a_part_that_was_sent_is_not_sent_again(spark):
    box, sent = Outbox(new_dir(spark, "outbox"), parts=4), []

    def send(df, batch_id):
        if len(sent) == 2:
            sent.append(None)
            raise ConnectionError
        sent.append([r.id for r in df.collect()])

    with pytest.raises(ConnectionError):
        box.send(spark.range(40), 0, "x", send)
    assert box.send(spark.range(40), 0, "x", send) == 2
    assert sorted(i for part in sent if part for i in part) == list(range(40))


def test_one_failing_sink_keeps_no_other_back(spark):
    out, seen, away = new_dir(spark, "fan"), {"a": 0, "b": 0}, [True]

    def first(df, batch_id):
        if away and batch_id == 1:
            away.clear()
            raise ValueError("a")
        seen["a"] += df.count()

    def second(df, batch_id):
        seen["b"] += df.count()

    sink = fan_out_sink(out, {"a": first, "b": second})
    sink(spark.range(5), 0)
    with pytest.raises(ValueError):
        sink(spark.range(7), 1)
    assert seen == {"a": 5, "b": 12}
    sink(spark.range(7), 1)
    assert seen == {"a": 12, "b": 12}


def test_nothing_written_yet(spark):
    target = new_dir(spark, "nothing")
    for read in (read_batches, read_last_batch):
        with pytest.raises(FileNotFoundError):
            read(spark, target)
    empty = read_batches(spark, target, "id long, at timestamp")
    assert empty.count() == 0 and empty.columns == ["id", "at", "batch"]
    assert read_last_batch(spark, target, "id long").count() == 0


def test_moments_merge_exactly_over_levels_and_repeats(spark):
    rng, target = random.Random(4), new_dir(spark, "levels")
    values = [(rng.choice("ab"), rng.randint(0, 90 * 86400), rng.randint(-10**12, 10**12)) for _ in range(400)]
    values += [("c", 5, 7), ("c", 6, None)]
    aggs = {"m": ("moments", F.col("u"))}
    df = spark.createDataFrame([(k, s, u) for k, s, u in values], "k string, s long, u long").select(
        "k", F.col("s").cast("timestamp").alias("at"), "s", "u")
    for batch, part in ((0, "s % 3 = 0"), (1, "s % 3 = 1"), (1, "s % 3 = 1"), (2, "s % 3 = 2")):
        rollup.levels_refresh(df.filter(part), target, "at", ["k"], aggs, batch)
        if batch == 0:
            rollup.compact_levels(spark, target, ["k"], aggs)
    days = rollup.read_level(spark, target, "day", ["k"], aggs)
    for r in days.select(rollup.PERIOD, "k", "m.n", rollup.mean_of("m").alias("mean"),
                         rollup.deviation_of("m").alias("dev")).collect():
        own = [u for k, s, u in values if k == r.k and s // 86400 * 86400 == r.period_start and u is not None]
        assert r.n == len(own) and r.mean == pytest.approx(statistics.mean(own), rel=1e-14)
        if len(own) > 1:
            assert r.dev == pytest.approx(statistics.stdev(own), rel=1e-14)
        else:
            assert r.dev is None
    months = rollup.read_level(spark, target, "month", ["k"], aggs)
    assert {r[0] for r in months.select(rollup.PERIOD).collect()} == {0, 31 * 86400, 59 * 86400}
    assert months.agg(F.sum("m.n")).first()[0] == 401


def test_bucketed_mirror_of_a_stream_reads_without_merging(spark):
    source, target = new_dir(spark, "in"), new_dir(spark, "mirror")
    schema = "offset long, op string, before struct<id:long,v:string>, after struct<id:long,v:string>"
    sink = cdc.bucketed_mirror_sink(target, ["id"], ["offset"], buckets=4)
    cp = new_dir(spark, "cp")
    for step in ([(0, "c", None, (1, "a")), (1, "c", None, (2, "b")), (2, None, None, None)],
                 [(3, "d", (1, "a"), None), (4, "u", None, (2, "B"))]):
        spark.createDataFrame(step, schema).coalesce(1).write.mode("append").parquet(source)
        run_to_end(start_query(parquet_stream(spark, source, schema=schema), "m", sink, cp))
    mirror = cdc.read_bucketed_mirror(spark, target)
    assert rows(mirror) == [(2, "B")]
    assert "Exchange" not in plan(mirror) and "Aggregate" not in plan(mirror)


def test_a_detector_carries_on_the_users_of_a_batch_only(spark):
    """Bytes written per batch follow its users, however many there have been."""
    from tidewell.streaming import carried

    out, state = new_dir(spark, "out"), new_dir(spark, "state")
    sink = carried.anomaly_sink(out, state, buckets=32)
    schema = "id long, user_id int, amount double, created_at timestamp"

    def batch(number, users):
        rows = spark.range(len(users) * 20).select(
            (F.col("id") + number * 10**6).alias("id"),
            F.element_at(F.array(*map(F.lit, users)), (F.col("id") % len(users) + 1).cast("int")).alias("user_id"),
            (F.col("id") % 9 + 1.5).alias("amount"),
            F.timestamp_seconds(F.col("id") + number * 100_000).alias("created_at"))
        sink(spark.createDataFrame(rows.collect(), schema), number)
        return written_bytes(spark, f"{state}/users", number)

    first = batch(0, list(range(200)))
    later = [batch(number, [number, 500 + number]) for number in range(1, 6)]
    assert max(later) < first / 4
    got = read_batches(spark, out).filter("batch > 0 and user_id < 500")
    assert got.agg(F.min("history_n"), F.max("history_n")).first()[:] == (20, 39)
