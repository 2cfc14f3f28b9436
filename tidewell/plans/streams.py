"""Streaming queries over the events table, read as a stream of files."""

from __future__ import annotations

import functools
import os

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.numbers import money
from tidewell.plans.detection import FLOOR, FRAME, HIGH_VALUE
from tidewell.plans.tables import as_double, instant, table
from tidewell.session import new_dir
from tidewell.sources.files import in_order_of, parquet_stream
from tidewell.sources.ids import assign_ids
from tidewell.sources.topics import as_records
from tidewell.streaming import agents, carried, late, logs, segments, sliced
from tidewell.streaming.runner import (
    ProgressLog,
    late_data_report,
    run_agents,
    run_to_end,
    scratch,
    start_query,
    stream_progress,
)
from tidewell.streaming.sinks import (
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


def events_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of several micro-batches in order of time."""
    return in_order_of(table(spark, sf_dir, "events"), "ts", new_dir(spark, "events-in-order"))


def log_records(events: DataFrame) -> DataFrame:
    """The events as JSON log records in the shape of a topic."""
    user = F.col("user_id")
    value = F.to_json(F.struct(
        F.unix_millis(F.col("ts")).alias("timestamp"),
        F.col("event_type").alias("status"),
        F.expr(
            "CASE WHEN value >= 20 THEN 'High' WHEN value >= 5 THEN 'Critical' ELSE 'Low' END"
        ).alias("severity"),
        F.format_string(
            "10.0.%d.%d", F.floor(user / 256).cast("int"), F.pmod(user, F.lit(256)).cast("int")
        ).alias("source_ip"),
        F.format_string("user_%d", user).alias("user_id"),
        F.concat(F.initcap("event_type"), F.lit(" reported "), F.col("props")).alias("content"),
    ))
    return as_records(events, "logs", user, value, F.col("event_id"))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse_logs(log_records(events_in_order(spark, sf_dir)))


def log_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoints = scratch(spark, "log-counts")
    counts = logs.log_counts(_logs(spark, sf_dir), term="error", ordered=False)
    run_to_end(start_query(counts, "log_counts", batch_sink(out), checkpoints, "complete"))
    return read_last_batch(spark, out).orderBy(F.desc("match_count"), "source_ip")


def log_counts_sorted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that the stream itself sorts, with each row's place in its last output."""
    out, checkpoints = scratch(spark, "log-counts-sorted")

    def placed(batch: DataFrame, batch_id: int) -> None:
        batch_sink(out)(assign_ids(batch, "place"), batch_id)

    counts = logs.log_counts(_logs(spark, sf_dir), term="error")
    run_to_end(start_query(counts, "log_counts_sorted", placed, checkpoints, "complete"))
    return read_last_batch(spark, out)


def log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts over a finished table: one function serves both."""
    return logs.log_counts(
        logs.parse_logs(log_records(table(spark, sf_dir, "events"))), term="error"
    )


def _crashes(spark: SparkSession, sf_dir: str, mode: str) -> str:
    out, checkpoints = scratch(spark, f"crash-{mode}")
    monitored = logs.crash_monitor(_logs(spark, sf_dir), term="error", window="1 day")
    run_to_end(start_query(monitored, "crash_monitor", batch_sink(out), checkpoints, mode))
    return out


def _window_as_text(df: DataFrame) -> DataFrame:
    """Window bounds in epoch seconds, which do not depend on the session's zone."""
    return df.withColumns({
        c: F.unix_seconds(F.col(c)) for c in ("window_start", "window_end")
    })


def crash_monitor_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _crashes(spark, sf_dir, "update")
    keys = ["window_start", "window_end", "user_id"]
    return _window_as_text(latest_updates(spark, out, keys))


def crash_monitor_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _crashes(spark, sf_dir, "append")
    return _window_as_text(read_batches(spark, out).drop("batch"))


def temp_window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoints = scratch(spark, "window-avg")
    means = logs.window_avg(
        events_in_order(spark, sf_dir), "ts", money(F.col("value")), ["event_type"],
        watermark="1 hour",
    )
    run_to_end(start_query(means, "window_avg", batch_sink(out), checkpoints, "update"))
    final = latest_updates(spark, out, ["window_start", "window_end", "event_type"])
    return _window_as_text(as_double(final, "avg_value"))


def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups of the first days reach the topic after everything else.

    The whole table arrives in three steps; the query is stopped and resumed
    from its checkpoint between them.
    """
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < instant("2024-01-11 00:00:00")
    held_back = early & (F.col("event_type") == "signup")
    arrivals, (out, checkpoints) = new_dir(spark, "arrivals"), scratch(spark, "late")
    report = None
    for step, rows in enumerate([early & ~held_back, ~early, held_back]):
        events.filter(rows).write.mode("append").parquet(arrivals)
        arriving = parquet_stream(spark, arrivals, schema=events.schema)
        monitored = logs.crash_monitor(
            logs.parse_logs(log_records(arriving)), term="reported",
            severities=("High", "Critical", "Low"), window="1 day",
        )
        query = start_query(monitored, "late", batch_sink(out), checkpoints, "update")
        seen = late_data_report(run_to_end(query)).agg(
            F.sum("input_rows").alias("input_rows"),
            F.sum("late_rows_dropped").alias("late_groups_dropped"),
        ).withColumn("step", F.lit(step))
        report = seen if report is None else report.unionByName(seen)
    return report


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, checkpoints = scratch(spark, "ingest")
    records = log_records(events_in_order(spark, sf_dir))
    run_to_end(logs.ingest_logs(records, target, checkpoints, lower_content=True))
    return spark.read.parquet(target).drop("event_date")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth record is cut short: those are kept as they came."""
    target, checkpoints = scratch(spark, "quarantine")
    records = log_records(events_in_order(spark, sf_dir))
    text = F.col("value").cast("string")
    cut = F.when(F.col("offset") % 10 == 0, F.substring(text, 1, 20)).otherwise(text)
    broken = records.withColumn("value", cut.cast("binary"))
    run_to_end(logs.quarantine_logs(broken, target, checkpoints))
    return spark.read.parquet(target).select(
        "offset", F.col("value").cast("string").alias("record"))


def _anomalies(sdf: DataFrame) -> DataFrame:
    return agents.anomaly_stream(sdf, "user_id", "value", "ts", "event_id", floor=FLOOR)


def _velocities(sdf: DataFrame) -> DataFrame:
    return agents.velocity_stream(
        sdf, "user_id", "value", "ts", "event_id", FRAME, high_amount=HIGH_VALUE
    )


def _judged(spark: SparkSession, sf_dir: str, agent, name: str) -> DataFrame:
    out, checkpoints = scratch(spark, name)
    events = events_in_order(spark, sf_dir)
    run_to_end(start_query(agent(events), name, batch_sink(out), checkpoints))
    return read_batches(spark, out).drop("batch", "ts")


def anomaly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, _anomalies, "anomaly")


def velocity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, _velocities, "velocity")


def _carried(spark: SparkSession, sf_dir: str, sink_of, name: str) -> DataFrame:
    out, checkpoints = scratch(spark, name)
    events = events_in_order(spark, sf_dir)
    run_to_end(start_query(events, name, sink_of(out, f"{checkpoints}/rows"), checkpoints))
    return read_batches(spark, out).drop("batch", "ts", "value")


def anomaly_stream_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same judgements by the batch operator, in micro-batches as large as the cluster."""

    def sink_of(out: str, state: str):
        return carried.anomaly_sink(
            out, state, "user_id", "value", "ts", "event_id", buckets=16, floor=FLOOR)

    return _carried(spark, sf_dir, sink_of, "anomaly-carried")


def velocity_stream_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sink_of(out: str, state: str):
        return carried.velocity_sink(
            out, state, "user_id", "value", "ts", "event_id", FRAME, high_amount=HIGH_VALUE
        )

    return _carried(spark, sf_dir, sink_of, "velocity-carried")


def agents_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both detectors on one stream, each writing only its alerts."""
    out, checkpoints = scratch(spark, "agents")
    rules = {"anomaly": (_anomalies, "is_anomaly"), "velocity": (_velocities, "is_alert")}
    queries = run_agents(
        events_in_order(spark, sf_dir),
        {name: agent for name, (agent, _) in rules.items()},
        {name: alert_sink(f"{out}/{name}", flag) for name, (_, flag) in rules.items()},
        checkpoints,
    )
    for query in queries.values():
        run_to_end(query)
    alerts = [
        read_batches(spark, f"{out}/{name}").select(F.lit(name).alias("agent"), "event_id")
        for name in rules
    ]
    return functools.reduce(DataFrame.unionByName, alerts)


def alerts_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts written once and forwarded to a second table."""
    out, checkpoints = scratch(spark, "alerts")
    forwarded = new_dir(spark, "alerts-forwarded")
    sink = alert_sink(out, "is_anomaly", [batch_sink(forwarded)])
    events = events_in_order(spark, sf_dir)
    run_to_end(start_query(_anomalies(events), "alerts", sink, checkpoints))
    return read_batches(spark, forwarded).select("event_id", "user_id", "history_n")


def _with_hot_user(events: DataFrame) -> DataFrame:
    """Half of the events are those of one user."""
    hot = F.col("event_id") % 2 == 0
    return events.withColumn("user_id", F.when(hot, F.lit(-1).cast("long")).otherwise(F.col("user_id")))


def _judged_sliced(spark: SparkSession, sf_dir: str, agent, name: str) -> DataFrame:
    return _judged(spark, sf_dir, lambda events: agent(_with_hot_user(events)), name)


def anomaly_stream_hot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows are one user's, whose slices are many tasks' work."""
    return _judged_sliced(spark, sf_dir, lambda events: sliced.anomaly_sliced(
        events, "user_id", "value", "ts", "event_id", "6 hours", floor=FLOOR), "anomaly-hot")


def velocity_stream_hot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged_sliced(spark, sf_dir, lambda events: sliced.velocity_sliced(
        events, "user_id", "value", "ts", "event_id", "6 hours", FRAME, high_amount=HIGH_VALUE),
        "velocity-hot")


def _served_counts(spark: SparkSession, sf_dir: str) -> str:
    out, checkpoints = scratch(spark, "log-counts-served")
    counts = logs.log_counts(_logs(spark, sf_dir), term="error", ordered=False)
    sink = serving_sink(out, ["source_ip"], top=10, by="match_count", buckets=16)
    run_to_end(start_query(counts, "log_counts_served", sink, checkpoints, "update"))
    return out


def log_counts_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts as a table to which each micro-batch brings the keys that it changed."""
    return read_served(spark, _served_counts(spark, sf_dir))


def log_counts_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most frequent keys, kept from batch to batch without the whole table."""
    return read_top(spark, _served_counts(spark, sf_dir))


def _arrivals(spark: SparkSession, sf_dir: str):
    """The events in three steps, of which the last brings sign-ups of the first days."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < instant("2024-01-11 00:00:00")
    held_back = early & (F.col("event_type") == "signup")
    arrivals = new_dir(spark, "arrivals")
    for rows in (early & ~held_back, ~early, held_back):
        events.filter(rows).write.mode("append").parquet(arrivals)
        yield parquet_stream(spark, arrivals, schema=events.schema)


def late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late sign-ups themselves, split off before the counting of days."""
    out, checkpoints = scratch(spark, "late-records")
    sink = late.split_sink(out, "ts", "10 seconds", window="1 day")
    for arriving in _arrivals(spark, sf_dir):
        run_to_end(start_query(arriving, "late_records", sink, checkpoints))
    return late.split_rows(spark, out, late=True).drop("batch", "ts")


def late_record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoints = scratch(spark, "late-counts")
    sink = late.split_sink(out, "ts", "10 seconds", window="1 day")
    for arriving in _arrivals(spark, sf_dir):
        run_to_end(start_query(arriving, "late_counts", sink, checkpoints))
    return late.late_counts(spark, out).select(F.col("batch").cast("long").alias("step"), "records", "late_records")


SEGMENT_BYTES, SINCE, UNTIL = 1 << 18, "2024-01-10 00:00:00", "2024-01-20 00:00:00"


def _segments(spark: SparkSession, sf_dir: str) -> str:
    target, checkpoints = scratch(spark, "segments")
    records = log_records(events_in_order(spark, sf_dir))
    run_to_end(logs.ingest_segments(
        records, target, checkpoints, lower_content=True, segment_bytes=SEGMENT_BYTES))
    return target


def _in_days(spark: SparkSession, target: str) -> DataFrame:
    rows = segments.read_segments(spark, target, "event_time", SINCE, UNTIL)
    return rows.drop("event_time")


def ingest_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten days of the ingested records, from closed segments and what is open."""
    return _in_days(spark, _segments(spark, sf_dir))


def ingest_segments_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same once all is closed and small segments are merged."""
    target = _segments(spark, sf_dir)
    segments.roll(spark, target, "event_time", SEGMENT_BYTES)
    return _in_days(spark, target)


def agents_from_one_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both carried detectors on one reading of the stream, each with its own mark per batch."""
    out, checkpoints = scratch(spark, "fan-out")
    columns = ("user_id", "value", "ts", "event_id")
    sinks = {
        "anomaly": carried.anomaly_sink(
            f"{out}/anomaly", f"{out}/anomaly-state", *columns, buckets=16, floor=FLOOR),
        "velocity": carried.velocity_sink(
            f"{out}/velocity", f"{out}/velocity-state", *columns, FRAME, high_amount=HIGH_VALUE),
    }
    run_to_end(start_query(
        events_in_order(spark, sf_dir), "fan_out", fan_out_sink(out, sinks), checkpoints))
    flags = {"anomaly": "is_anomaly", "velocity": "is_alert"}
    alerts = [
        read_batches(spark, f"{out}/{name}").filter(flag).select(
            F.lit(name).alias("agent"), "event_id")
        for name, flag in flags.items()
    ]
    return functools.reduce(DataFrame.unionByName, alerts)


def alert_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts to two receivers that keep all they get, of which one fails in every batch at
    first. The query is resumed until it ends; each alert arrives once at each."""
    out, checkpoints = scratch(spark, "outbox")
    arrived, failed = new_dir(spark, "arrived"), set()

    def receive(name: str):
        def send(rows: DataFrame, batch_id: int) -> None:
            if name == "second" and batch_id not in failed:
                failed.add(batch_id)
                raise ConnectionError(f"receiver of batch {batch_id} is away")
            rows.write.mode("append").parquet(f"{arrived}/{name}")
        return send

    sink = alert_sink(out, "is_anomaly", {n: receive(n) for n in ("first", "second")})
    events = events_in_order(spark, sf_dir)
    ended = False
    while not ended:
        known = len(failed)
        query = start_query(_anomalies(events), "outbox", sink, checkpoints)
        try:
            run_to_end(query)
            ended = True
        except StreamingQueryException as error:
            # One failure per batch, however many batches the table's slices make.
            if "is away" not in str(error) or len(failed) == known:
                raise
    return functools.reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{arrived}/{name}").select(F.lit(name).alias("receiver"), "event_id")
        for name in ("first", "second")])


def polling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of ten minutes by a query that looks for new rows at an interval until stopped."""
    out, checkpoints = scratch(spark, "polling")
    means = logs.window_avg(
        events_in_order(spark, sf_dir), "ts", money(F.col("value")), ["event_type"],
        watermark="1 hour",
    )
    query = start_query(means, "polling", batch_sink(out), checkpoints, "update", "1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    final = latest_updates(spark, out, ["window_start", "window_end", "event_type"])
    return _window_as_text(as_double(final, "avg_value"))


def console_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a query into the console reads and holds, by its reports."""
    _, checkpoints = scratch(spark, "console")
    counts = logs.log_counts(_logs(spark, sf_dir), term="error", ordered=False)
    name = f"console-{os.path.basename(os.path.dirname(checkpoints))}"
    reports = ProgressLog(spark, name, f"{checkpoints}/reports")
    run_to_end(start_query(counts, name, "console", checkpoints, "complete", options={"numRows": "5"}))
    totals = stream_progress(reports).agg(
        F.sum("input_rows").alias("input_rows"), F.max("state_rows").alias("state_rows"))
    reports.close()
    return totals


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over the progress reports; the rates in them differ from run to run."""
    out, checkpoints = scratch(spark, "progress")
    counts = logs.log_counts(_logs(spark, sf_dir), term="error", ordered=False)
    name = f"progress-{os.path.basename(os.path.dirname(out))}"
    reports = ProgressLog(spark, name, f"{checkpoints}/reports", every=2)
    run_to_end(start_query(counts, name, batch_sink(out), checkpoints, "complete"))
    totals = stream_progress(reports).agg(
        F.sum("input_rows").alias("input_rows"), F.max("state_rows").alias("state_rows")
    )
    reports.close()
    return totals


QUERIES = {
    "log_counts": log_counts,
    "log_counts_stream": log_counts_stream,
    "log_counts_sorted_stream": log_counts_sorted_stream,
    "crash_monitor_update": crash_monitor_update,
    "crash_monitor_append": crash_monitor_append,
    "temp_window_avg": temp_window_avg,
    "late_data_report": late_data,
    "ingest_logs": ingest,
    "quarantine_logs": quarantine,
    "anomaly_stream": anomaly_stream,
    "velocity_stream": velocity_stream,
    "anomaly_stream_carried": anomaly_stream_carried,
    "velocity_stream_carried": velocity_stream_carried,
    "run_agents": agents_together,
    "alert_sink": alerts_only,
    "stream_progress": progress,
    "anomaly_stream_hot_user": anomaly_stream_hot_user,
    "velocity_stream_hot_user": velocity_stream_hot_user,
    "log_counts_served": log_counts_served,
    "log_counts_top": log_counts_top,
    "late_records": late_records,
    "late_record_counts": late_record_counts,
    "ingest_segments": ingest_segments,
    "ingest_segments_merged": ingest_segments_merged,
    "agents_from_one_read": agents_from_one_read,
    "alert_outbox": alert_outbox,
    "polling_avg": polling_avg,
    "console_counts": console_counts,
}

_IP = "'10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)"
_SEVERITY = "CASE WHEN value >= 20 THEN 'High' WHEN value >= 5 THEN 'Critical' ELSE 'Low' END"
_LOG_COUNTS = f"""
    SELECT {_IP} AS source_ip, count(*) AS match_count FROM events
    WHERE event_type = 'error' AND value >= 20
    GROUP BY source_ip ORDER BY match_count DESC, source_ip"""
_CRASHES = """
    SELECT day * 86400 AS window_start, (day + 1) * 86400 AS window_end, user_id, crash_count
    FROM (SELECT epoch_us(ts) // 1000 // 86400000 AS day, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
                 count(*) AS crash_count
          FROM events WHERE event_type = 'error' AND value >= 5 GROUP BY 1, 2)
    WHERE crash_count > 2"""
_ANOMALIES = """
    SELECT user_id, event_id, n AS history_n,
           CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / 100.0 / n END AS history_avg,
           coalesce(n >= 3 AND u * n > 3 * s AND u > 10000, false) AS is_anomaly
    FROM (SELECT user_id, event_id, u, count(*) OVER h AS n, sum(u) OVER h AS s
          FROM (SELECT *, CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS HUGEINT) AS u FROM events)
          WINDOW h AS (PARTITION BY user_id ORDER BY ts, event_id
                       ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING))"""
_VELOCITY = """
    SELECT user_id, event_id, velocity, CAST(score AS INTEGER) AS score, score > 70 AS is_alert
    FROM (SELECT *, CASE WHEN velocity > 5 THEN 40 ELSE 0 END
                    + CASE WHEN CAST(value AS DECIMAL(18, 2)) > 150 THEN 50 ELSE 0 END AS score
          FROM (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY ts
                    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS velocity
                FROM events))"""

_HOT = "(SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN -1 ELSE user_id END AS user_id) FROM events)"
_AGENTS = f"""
        SELECT 'anomaly' AS agent, event_id FROM ({_ANOMALIES}) WHERE is_anomaly
        UNION ALL
        SELECT 'velocity', event_id FROM ({_VELOCITY}) WHERE is_alert"""
_WINDOW_AVG = """
        SELECT w * 600 AS window_start, (w + 1) * 600 AS window_end, event_type,
               CAST((2 * sum(u) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_value
        FROM (SELECT *, epoch_us(ts) // 600000000 AS w,
                     CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS BIGINT) AS u FROM events)
        GROUP BY w, event_type"""
_INGESTED = f"""
        SELECT epoch_us(ts) // 1000 AS "timestamp", event_type AS status, {_SEVERITY} AS severity,
               {_IP} AS source_ip, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
               upper(event_type[1]) || event_type[2:] || ' reported ' || props AS content,
               event_type || ' reported ' || lower(props) AS content_lower
        FROM events"""
_INGESTED_DAYS = f"{_INGESTED} WHERE ts >= TIMESTAMP '{SINCE}' AND ts < TIMESTAMP '{UNTIL}'"
_PROGRESS = f"""
        SELECT (SELECT count(*) FROM events) AS input_rows,
               (SELECT count(*) FROM ({_LOG_COUNTS})) AS state_rows"""

ORACLE = {
    "anomaly_stream_hot_user": _ANOMALIES.replace("FROM events", f"FROM {_HOT}"),
    "velocity_stream_hot_user": _VELOCITY.replace("FROM events", f"FROM {_HOT}"),
    "log_counts_served": _LOG_COUNTS,
    "log_counts_top": f"{_LOG_COUNTS} LIMIT 10",
    "late_records": """
        SELECT event_id, user_id, event_type, value, props FROM events
        WHERE ts < TIMESTAMP '2024-01-11' AND event_type = 'signup'""",
    "late_record_counts": """
        SELECT CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN 1
                    WHEN event_type = 'signup' THEN 2 ELSE 0 END AS step, count(*) AS records,
               count(*) FILTER (ts < TIMESTAMP '2024-01-11' AND event_type = 'signup') AS late_records
        FROM events GROUP BY 1""",
    "ingest_segments": _INGESTED_DAYS,
    "ingest_segments_merged": _INGESTED_DAYS,
    "agents_from_one_read": _AGENTS,
    "alert_outbox": f"""
        SELECT receiver, event_id FROM ({_ANOMALIES}), (VALUES ('first'), ('second')) r(receiver)
        WHERE is_anomaly""",
    "polling_avg": _WINDOW_AVG,
    "console_counts": _PROGRESS,
    "log_counts": _LOG_COUNTS,
    "log_counts_stream": _LOG_COUNTS,
    "log_counts_sorted_stream": f"""
        SELECT *, row_number() OVER (ORDER BY match_count DESC, source_ip) AS place
        FROM ({_LOG_COUNTS})""",
    "crash_monitor_update": _CRASHES,
    "crash_monitor_append": f"""
        SELECT * FROM ({_CRASHES})
        WHERE window_end * 1000 <= (SELECT max(epoch_us(ts) // 1000) - 10000 FROM events
                                    WHERE event_type = 'error' AND value >= 5)""",
    "temp_window_avg": _WINDOW_AVG,
    "late_data_report": """
        SELECT CASE WHEN ts >= TIMESTAMP '2024-01-11' THEN 1
                    WHEN event_type = 'signup' THEN 2 ELSE 0 END AS step,
               CAST(count(*) AS BIGINT) AS input_rows,
               CAST(count(DISTINCT CASE
                   WHEN ts < TIMESTAMP '2024-01-11' AND event_type = 'signup'
                   THEN user_id * 1000 + epoch_us(ts) // 1000 // 86400000 % 1000 END) AS BIGINT)
                   AS late_groups_dropped
        FROM events GROUP BY 1""",
    "ingest_logs": _INGESTED,
    "quarantine_logs": """
        SELECT event_id AS "offset",
               substr('{"timestamp":' || CAST(epoch_us(ts) // 1000 AS VARCHAR), 1, 20) AS record
        FROM events WHERE event_id % 10 = 0""",
    "anomaly_stream": _ANOMALIES,
    "velocity_stream": _VELOCITY,
    "anomaly_stream_carried": _ANOMALIES,
    "velocity_stream_carried": _VELOCITY,
    "run_agents": _AGENTS,
    "alert_sink": f"""
        SELECT event_id, user_id, history_n FROM ({_ANOMALIES}) WHERE is_anomaly""",
    "stream_progress": _PROGRESS,
}
