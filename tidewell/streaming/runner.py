"""Starting queries, running several on one stream, and reading their progress."""

from __future__ import annotations

import json
import os
import threading
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidewell.session import new_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the start of one query, which keeps its own copy."""
    earlier = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in earlier.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


STATE_PARTITIONS = 64  # at most, unless a query is given its own number


def state_partitions(spark: SparkSession) -> int:
    """Partitions for a query's state, fixed in its checkpoint at the first start.

    The session's setting up to STATE_PARTITIONS, since each one commits its state in
    every micro-batch; the cores that happen to be there at the first start don't count.
    Give `start_query` the number that a large stream will need.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), STATE_PARTITIONS)


def start_query(
    sdf: DataFrame,
    name: str,
    sink: str | Callable[[DataFrame, int], None],
    checkpoint_root: str,
    mode: str = "append",
    trigger: str | None = None,
    path: str | None = None,
    partition_by: list[str] | None = None,
    options: dict[str, str] | None = None,
    partitions: int | None = None,
    no_data_batches: bool = True,
) -> StreamingQuery:
    """Starts a query that resumes from ``checkpoint_root/name``.

    ``sink`` is a ``foreachBatch`` function or a format such as ``console`` or
    ``parquet``. ``trigger`` is an interval such as ``10 minutes``; without it
    the query handles what is there, in bounded batches, and ends. State is kept
    in RocksDB, so it may outgrow an executor's memory. Without
    ``no_data_batches`` nothing is done between arrivals, such as reporting
    windows that the last records have completed.
    """
    spark = sdf.sparkSession
    writer = sdf.writeStream.queryName(name).outputMode(mode)
    writer = writer.option("checkpointLocation", os.path.join(checkpoint_root, name))
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        writer = writer.format(sink)
        if sink == "console":
            writer = writer.option("truncate", "false")
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(partitions or state_partitions(spark)),
        "spark.sql.streaming.noDataMicroBatches.enabled": str(no_data_batches).lower(),
    }
    with _settings(spark, settings):
        return writer.start(path) if path else writer.start()


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Waits for a query without an interval; raises if it failed."""
    query.awaitTermination()
    return query


def run_agents(
    sdf: DataFrame,
    agents: dict[str, Callable[[DataFrame], DataFrame]],
    sinks: dict[str, str | Callable[[DataFrame, int], None]],
    checkpoint_root: str,
    trigger: str | None = None,
    mode: str = "append",
) -> dict[str, StreamingQuery]:
    """One query per agent. Each has its own checkpoint, so each sees every record."""
    return {
        name: start_query(agent(sdf), name, sinks[name], checkpoint_root, mode, trigger)
        for name, agent in agents.items()
    }


PROGRESS_SCHEMA = (
    "run_id string, batch_id long, timestamp string, batch_ms long, input_rows long,"
    " input_rows_per_second double, processed_rows_per_second double,"
    " state_rows long, state_bytes long, late_rows_dropped long, watermark string"
)


class ProgressLog(StreamingQueryListener):
    """Keeps every progress report of the queries of some name in a table.

    A query itself remembers only its last hundred reports. Reports are written ``every``
    so many, and what is left when they are read.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, every: int = 100):
        self.spark, self.name, self.path, self.every = spark, name, path, every
        self._held: list[tuple] = []
        self._lock = threading.RLock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        if report.get("name") == self.name:
            with self._lock:
                self._held.append(_report_row(report))
                if len(self._held) >= self.every:
                    self._flush()

    def _flush(self) -> None:
        with self._lock:
            rows, self._held = self._held, []
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode(
                "append").parquet(self.path)

    def read(self) -> DataFrame:
        """All reports so far. Spark delivers them behind the query, so this waits for it."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        self._flush()
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.path).distinct()

    def close(self) -> None:
        self.spark.streams.removeListener(self)


def _report_row(report: dict) -> tuple:
    state = report.get("stateOperators") or []
    return (
        report["runId"], int(report["batchId"]),
        report["timestamp"],
        int(report.get("batchDuration") or 0),
        int(report.get("numInputRows") or 0),
        _number(report.get("inputRowsPerSecond")),
        _number(report.get("processedRowsPerSecond")),
        sum(int(s["numRowsTotal"]) for s in state),
        sum(int(s["memoryUsedBytes"]) for s in state),
        sum(int(s["numRowsDroppedByWatermark"]) for s in state),
        (report.get("eventTime") or {}).get("watermark"),
    )


def stream_progress(reports: StreamingQuery | ProgressLog) -> DataFrame:
    """Per micro-batch: input against processing rate, state size and late rows.

    Of a `ProgressLog` all reports. Of a query those that it still has, and if Spark has
    dropped some, an error rather than a part.
    """
    if isinstance(reports, ProgressLog):
        return reports.read()
    spark = SparkSession.active()
    recent = reports.recentProgress
    kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(recent) >= kept - 1:  # Spark drops one as soon as it has that many
        raise ValueError(f"only the last {len(recent)} reports are there; use a ProgressLog")
    return spark.createDataFrame(
        [_report_row(json.loads(report.json)) for report in recent], PROGRESS_SCHEMA)


def _number(value) -> float | None:
    return None if value is None else float(value)


def late_data_report(query: StreamingQuery | ProgressLog) -> DataFrame:
    """Per micro-batch that read rows or dropped late ones: how many, and the watermark.

    Spark counts the dropped rows behind its partial aggregation, so for an
    aggregating query these are late groups, not late records.
    """
    progress = stream_progress(query)
    return progress.filter("input_rows > 0 OR late_rows_dropped > 0").select(
        "batch_id", "input_rows", "late_rows_dropped", "watermark"
    )


def scratch(spark: SparkSession, label: str) -> tuple[str, str]:
    """A fresh output folder and checkpoint root in the shared folder."""
    root = new_dir(spark, label)
    return os.path.join(root, "out"), os.path.join(root, "checkpoints")
