"""Ingest into segments that roll by size and age, with their times in a manifest.

Layout under a target: ``open/batch=<n>`` holds the rows of micro-batches since the last roll,
``segments/batch=<n>`` the files that a roll at batch ``n`` made, and ``manifest`` one entry per
file, as deltas that are folded now and then. A segment is one file, sorted by time, of about
the size asked for, whatever the size of a micro-batch. Readers take the closed segments whose times
can match, and all open rows.

A roll counts once its part of the manifest is complete. A repeated micro-batch replaces its
own rows, and its roll replaces that one's files. The folders that a roll made needless are
removed by the next one, so that readers of the moment keep theirs.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.times import duration_micros
from tidewell.operators.deltas import complete
from tidewell.operators.manifest import commit, entries, fold_now_and_then
from tidewell.session import changed_at, folder_bytes, path_exists, remove_dir

SEGMENT_BYTES = 50 * 1024 * 1024
SEGMENT_AGE = "24 hours"

# What the manifest says of a file. ``upto`` is the last batch whose rows are in closed segments.
EXTRA = "upto long, file_rows long, file_bytes long, min_at long, max_at long"


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """One row per closed segment: ``path, commit, file_rows, file_bytes, min_at, max_at``, times
    in microseconds since 1970."""
    return _entries(spark, target).filter("path <> ''").drop("present", "upto")


def _entries(spark: SparkSession, target: str, before: int | None = None) -> DataFrame:
    return entries(spark, f"{target}/manifest", EXTRA, before)


def _upto(spark: SparkSession, target: str, before: int | None = None) -> int:
    last = _entries(spark, target, before).agg(F.max("upto")).first()[0]
    return -1 if last is None else last


def _open_paths(spark: SparkSession, target: str, upto: int) -> list[str]:
    return [f"{target}/open/batch={b}" for b in complete(spark, f"{target}/open") if b > upto]


def _write_segments(rows: DataFrame, ts: str, path: str, size: int, segment_bytes: int) -> DataFrame:
    """Writes rows in files of about ``segment_bytes`` by time; gives the files' entries."""
    n = max(1, round(size / segment_bytes))
    spark = rows.sparkSession
    ranged = rows.coalesce(1) if n == 1 else rows.repartitionByRange(n, ts)
    ranged.sortWithinPartitions(ts).write.mode("overwrite").parquet(path)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    return spark.read.parquet(path).groupBy(
        F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("file_rows"), F.max("_metadata.file_size").alias("file_bytes"),
        F.min(at).alias("min_at"), F.max(at).alias("max_at"))


def segment_sink(
    target: str,
    ts: str,
    segment_bytes: int = SEGMENT_BYTES,
    segment_age: str = SEGMENT_AGE,
    clock: Callable[[], float] = time.time,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps rows in segments of time.

    Open rows roll once their files have ``segment_bytes``, or once the first of them is
    ``segment_age`` old by ``clock``. Segments closed by age are small; when those below half a
    segment reach a segment's size together, the next roll merges them into its own, so
    each row is rewritten at most twice. ``ts`` is a time column of the rows, null in none.
    """
    age_seconds = duration_micros(segment_age) / 1e6

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mine = f"{target}/open/batch={batch_id}"
        upto = _upto(spark, target, batch_id)
        batch.write.mode("overwrite").parquet(mine)
        paths = [p for p in _open_paths(spark, target, upto)
                 if int(p.rsplit("=", 1)[1]) <= batch_id]
        size = sum(folder_bytes(spark, p) for p in paths)
        old = clock() - changed_at(spark, f"{paths[0]}/_SUCCESS") / 1000 >= age_seconds
        if size < segment_bytes and not old:
            return
        rows = spark.read.parquet(*paths)
        small = _entries(spark, target, batch_id).filter(
            (F.col("path") != "") & (F.col("file_bytes") < segment_bytes // 2))
        small_bytes = small.agg(F.sum("file_bytes")).first()[0] or 0
        gone = []
        if small_bytes >= segment_bytes:
            gone = small.select("path").toArrow()["path"].to_pylist()
            rows, size = rows.unionByName(spark.read.parquet(*gone)), size + small_bytes
        made = _write_segments(rows, ts, f"{target}/segments/batch={batch_id}", size, segment_bytes)
        mark = spark.createDataFrame([("", batch_id, *[None] * 4)], f"path string, {EXTRA}")
        added = made.withColumn("upto", F.lit(None).cast("long")).unionByName(mark)
        commit(added, gone, f"{target}/manifest", batch_id, EXTRA)
        _clean(spark, target, upto)

    return write


def _clean(spark: SparkSession, target: str, upto: int) -> None:
    """Removes open folders of earlier rolls."""
    for b in complete(spark, f"{target}/open"):
        if b <= upto:
            remove_dir(spark, f"{target}/open/batch={b}")
    fold_now_and_then(spark, f"{target}/manifest")


def roll(spark: SparkSession, target: str, ts: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Closes whatever is open and merges small segments, for a table that no stream writes to
    any more."""
    opened = complete(spark, f"{target}/open")
    if not opened:
        return
    last = opened[-1] + 1
    some = spark.read.parquet(f"{target}/open/batch={opened[-1]}").limit(0)
    segment_sink(target, ts, segment_bytes, "0 seconds")(some, last)


def read_segments(
    spark: SparkSession, target: str, ts: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Rows with ``since`` <= time < ``until`` (texts of UTC times; None: no limit).

    Only segments that can hold such rows are opened; their paths come from the manifest.
    """
    bounds = {name: None if text is None else F.lit(f"{text}+00:00").cast("timestamp")
              for name, text in (("since", since), ("until", until))}
    segments = manifest(spark, target)
    wanted = F.lit(True)
    at = F.col(ts).cast("timestamp")
    if bounds["since"] is not None:
        segments = segments.filter(F.col("max_at") >= F.unix_micros(bounds["since"]))
        wanted = wanted & (at >= bounds["since"])
    if bounds["until"] is not None:
        segments = segments.filter(F.col("min_at") < F.unix_micros(bounds["until"]))
        wanted = wanted & (at < bounds["until"])
    paths = sorted(segments.select("path").toArrow()["path"].to_pylist())
    paths += _open_paths(spark, target, _upto(spark, target))
    if not paths:
        any_part = [f"{target}/{kind}" for kind in ("segments", "open") if path_exists(spark, f"{target}/{kind}")]
        if not any_part:
            raise FileNotFoundError(f"nothing complete under {target}")
        first = complete(spark, any_part[0])[0]
        return spark.read.parquet(f"{any_part[0]}/batch={first}").limit(0)
    return spark.read.parquet(*paths).filter(wanted)
