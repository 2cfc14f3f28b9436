"""The detectors over large micro-batches, for replays and for users without limit.

`tidewell.streaming.agents` answers within a small micro-batch and keeps state per
user, but one user's rows of a micro-batch meet in one task. Here each micro-batch
is judged by the batch operators, which cut large users into pieces, and the rows
that later ones can still depend on are carried over in a table. A micro-batch
may then be as large as the cluster can handle, whoever its rows belong to. Rows
are judged in order of their times among the rows known by then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import rules
from tidewell.functions.times import duration_micros, micros
from tidewell.operators.buckets import BUCKETS, merge_batch, read_of_keys
from tidewell.operators.deltas import write_delta
from tidewell.operators.detect import anomaly_batch, velocity_batch
from tidewell.session import path_exists, remove_dir

Step = Callable[[DataFrame], DataFrame]


def carrying_sink(
    target: str, state: str, columns: list[str], judge: Step, carry: Step
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: judge each batch with what was carried to it.

    The table under ``state`` has one folder per batch with all rows to carry on,
    and a batch reads that of the batch before it. So a repeated batch starts from the
    same state and replaces its own results. Older folders are removed, so the storage
    stays that of two batches, however long the stream.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Several passes follow; written once, the source is read and decoded once.
        # Two folders in turn, so that no reader of the last one is disturbed.
        copy = f"{state}/rows/{batch_id % 2}"
        batch.select(*columns).write.mode("overwrite").parquet(copy)
        rows = spark.read.parquet(copy).withColumn("_new", F.lit(True))
        last = f"{state}/delta/batch={batch_id - 1}"
        if path_exists(spark, f"{last}/_SUCCESS"):
            carried = spark.read.parquet(last)
            rows = rows.unionByName(carried.withColumn("_new", F.lit(False)))
        write_delta(judge(rows).filter("_new").drop("_new"), target, batch_id)
        write_delta(carry(rows).drop("_new"), state, batch_id)
        remove_dir(spark, f"{state}/delta/batch={batch_id - 2}")

    return write


def anomaly_sink(
    target: str,
    state: str,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    history: int = rules.HISTORY,
    buckets: int = BUCKETS,
    **rule,
) -> Callable[[DataFrame, int], None]:
    """`anomaly_batch` on a stream; ``rule`` are its other options.

    Carried on are each user's last ``history`` rows, in buckets of users. A batch reads those of
    its own users and rewrites their buckets; other users', however many there have ever
    been, are not touched. Spark finds the last rows per task before the shuffle, so a user of
    many rows sends few. ``buckets`` stays for the life of the state.
    """
    columns = [user, id_col, ts, amount]
    last = Window.partitionBy(user).orderBy(F.desc(ts), F.desc(id_col))

    def carry(rows: DataFrame) -> DataFrame:
        ranked = rows.select(*columns).withColumn("_last", F.row_number().over(last))
        return ranked.filter(F.col("_last") <= history).drop("_last")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        copy = f"{state}/rows/{batch_id % 2}"
        batch.select(*columns).write.mode("overwrite").parquet(copy)
        new = spark.read.parquet(copy)
        held = read_of_keys(new, f"{state}/users", [user], batch_id, buckets)
        rows = new.withColumn("_new", F.lit(True))
        if held is not None:
            rows = rows.unionByName(held.select(*columns, F.lit(False).alias("_new")))
        judged = anomaly_batch(rows, user, amount, (ts, id_col), history, **rule)
        write_delta(judged.filter("_new").drop("_new"), target, batch_id)
        merge_batch(new, f"{state}/users", [user], carry, batch_id, buckets)

    return write


def velocity_sink(
    target: str,
    state: str,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    window: str = rules.WINDOW,
    delay: str = "10 minutes",
    **rule,
) -> Callable[[DataFrame, int], None]:
    """`velocity_batch` on a stream; ``rule`` are its other options.

    Carried on are the rows from ``window`` and ``delay`` before the middle time of the
    newest batch. The middle one, because a few rows with wrong times can't move it, so they
    can't discard what other users' rows need. Rows that arrive later than ``delay``
    behind it are judged too, but may miss some of the rows before them.
    """
    reach = duration_micros(window) + duration_micros(delay)

    def carry(rows: DataFrame) -> DataFrame:
        at = micros(F.col(ts))
        middle = rows.filter("_new").agg(F.percentile_approx(at, 0.5)).first()[0]
        return rows if middle is None else rows.filter(at >= middle - reach)

    def judge(rows: DataFrame) -> DataFrame:
        return velocity_batch(rows, user, amount, ts, id_col, window, **rule)

    return carrying_sink(target, state, [user, id_col, ts, amount], judge, carry)
