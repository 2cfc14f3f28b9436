"""Sinks that a repeated micro-batch does not write twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.operators.buckets import BUCKETS, merge_batch, read_buckets, read_changes
from tidewell.operators.deltas import complete, write_delta
from tidewell.session import list_dirs, make_dir, path_exists, remove_dir


def batch_sink(target: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch into a folder named by its id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_delta(batch, target, batch_id)

    return write


class Outbox:
    """A ledger of what was sent where: one mark per target, batch and part.

    A mark is an empty folder that is written after a part was sent. A batch that is repeated
    sends the parts without a mark only, so a failure repeats one part of one target at most.
    """

    def __init__(self, path: str, parts: int = 1):
        self.path, self.parts = path, parts

    def _mark(self, name: str, batch_id: int, part: int) -> str:
        return f"{self.path}/{name}/batch={batch_id}/part={part}"

    def send(self, rows: DataFrame, batch_id: int, name: str,
             send: Callable[[DataFrame, int], None]) -> int:
        """Sends the parts that the ledger lacks; returns how many."""
        spark, sent = rows.sparkSession, 0
        by_hash = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(self.parts))
        for part in range(self.parts):
            mark = self._mark(name, batch_id, part)
            if not path_exists(spark, mark):
                send(rows if self.parts == 1 else rows.filter(by_hash == part), batch_id)
                make_dir(spark, mark)
                sent += 1
        return sent

    def forget(self, spark: SparkSession, before: int) -> None:
        """Removes the marks of batches before one; a stream repeats its last batch only."""
        for name in list_dirs(spark, self.path):
            for batch in list_dirs(spark, f"{self.path}/{name}"):
                if int(batch.split("=")[1]) < before:
                    remove_dir(spark, f"{self.path}/{name}/{batch}")


def alert_sink(
    target: str,
    condition: str = "true",
    forward: list[Callable[[DataFrame, int], None]] | dict[str, Callable[[DataFrame, int], None]]
    | None = None,
    parts: int = 1,
) -> Callable[[DataFrame, int], None]:
    """Writes the rows that meet ``condition``, then hands them on.

    ``forward`` functions, named or in a fixed order, get the batch as read back from the table,
    so the alerts are computed once however many systems receive them. A ledger beside the
    table says which of them have it: after a failure, the batch goes to those only that lack
    it, in ``parts`` each of which is sent once. All are tried, then the first error is raised.
    """
    named = forward if isinstance(forward, dict) else {str(i): f for i, f in enumerate(forward or [])}
    outbox = Outbox(f"{target}/sent", parts)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Also where it is there already: the batch's own state counts only once it has run.
        write_delta(batch.filter(condition), target, batch_id)
        if named:
            written = spark.read.parquet(f"{target}/delta/batch={batch_id}")
            each_once(named, lambda name, send: outbox.send(written, batch_id, name, send))
            outbox.forget(spark, batch_id)

    return write


def each_once(named: dict[str, Callable], run: Callable[[str, Callable], object]) -> None:
    """Runs all, then raises the first error, so that one that fails keeps no other back."""
    failed = None
    for name, each in named.items():
        try:
            run(name, each)
        except Exception as error:  # raised below, once the others have run
            failed = failed or error
    if failed:
        raise failed


def fan_out_sink(
    target: str, sinks: dict[str, Callable[[DataFrame, int], None]]
) -> Callable[[DataFrame, int], None]:
    """Hands each micro-batch to several sinks from one reading of the source.

    The batch is written once, in two folders in turn, and each sink reads that copy. Each
    has its own mark per batch: after a failure the batch is repeated for those without one, so a
    sink that fails neither keeps the others back nor repeats them.
    """
    outbox = Outbox(f"{target}/done")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, copy = batch.sparkSession, f"{target}/rows/{batch_id % 2}"
        batch.write.mode("overwrite").parquet(copy)
        rows = spark.read.parquet(copy)
        each_once(sinks, lambda name, sink: outbox.send(rows, batch_id, name, sink))
        outbox.forget(spark, batch_id)

    return write


def topic_records(batch: DataFrame, key: str, batch_id: int) -> DataFrame:
    """Rows as JSON records for a topic, each with the id of its batch."""
    value = F.to_json(F.struct(*batch.columns, F.lit(batch_id).alias("batch")))
    return batch.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def topic_sink(servers: str, topic: str, key: str) -> Callable[[DataFrame, int], None]:
    """Sends each micro-batch to a topic, keyed so that a key's records stay in order.

    A repeated batch is sent again. Its records carry the same batch id, by which
    a reader can tell.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            topic_records(batch, key, batch_id)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )

    return write


def read_batches(spark: SparkSession, target: str, schema: StructType | str | None = None) -> DataFrame:
    """All rows written by `batch_sink` or `alert_sink`, with their ``batch``.

    A batch that is still being written is left out. Before the first batch there are no
    rows; that needs the ``schema``, which nothing else tells.
    """
    paths = [f"{target}/delta/batch={b}" for b in complete(spark, f"{target}/delta")]
    if not paths:
        return _no_rows(spark, target, schema).withColumn("batch", F.lit(0))
    return spark.read.option("basePath", f"{target}/delta").parquet(*paths)


def _no_rows(spark: SparkSession, target: str, schema) -> DataFrame:
    if schema is None:
        raise FileNotFoundError(f"no complete batch under {target}")
    return spark.createDataFrame([], schema)


def read_last_batch(spark: SparkSession, target: str, schema: StructType | str | None = None) -> DataFrame:
    """The newest batch: in complete mode that is the whole result."""
    written = complete(spark, f"{target}/delta")
    if not written:
        return _no_rows(spark, target, schema)
    return spark.read.parquet(f"{target}/delta/batch={written[-1]}")


def latest_updates(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The final row per key of a query in update mode, which may write a key often."""
    rows = read_batches(spark, target)
    values = F.struct(*[c for c in rows.columns if c not in (*keys, "batch")])
    newest = rows.groupBy(*keys).agg(F.max_by(values, "batch").alias("_v"))
    return newest.select(*keys, "_v.*")


def serving_sink(
    target: str, keys: list[str], top: int | None = None, by: str | None = None,
    buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """Keeps the newest row per key of a query in update mode as a table in buckets.

    A batch brings the keys whose values changed, and only their buckets are rewritten. With
    ``top`` the rows largest in ``by``, equal ones by key, are kept beside it: those of the
    table before and the changed ones give the new ones. That is right for values that
    only grow, as counts and maxima do.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("long"))
        values = [c for c in rows.columns if c not in keys]

        def newest(both: DataFrame) -> DataFrame:
            row = F.max_by(F.struct(*values), "_batch").alias("_v")
            return both.groupBy(*keys).agg(row).select(*keys, "_v.*")

        merge_batch(rows, target, keys, newest, batch_id, buckets)
        if top is not None:
            changed = read_changes(spark, target)
            earlier = [b for b in complete(spark, f"{target}/top") if b < batch_id]
            if earlier:
                kept = spark.read.parquet(f"{target}/top/batch={earlier[-1]}")
                changed = newest(kept.unionByName(changed))
            order = [F.desc(by), *keys]
            changed.orderBy(*order).limit(top).coalesce(1).write.mode("overwrite").parquet(
                f"{target}/top/batch={batch_id}")
            for old in earlier[:-1]:
                remove_dir(spark, f"{target}/top/batch={old}")

    return write


def read_served(spark: SparkSession, target: str) -> DataFrame:
    """The newest row per key of `serving_sink`."""
    return read_buckets(spark, target).drop("_batch")


def read_top(spark: SparkSession, target: str) -> DataFrame:
    """The largest rows that `serving_sink` keeps, unordered."""
    written = complete(spark, f"{target}/top")
    if not written:
        raise FileNotFoundError(f"no complete batch under {target}")
    return spark.read.parquet(f"{target}/top/batch={written[-1]}").drop("_batch")
