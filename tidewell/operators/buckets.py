"""Tables in buckets of keys, of which a batch rewrites only those that it touches.

Layout under a target: ``changes/batch=<n>`` holds the rows of the newest batches,
``data/batch=<n>/bucket=<k>`` the buckets that batch ``n`` wrote, and
``manifest/batch=<n>`` says for every bucket which batch wrote it last. Files are never
changed. A batch counts once its manifest is complete, so a reader sees the table of one
batch or of the next, and a batch that is repeated starts from the one before it.

The work of a batch is that of its own rows and of the buckets that their keys fall into. The
number of buckets is fixed with the first batch; choose it so that a bucket of the finished
table is a few hundred megabytes at most.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.deltas import complete
from tidewell.session import list_dirs, remove_dir

BUCKETS = 256
KEPT = 2  # manifests that stay, the newest and what a slow reader may still use
BUCKET = "_bucket"

Merge = Callable[[DataFrame], DataFrame]


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, target: str, before: int | None = None) -> dict[int, int]:
    """The batch that wrote each bucket, by the newest complete manifest before a batch."""
    done = [b for b in complete(spark, f"{target}/manifest") if before is None or b < before]
    if not done:
        return {}
    rows = spark.read.parquet(f"{target}/manifest/batch={done[-1]}").toArrow()
    return dict(zip(rows["bucket"].to_pylist(), rows["batch"].to_pylist(), strict=True))


def _paths(target: str, manifest: dict[int, int]) -> list[str]:
    return [f"{target}/data/batch={b}/{BUCKET}={k}" for k, b in sorted(manifest.items())]


def merge_batch(
    rows: DataFrame, target: str, keys: list[str], merge: Merge, batch_id: int,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merges a batch into the table at ``target``; returns the buckets it rewrote.

    ``merge`` reduces rows of old and new by key and must give the columns that it gets, in
    any order of rows. The batch is reduced by it first.
    """
    spark = rows.sparkSession
    changes = f"{target}/changes/batch={batch_id}"
    reduced = merge(rows)
    columns = reduced.columns
    # A bucket is one file here, whatever the batch's size: Spark cuts it by size when read.
    reduced.withColumn(BUCKET, bucket_of(keys, buckets)).write.mode("overwrite").parquet(changes)
    own = spark.read.parquet(changes)
    touched = own.select(BUCKET).distinct().toArrow()[BUCKET].to_pylist()
    manifest = _manifest(spark, target, batch_id)
    old = {k: manifest[k] for k in touched if k in manifest}
    merged = own
    if old:
        base = spark.read.parquet(*_paths(target, old)).select(*columns)
        both = base.unionByName(own.select(*columns))
        merged = merge(both).withColumn(BUCKET, bucket_of(keys, buckets))
    if touched:
        (merged.repartition(min(len(touched), _tasks(spark)), BUCKET)
         .write.mode("overwrite").partitionBy(BUCKET).parquet(f"{target}/data/batch={batch_id}"))
    after = manifest | dict.fromkeys(touched, batch_id)
    entries = spark.createDataFrame(sorted(after.items()), "bucket int, batch long")
    entries.coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/batch={batch_id}")
    _clean(spark, target, {*manifest.items(), *after.items()})
    return sorted(touched)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _clean(spark: SparkSession, target: str, named: set[tuple[int, int]]) -> None:
    """Removes manifests but the newest, and all data but the (bucket, batch) ``named`` in these."""
    done = complete(spark, f"{target}/manifest")
    batches = {batch for _, batch in named}
    for name in list_dirs(spark, f"{target}/data"):
        batch = int(name.split("=")[1])
        if batch not in batches:
            remove_dir(spark, f"{target}/data/{name}")
            continue
        for part in list_dirs(spark, f"{target}/data/{name}"):
            if (int(part.split("=")[1]), batch) not in named:
                remove_dir(spark, f"{target}/data/{name}/{part}")
    for b in done[:-KEPT]:
        remove_dir(spark, f"{target}/manifest/batch={b}")
    for name in list_dirs(spark, f"{target}/changes"):
        if int(name.split("=")[1]) < done[-1]:
            remove_dir(spark, f"{target}/changes/{name}")


def read_buckets(spark: SparkSession, target: str) -> DataFrame:
    """The table as of its newest complete batch."""
    manifest = _manifest(spark, target)
    if not manifest:
        raise FileNotFoundError(f"no complete batch under {target}")
    return spark.read.parquet(*_paths(target, manifest))


def read_of_keys(
    rows: DataFrame, target: str, keys: list[str], batch_id: int, buckets: int = BUCKETS
) -> DataFrame | None:
    """What the table held before a batch for the keys of ``rows``, or None if nothing yet.

    Only the buckets of these keys are opened.
    """
    spark = rows.sparkSession
    manifest = _manifest(spark, target, batch_id)
    wanted = rows.select(*keys).distinct()
    touched = wanted.select(bucket_of(keys, buckets).alias("b")).distinct().toArrow()["b"].to_pylist()
    own = {k: manifest[k] for k in touched if k in manifest}
    if not own:
        return None
    held = spark.read.parquet(*_paths(target, own))
    named = wanted.toDF(*[f"_key{i}" for i in range(len(keys))])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return held.join(named, functools.reduce(lambda a, b: a & b, same), "left_semi")


def read_changes(spark: SparkSession, target: str) -> DataFrame:
    """The reduced rows of the newest batch."""
    last = complete(spark, f"{target}/manifest")[-1]
    return spark.read.parquet(f"{target}/changes/batch={last}").drop(BUCKET)
