"""Which files make up a table, as entries that each commit adds or takes back.

A commit is one folder of entries, complete or not there, so a reader sees all of a commit's
changes or none. Repeating it replaces it. Entries are folded now and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.deltas import complete, fold, part_paths, write_delta
from tidewell.session import remove_dir

FOLD_EVERY = 50  # commits whose entries are folded into one part

# Every entry has these; a table adds what it knows of a file. A path '' is a mark without a file.
ENTRY = "path string, present boolean, commit long"


def _merged(entries: DataFrame) -> DataFrame:
    """The last entry of each file; those of removed files go."""
    values = [c for c in entries.columns if c != "path"]
    last = entries.groupBy("path").agg(F.max_by(F.struct(*values), "commit").alias("_v"))
    return last.select("path", "_v.*").filter("present OR path = ''")


def entries(spark: SparkSession, target: str, extra: str, before: int | None = None) -> DataFrame:
    """The files of a table and its mark, as of its last commit or the last one before another.

    For ``before`` nothing may have been folded from that commit on, as is so for one that is
    repeated.
    """
    schema = f"{ENTRY}, {extra}"
    paths, _ = part_paths(spark, target)
    if not paths:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(*paths)
    return _merged(found if before is None else found.filter(F.col("commit") < before))


def commit(added: DataFrame, gone: list[str], target: str, commit_id: int, extra: str) -> None:
    """Adds files (``path`` and the columns of ``extra``) and takes ``gone`` back, at once."""
    spark = added.sparkSession
    names = [part.strip().split(" ")[0] for part in extra.split(",")]
    empty = [None] * len(names)
    out = spark.createDataFrame([(p, False, commit_id, *empty) for p in gone], f"{ENTRY}, {extra}")
    new = added.select("path", F.lit(True).alias("present"), F.lit(commit_id).cast("long").alias("commit"), *names)
    write_delta(new.unionByName(out).coalesce(1), target, commit_id)


def fold_now_and_then(spark: SparkSession, target: str) -> None:
    bases = complete(spark, f"{target}/base")
    since = [b for b in complete(spark, f"{target}/delta") if not bases or b > bases[-1]]
    if len(since) > FOLD_EVERY:
        fold(spark, target, lambda parts: _merged(parts).coalesce(1))
        for b in complete(spark, f"{target}/delta")[:-FOLD_EVERY]:
            remove_dir(spark, f"{target}/delta/batch={b}")
        for b in bases:
            remove_dir(spark, f"{target}/base/upto={b}")
