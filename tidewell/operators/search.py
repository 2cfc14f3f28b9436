"""Substring counts, token search and the inverted token index."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import contains, has_token, normal_term, tokens
from tidewell.operators.deltas import complete, part_paths
from tidewell.session import estimated_bytes, folder_bytes, list_dirs, remove_dir
from tidewell.sources.files import spread as over_all_cores

TASK_BYTES = 64 * 1024 * 1024  # table bytes per index task
MIN_BUCKETS, MAX_BUCKETS = 8, 4096
MIN_SPREAD = 4


def _grouped(df: DataFrame, group: str, name: str) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias(name)).orderBy(F.desc(name), group)


def _conditions(eq: dict | None, isin: dict | None) -> Column:
    keep = F.lit(True)
    for column, value in (eq or {}).items():
        keep = keep & (F.col(column) == value)
    for column, values in (isin or {}).items():
        keep = keep & F.col(column).isin(*values)
    return keep


def contains_count(
    df: DataFrame,
    text: str,
    term: str,
    group: str,
    eq: dict | None = None,
    isin: dict | None = None,
    ignore_case: bool = True,
    name: str = "match_count",
) -> DataFrame:
    """Rows per ``group`` whose ``text`` contains ``term``, most first."""
    keep = _conditions(eq, isin) & contains(F.col(text), term, ignore_case)
    return _grouped(df.filter(keep), group, name)


def text_match(df: DataFrame, text: str, term: str) -> DataFrame:
    """Rows whose ``text`` has ``term`` as a token, found by reading every text."""
    return df.filter(has_token(F.col(text), term))


def postings(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(term, doc_id, tf)`` for each distinct token of each row.

    Tokens are counted inside their row: the sorted tokens are cut where the
    token changes, and a run's length is its frequency. Only one record per row
    and distinct token ever leaves the row, however often a token repeats, and
    counting needs no shuffle. ``id_col`` must identify a row.
    """
    ordered = df.select(
        F.col(id_col).alias("doc_id"), F.sort_array(tokens(F.col(text))).alias("_t")
    )
    starts = ordered.withColumn(
        "_s",
        F.expr(
            "CASE WHEN size(_t) > 0 THEN filter(sequence(0, size(_t) - 1),"
            " i -> i = 0 OR _t[i] <> _t[greatest(i - 1, 0)]) END"
        ),
    )
    runs = F.expr(
        "transform(_s, (at, j) ->"
        " struct(_t[at] AS term, coalesce(get(_s, j + 1), size(_t)) - at AS tf))"
    )
    return starts.select("doc_id", F.explode(runs).alias("_r")).select(
        "_r.term", "doc_id", F.col("_r.tf").cast("long").alias("tf")
    )


def build_text_index(
    df: DataFrame,
    id_col: str,
    text: str,
    path: str,
    buckets: int | None = None,
    spread: int | None = None,
) -> None:
    """Writes the postings of ``df`` under ``path``, one folder per term bucket.

    A term's bucket comes from its hash, so a lookup reads one folder. Within a
    bucket the rows are spread over ``spread`` tasks by document, because a term
    found in every document would otherwise be written by a single task, and
    they are sorted by term, so the reader skips the row groups of other terms.
    Each bucket and share of documents is one task by number, not by hash, so no
    two of them meet in one task while another has none.
    Both numbers follow the size of the table unless given.
    """
    buckets = buckets or bucket_count(df)
    spread = spread or max(MIN_SPREAD, -(-index_tasks(df) // buckets))
    _write_postings(over_all_cores(df.select(id_col, text)), id_col, text, path, buckets, spread)


def _write_postings(
    df: DataFrame, id_col: str, text: str, path: str, buckets: int, spread: int
) -> None:
    part = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
    (
        postings(df, id_col, text)
        .withColumn("buckets", F.lit(buckets))
        .withColumn("bucket", term_bucket(F.col("term"), F.col("buckets")))
        .withColumn("_task", (F.col("bucket") * spread + part).cast("int"))
        .repartitionById(buckets * spread, "_task")
        .drop("_task")
        .sortWithinPartitions("bucket", "term")
        .write.mode("overwrite")
        .partitionBy("buckets", "bucket")
        .parquet(path)
    )


def index_sink(id_col: str, text: str, target: str, buckets: int = 64, spread: int = MIN_SPREAD):
    """A ``foreachBatch`` function that indexes a stream's texts as they arrive.

    A micro-batch adds its own postings and replaces them if it is repeated. The
    stream's ids must not repeat. ``buckets`` stays for the life of the index; ``spread``
    is how many tasks share a term that is in every document of a micro-batch. Read the
    index with `read_index`, and fold its batches with `compact_index` now and then.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{target}/delta/batch={batch_id}"
        texts = over_all_cores(batch.select(id_col, text))
        _write_postings(texts, id_col, text, path, buckets, spread)

    return write


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The postings of `index_sink`: the newest folded base and the batches after it."""
    paths, _ = part_paths(spark, target)
    if not paths:
        raise FileNotFoundError(f"nothing complete under {target}")
    # Each part is a partitioned table of its own, so its buckets are still folder names.
    parts = [spark.read.parquet(path) for path in paths]
    return functools.reduce(DataFrame.unionByName, parts)


def compact_index(spark: SparkSession, target: str, spread: int = MIN_SPREAD) -> None:
    """Folds all complete batches of an index into one base, a folder per bucket.

    Each bucket is dealt to ``spread`` tasks by document, more if the index is large, so a term
    of very many documents is not one task's work. Each share is one task by number. Folders of older bases and folded batches are left to readers
    that still have them open; the next compaction removes them.
    """
    paths, last = part_paths(spark, target)
    folded = [n for n in complete(spark, f"{target}/base") if n != last]
    if len(paths) > 1:
        kinds = [name for path in paths for name in list_dirs(spark, path) if name.startswith("buckets=")]
        buckets = max(int(kind.split("=")[1]) for kind in kinds)
        size = sum(folder_bytes(spark, path) for path in paths)
        spread = max(spread, -(-size // (buckets * TASK_BYTES)))
        share = F.pmod(F.xxhash64("doc_id"), F.lit(spread))
        (
            read_index(spark, target)
            .withColumn("_task", (F.col("bucket") * spread + share).cast("int"))
            .repartitionById(buckets * spread, "_task")
            .drop("_task")
            .sortWithinPartitions("buckets", "bucket", "term")
            .write.mode("overwrite").partitionBy("buckets", "bucket")
            .parquet(f"{target}/base/upto={last}")
        )
    for upto in folded[:-1]:
        remove_dir(spark, f"{target}/base/upto={upto}")
    if folded:
        for batch in complete(spark, f"{target}/delta"):
            if batch <= folded[-1]:
                remove_dir(spark, f"{target}/delta/batch={batch}")


def bucket_count(df: DataFrame) -> int:
    """Buckets that suit a table of this size, also where it arrives as a stream."""
    return min(MAX_BUCKETS, max(MIN_BUCKETS, index_tasks(df)))


def index_tasks(df: DataFrame) -> int:
    """How many tasks of about ``TASK_BYTES`` of table the postings should fill."""
    size = estimated_bytes(df)
    if size is None:  # rows from elsewhere: as many as the session shuffles into
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return size // TASK_BYTES + 1


def term_bucket(term: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(term), buckets).cast("int")


def lookup(index: DataFrame, term: str) -> DataFrame:
    """The postings of one term. Only the folder of its bucket is read.

    Both sides of the bucket test are folder names or constants, so Spark
    decides it before opening any file.
    """
    token = normal_term(term)
    in_bucket = F.col("bucket") == term_bucket(F.lit(token), F.col("buckets"))
    return index.filter(in_bucket & (F.col("term") == token))


def text_match_indexed(
    df: DataFrame, index: DataFrame, id_col: str, term: str
) -> DataFrame:
    """Rows that have ``term`` as a token, found through the index, not the texts."""
    found = lookup(index, term).select(F.col("doc_id").alias(id_col))
    return df.join(found, id_col, "left_semi")


def top_terms(index: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` terms found in most documents, with their total frequency."""
    return (
        index.groupBy("term")
        .agg(F.count("*").alias("doc_count"), F.sum("tf").alias("term_count"))
        .orderBy(F.desc("doc_count"), "term")
        .limit(k)
    )
