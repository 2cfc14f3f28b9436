"""A token index that grows with a stream: levels of parts in sorted blocks of postings.

Each micro-batch adds a part to level 0. When a level has FAN parts they are merged into one of
the next, so a posting is rewritten once per level and a merge touches one level only. A
part's files hold ranges of (term, document), dealt by size: a term of very many documents
fills several files and no more than one task each, another file holds thousands of rare terms.
Within a file, postings stand in blocks of one term with the range of its documents. The
manifest has the first and last term of every file, so a lookup opens only files that can
hold its term, and in these Parquet's statistics skip other blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import normal_term
from tidewell.operators.manifest import commit, entries, fold_now_and_then
from tidewell.operators.search import postings
from tidewell.session import folder_bytes, list_dirs, remove_dir, ship_package
from tidewell.sources.files import spread as over_all_cores

FAN = 4  # parts of a level that are merged into one of the next
FILE_BYTES = 64 * 1024 * 1024  # of unblocked postings that become one file
BLOCK = 4096  # postings in a block, at most

EXTRA = "level int, file_bytes long, postings long, first_term string, last_term string"
BLOCKS = "term string, first_doc {id}, last_doc {id}, n long, docs array<{id}>, tfs array<long>"


def _blocks(batches):
    """Postings in order of term and document as blocks: cut where the term changes, at BLOCK
    postings, and where a batch ends."""
    for batch in batches:
        terms = batch.column("term").dictionary_encode()
        codes = terms.indices.to_numpy()
        if not len(codes):
            continue
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        sizes = np.diff(np.r_[starts, len(codes)])
        more = -(-sizes // BLOCK)
        within = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more)
        starts = np.repeat(starts, more) + within * BLOCK
        ends = np.r_[starts[1:], len(codes)]
        offsets = pa.array(np.r_[starts, len(codes)].astype(np.int32))
        docs = batch.column("doc_id")
        yield pa.RecordBatch.from_arrays([
            batch.column("term").take(pa.array(starts)), docs.take(pa.array(starts)),
            docs.take(pa.array(ends - 1)), pa.array(ends - starts),
            pa.ListArray.from_arrays(offsets, docs),
            pa.ListArray.from_arrays(offsets, batch.column("tf")),
        ], names=["term", "first_doc", "last_doc", "n", "docs", "tfs"])


def _write_part(rows: DataFrame, size: int, path: str, file_bytes: int) -> None:
    """Postings as a part in files of ranges, of about equal numbers of postings each."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    n = max(1, -(-size // file_bytes))
    ranged = rows.repartitionByRange(n, "term", "doc_id").sortWithinPartitions("term", "doc_id")
    ranged.select("term", "doc_id", "tf").mapInArrow(_blocks, BLOCKS.format(id=kind)).write.mode(
        "overwrite").parquet(path)


def _files(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.lit(level).alias("level"), F.max("_metadata.file_size").alias("file_bytes"),
        F.sum("n").alias("postings"), F.min("term").alias("first_term"), F.max("term").alias("last_term"))


def _unblocked(blocks: DataFrame) -> DataFrame:
    pairs = F.explode(F.arrays_zip("docs", "tfs")).alias("_p")
    return blocks.select("term", pairs).select(
        "term", F.col("_p.docs").alias("doc_id"), F.col("_p.tfs").alias("tf"))


def index_parts(spark: SparkSession, target: str, before: int | None = None) -> DataFrame:
    """The files of the index: ``path, commit, level, file_bytes, postings, first_term, last_term``."""
    return entries(spark, f"{target}/manifest", EXTRA, before).filter("path <> ''").drop("present")


def leveled_index_sink(
    id_col: str, text: str, target: str, fan: int = FAN, file_bytes: int = FILE_BYTES
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that indexes texts as they arrive. Their ids must not repeat.

    A repeated micro-batch replaces its own part and its own merges. Files that a commit
    replaced stay for the readers that have them, and are removed by the commit after.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ship_package(spark)
        raw = f"{target}/raw/{batch_id % 2}"
        # Written first, so that finding ranges does not read and cut the texts again.
        postings(over_all_cores(batch.select(id_col, text)), id_col, text).write.mode(
            "overwrite").parquet(raw)
        path = f"{target}/parts/batch={batch_id}/level=0"
        _write_part(spark.read.parquet(raw), folder_bytes(spark, raw), path, file_bytes)
        before = index_parts(spark, target, batch_id).select("path", "level", "commit").toArrow().to_pylist()
        new, gone, level = path, [], 0
        while True:
            # The parts of this level, each written by one commit, and the new one.
            same = [f for f in before if f["level"] == level]
            if len({f["commit"] for f in same}) + 1 < fan:
                break
            gone += [f["path"] for f in same]
            merged = spark.read.parquet(*[f["path"] for f in same], new)
            level += 1
            path = f"{target}/parts/batch={batch_id}/level={level}"
            size = sum(folder_bytes(spark, p) for p in [*[f["path"] for f in same], new])
            _write_part(_unblocked(merged), size, path, file_bytes)
            new = path
        commit(_files(spark, new, level), gone, f"{target}/manifest", batch_id, EXTRA)
        _clean(spark, target, batch_id, {f["path"] for f in before}, level)
        fold_now_and_then(spark, f"{target}/manifest")

    return write


def _clean(spark: SparkSession, target: str, batch_id: int, used: set[str], level: int) -> None:
    """Removes parts that no file of the last two commits is in."""
    for name in list_dirs(spark, f"{target}/parts"):
        b = int(name.split("=")[1])
        if b < batch_id and not any(f"/batch={b}/" in path for path in used):
            remove_dir(spark, f"{target}/parts/batch={b}")
    for lower in range(level):
        remove_dir(spark, f"{target}/parts/batch={batch_id}/level={lower}")


def lookup_blocks(
    spark: SparkSession, target: str, term: str, first_doc=None, last_doc=None
) -> DataFrame:
    """The postings of one term, ``term, doc_id, tf``, or those of a range of documents.

    Files come from the manifest by their terms; blocks by term and range of documents.
    """
    token = normal_term(term)
    files = index_parts(spark, target).filter(
        (F.col("first_term") <= token) & (F.col("last_term") >= token))
    paths = sorted(files.select("path").toArrow()["path"].to_pylist())
    if not paths:
        everything = index_parts(spark, target).select("path").toArrow()["path"].to_pylist()
        if not everything:
            raise FileNotFoundError(f"nothing complete under {target}")
        paths = everything[:1]
    blocks = spark.read.parquet(*paths).filter(F.col("term") == token)
    found = F.lit(True)
    if first_doc is not None:
        blocks, found = blocks.filter(F.col("last_doc") >= first_doc), F.col("doc_id") >= first_doc
    if last_doc is not None:
        blocks, found = blocks.filter(F.col("first_doc") <= last_doc), found & (F.col("doc_id") <= last_doc)
    return _unblocked(blocks).filter(found)


def match_by_blocks(df: DataFrame, target: str, id_col: str, term: str) -> DataFrame:
    """Rows that have ``term`` as a token, found through the index, not the texts."""
    found = lookup_blocks(df.sparkSession, target, term).select(F.col("doc_id").alias(id_col))
    return df.join(found, id_col, "left_semi")
