"""Searches of many queries among all vectors, cut into tiles of bounded size."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import written
from tidewell.session import ship_package

QUERY_BLOCK = 1024  # queries of a tile, on average
VECTOR_BLOCK = 4096  # candidates of a tile, on average
FOUND = "query_row long, query_id long, vec_id long, score {score}"


def prepared(df: DataFrame, zero: bool, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows that take part, as ``row, vec_id, vec, dim``; written, so that ``row`` is fixed.

    A vector that is null or empty, or holds a null or non-finite component, takes no part,
    nor does one without an id, or of zeros unless ``zero``.
    """
    vec = F.col(vec_col)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    keep = F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & finite
    if not zero:
        keep = keep & F.exists(vec, lambda x: x != 0)
    return written(
        df.where(F.coalesce(keep, F.lit(False))).select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
            vec.alias("vec"), F.size(vec).alias("dim")),
        "vectors")


def search(vectors: DataFrame, every: int, tile, score: str, k: int) -> DataFrame:
    """The ``k`` best candidates for each query: ``query_id, rank, vec_id, score``.

    Queries are the rows whose ``vec_id`` is divisible by ``every``, candidates all other
    rows of as many dimensions. Both are dealt to blocks at random, each pair of blocks
    is one task's work in bounded memory, and ``tile(queries, candidates)`` returns each
    query's ``k`` best of its block. A vector is sent as often as the other side has
    blocks; no pairs of rows are ever made.
    """
    ship_package(vectors.sparkSession)
    asks = F.col("vec_id") % every == 0
    sizes = vectors.agg(F.count(F.when(asks, 1)).alias("q"), F.count("*").alias("v")).first()
    q_blocks = max(1, -(-sizes["q"] // QUERY_BLOCK))
    v_blocks = max(1, -(-sizes["v"] // VECTOR_BLOCK))

    def block(n, seed):
        return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")

    queries = vectors.where(asks).withColumn("q_block", block(q_blocks, 1)).withColumn(
        "v_block", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1))))
    others = vectors.withColumn("v_block", block(v_blocks, 2)).withColumn(
        "q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    key = ["dim", "q_block", "v_block"]
    partial = queries.groupBy(key).cogroup(others.groupBy(key)).applyInArrow(
        tile, FOUND.format(score=score))
    return partial.repartition("query_row").mapInArrow(
        lambda batches: merged(batches, k, score),
        f"query_id long, rank int, vec_id long, score {score}")


def merged(batches, k: int, score: str):
    """Merges the tiles' results, one heap of ``k`` per query, the worst on top. Of equal
    scores the smaller id is better."""
    heaps = {}
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(4))
        for row, query, vec, value in zip(*columns, strict=True):
            heap = heaps.setdefault((row, query), [])
            item = (value, -vec)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
    out = [(query, rank, -vec, value)
           for (_, query), heap in heaps.items()
           for rank, (value, vec) in enumerate(sorted(heap, reverse=True), 1)]
    names = ("query_id", "rank", "vec_id", "score")
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64() if score == "double" else pa.int64())
    for start in range(0, len(out), 65536):
        columns = list(zip(*out[start:start + 65536], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=list(names))


def matrix(table: pa.Table, name: str = "vec") -> np.ndarray:
    """The vectors of a table of one dimension, as doubles."""
    lists = table.column(name).combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 1)


def longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def found(rows, queries, ids, scores, score: str) -> pa.Table:
    return pa.table({
        "query_row": pa.array(rows, pa.int64()), "query_id": pa.array(queries, pa.int64()),
        "vec_id": pa.array(ids, pa.int64()),
        "score": pa.array(scores, pa.float64() if score == "double" else pa.int64())})
