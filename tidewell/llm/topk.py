"""Exact top-k search with a table of distances to pivots."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import tiles
from tidewell.llm.common import written
from tidewell.plans.tables import table
from tidewell.session import ship_package

BEST = 5
PIVOTS = 16  # per dimension; more give closer bounds and cost more to compare
PIVOT_SAMPLE = 2048  # rows that pivots are chosen from; any pivots give exact results
SCALE = 256.0
FIRST = 64  # candidates evaluated first; each further step takes twice as many
SLACK = 1e-6  # rounding of the bounds, relative to the squares they are made of
LONG = 2**63 - 1


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 x), as doubles."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(SCALE * x))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(np.maximum(
            (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0))


def choose_pivots(sample: np.ndarray) -> np.ndarray:
    """The origin and rows far from each other, each farthest from those before it."""
    pivots = [np.zeros(sample.shape[1])]
    far = np.full(len(sample), np.inf)
    while len(pivots) <= min(PIVOTS, len(sample)):
        far = np.minimum(far, distances(sample, pivots[-1][None])[:, 0])
        pivots.append(sample[int(np.argmax(far))])
    return np.array(pivots)


def pivot_table(ready: DataFrame) -> DataFrame:
    """Rows with ``vec`` made whole, and ``far``, the distances to the pivots; written."""
    ship_package(ready.sparkSession)
    rows = ready.orderBy(F.xxhash64("row"), "row").select("vec").take(PIVOT_SAMPLE)
    by_dim = {}
    for row in rows:
        by_dim.setdefault(len(row["vec"]), []).append(row["vec"])
    pivots = {d: choose_pivots(whole(np.array(v, np.float64))) for d, v in by_dim.items()}

    def measured(batches):
        for batch in batches:
            part = pa.Table.from_batches([batch])
            for dim in np.unique(tiles.longs(part, "dim")):
                own = part.filter(pc.equal(part["dim"], int(dim)))
                x = whole(tiles.matrix(own))
                far = distances(x, pivots.get(int(dim), np.zeros((1, int(dim)))))
                columns = {"row": own["row"], "vec_id": own["vec_id"], "dim": own["dim"],
                           "vec": _lists(x), "far": _lists(far)}
                yield from pa.table(columns).to_batches()

    schema = "row long, vec_id long, dim int, vec array<double>, far array<double>"
    return written(ready.mapInArrow(measured, schema), "pivot-table")


def _lists(x: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(x.ravel(), pa.float64()))


def bounds(x, y, x_far, y_far) -> np.ndarray:
    """Upper bounds of inner products: a distance is at least the largest difference of two
    distances to one pivot, and 2 <x, y> = |x|^2 + |y|^2 - |x - y|^2."""
    with np.errstate(over="ignore", invalid="ignore"):
        apart = np.zeros((len(x), len(y)))
        for p in range(x_far.shape[1]):
            np.maximum(apart, np.abs(x_far[:, p, None] - y_far[None, :, p]), out=apart)
        squares = (x * x).sum(1)[:, None] + (y * y).sum(1)[None]
        high = (squares - apart * apart) / 2 + SLACK * (squares + 1)
    return np.nan_to_num(high, nan=np.inf, posinf=np.inf)


def products(x: np.ndarray, y: np.ndarray):
    """A function from a query's place and candidates' places to exact scores. Doubles hold
    the sums of all but huge vectors, for which whole numbers without limit are taken and
    the score ends at the range of a long."""
    largest = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    if largest * largest * x.shape[1] < 2**53:
        return lambda q, c: (y[c] @ x[q]).astype(np.int64)
    ints = [[int(v) for v in row] for row in y]
    asked = [[int(v) for v in row] for row in x]

    def slow(q, c):
        sums = (sum(a * b for a, b in zip(asked[q], ints[i], strict=True)) for i in c)
        return np.array([max(-LONG - 1, min(LONG, s)) for s in sums], np.int64)

    return slow


def best_in_tile(queries, candidates, k: int = BEST):
    """Each query's ``k`` best candidates of a tile: taken in the order of their bounds,
    until the next bound is under the k-th best score."""
    x, y = tiles.matrix(queries), tiles.matrix(candidates)
    x_row, y_row = tiles.longs(queries, "row"), tiles.longs(candidates, "row")
    x_id, y_id = tiles.longs(queries, "vec_id"), tiles.longs(candidates, "vec_id")
    out = [[], [], [], []]
    if len(x) and len(y):
        high = bounds(x, y, tiles.matrix(queries, "far"), tiles.matrix(candidates, "far"))
        score = products(x, y)
        for q in range(len(x)):
            order = np.argsort(-high[q], kind="stable")
            order = order[y_row[order] != x_row[q]]
            limit = high[q][order]
            scores, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
            at, step = 0, FIRST
            while at < len(order) and (len(scores) < k or limit[at] >= scores[-1]):
                picked = order[at:at + step]
                scores = np.concatenate([scores, score(q, picked)])
                ids = np.concatenate([ids, y_id[picked]])
                # The complement sorts downwards without overflow.
                best = np.lexsort((ids, ~scores))[:k]
                scores, ids = scores[best], ids[best]
                at, step = at + step, step * 2
            n = len(scores)
            for column, values in zip(
                    out, ([x_row[q]] * n, [x_id[q]] * n, ids, scores), strict=True):
                column.extend(values)
    return tiles.found(*out, "long")


def top_products(vectors: DataFrame, every: int = 50, k: int = BEST) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every``, the ``k`` rows with the
    largest inner product of whole vectors: ``query_id, rank, vec_id, score``; exact.

    Each component x counts as floor(256 x). All other rows are candidates, equal ones and
    those of the same id too, and zero vectors. Ties go to the smaller id. Vectors that are
    null, empty, without id, or hold a null or non-finite component take no part, and
    vectors of another dimension are never compared. A score out of a long's range ends at
    it. An empty table gives no rows; further columns are ignored.
    """
    ready = pivot_table(tiles.prepared(vectors.select("vec_id", "embedding"), zero=True))

    def tile(queries, candidates):
        return best_in_tile(queries, candidates, k)

    return tiles.search(ready, every, tile, "long", k)


def op7_topk(spark, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


ORACLE_OP7 = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0),
k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM k WHERE n <= 5
"""
