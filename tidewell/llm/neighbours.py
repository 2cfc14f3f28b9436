"""Nearest neighbours by inner product: int8 product tiles, then exact scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidewell.llm import tiles
from tidewell.plans.tables import table

NEAREST = 20
STRIP = 2048  # candidates of one product, which bounds its memory
EXACT_TERMS = 1024  # products of int8 codes whose sum a float32 still holds exactly
SLACK = 1e-12  # rounding of the double arithmetic around the bounds, relative


def quantise(x: np.ndarray):
    """int8 codes per row, their scale, the norm of what they stand for, and of the rest."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(np.divide(x, scale[:, None], out=np.zeros_like(x), where=scale[:, None] > 0))
    coded = codes * scale[:, None]
    return codes.astype(np.int8), scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows. Whole numbers this small are exact in float32,
    whose matrix product is the fast one."""
    total = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], EXACT_TERMS):
        part = slice(d, d + EXACT_TERMS)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def exact_scores(x: np.ndarray, y: np.ndarray, xi: np.ndarray, yi: np.ndarray) -> np.ndarray:
    """Inner products of given pairs of rows, summed in the order of the components."""
    total = np.zeros(len(xi))
    for d in range(x.shape[1]):
        total += x[xi, d] * y[yi, d]
    return total


def best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k best, by score, then smaller id; sorted by row."""
    order = np.lexsort((ids, -scores, rows))
    ranked = rows[order]
    first = np.searchsorted(ranked, ranked, side="left")
    return order[np.arange(len(order)) - first < k]


def nearest_in_tile(queries, candidates, k: int = NEAREST):
    """Each query's ``k`` best candidates of a tile; the result is exact.

    A code product differs from the true one by at most |q'| |dc| + |dq| |c'| + |dq| |dc|,
    with q', c' what the codes stand for and dq, dc what they miss. A pair whose upper
    bound is under k lower bounds, or under k exact scores, can't be among the best; only
    the others are computed from the vectors.
    """
    x, y = tiles.matrix(queries), tiles.matrix(candidates)
    x_row, y_row = tiles.longs(queries, "row"), tiles.longs(candidates, "row")
    y_id = tiles.longs(candidates, "vec_id")
    none = np.zeros(0, np.int64)
    rows, ids, scores = none, none, np.zeros(0)
    if len(x) and len(y):
        kth = np.full(len(x), -np.inf)
        a, a_scale, a_norm, a_rest = quantise(x)
        b, b_scale, b_norm, b_rest = quantise(y)
        for start in range(0, len(y), STRIP):
            part = slice(start, start + STRIP)
            with np.errstate(over="ignore", invalid="ignore"):
                near = code_products(a, b[part]) * a_scale[:, None] * b_scale[None, part]
                slip = (np.outer(a_norm, b_rest[part]) + np.outer(a_rest, b_norm[part] + b_rest[part])
                        + SLACK * np.outer(a_norm + a_rest, b_norm[part] + b_rest[part]))
                low, high = near - slip, near + slip
            own = x_row[:, None] == y_row[None, part]
            low[own] = -np.inf
            if low.shape[1] >= k:
                floor = np.partition(np.nan_to_num(low, nan=-np.inf), -k, axis=1)[:, -k]
                kth = np.maximum(kth, floor)
            qi, ci = np.nonzero(~(high < kth[:, None]) & ~own)
            ci = ci + start
            rows = np.concatenate([rows, qi])
            ids = np.concatenate([ids, y_id[ci]])
            scores = np.concatenate([scores, exact_scores(x, y, qi, ci)])
            keep = best_of(rows, ids, scores, k)
            rows, ids, scores = rows[keep], ids[keep], scores[keep]
            last = np.flatnonzero(np.bincount(rows, minlength=len(x)) == k)
            ends = np.searchsorted(rows, last, side="right") - 1
            kth[last] = np.maximum(kth[last], scores[ends])
    return tiles.found(x_row[rows], tiles.longs(queries, "vec_id")[rows], ids, scores, "double")


def nearest(vectors: DataFrame, every: int = 20, k: int = NEAREST) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every``, the ``k`` rows with the
    largest inner product: ``query_id, rank, vec_id, score``.

    All other rows are candidates, equal ones and those of the same id too. Ties go to the
    smaller id. Vectors that are null, empty, zero, without id, or hold a null or non-finite
    component take no part, and vectors of another dimension are never compared. An empty
    table gives no rows; further columns are ignored.
    """
    ready = tiles.prepared(vectors.select("vec_id", "embedding"), zero=False)

    def tile(queries, candidates):
        return nearest_in_tile(queries, candidates, k)

    return tiles.search(ready, every, tile, "double", k)


def op1_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


ORACLE_OP1 = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM e q JOIN e c ON q.r <> c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0),
k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM k WHERE n <= 20
"""
