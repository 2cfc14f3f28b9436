"""Vector searches against brute force."""

import math

import numpy as np
import pytest

from tidewell.llm import neighbours, tiles, topk

SCHEMA = "vec_id long, embedding array<double>, label int, row int"


def vectors(kind):
    rng = np.random.default_rng(3)
    made = rng.normal(size=(230, 7))
    if kind == "ties":
        made = rng.integers(-2, 3, (230, 7)) / 4.0
        made[50:130] = made[0]
    if kind == "wild":
        made[5], made[40], made[77] = 1e15, -1e14, 1e-300
    rows = [(i, v.tolist()) for i, v in enumerate(made)]
    rows += [(20, made[3].tolist()), (40, made[40].tolist()), (7, made[7].tolist())]
    rows += [(100, None), (200, []), (300, [1.0, None] + [0.0] * 5), (400, [math.nan] * 7),
             (500, [math.inf] + [1.0] * 6), (600, [0.0] * 7), (None, [1.0] * 7),
             (700, [1.0, 2.0]), (701, [3.0, 4.0]), (-100, [0.5] * 7)]
    return rows


def brute(rows, every, k, zero, convert, score):
    kept = [(i, convert(v)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
            and (zero or any(v))]
    out = []
    for a, (query, x) in enumerate(kept):
        if query % every:
            continue
        found = sorted((-score(x, y), i) for b, (i, y) in enumerate(kept)
                       if a != b and len(x) == len(y))
        out += [(query, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def in_order(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += a * b
    return total


@pytest.fixture(params=[(1024, 4096), (5, 30)], ids=["one tile", "many tiles"])
def blocks(request, monkeypatch):
    monkeypatch.setattr(tiles, "QUERY_BLOCK", request.param[0])
    monkeypatch.setattr(tiles, "VECTOR_BLOCK", request.param[1])
    monkeypatch.setattr(neighbours, "STRIP", 16)


@pytest.mark.parametrize("kind", ["plain", "ties", "wild"])
def test_neighbours_are_exact(spark, blocks, kind):
    rows = vectors(kind)
    df = spark.createDataFrame([(i, v, 0, 9) for i, v in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in neighbours.nearest(df).collect())
    assert got == brute(rows, 20, 20, False, lambda v: v, in_order)


@pytest.mark.parametrize("kind", ["plain", "ties", "wild"])
def test_top_products_are_exact(spark, blocks, kind):
    rows = vectors(kind)
    df = spark.createDataFrame([(i, v, 0, 9) for i, v in rows], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in topk.top_products(df).collect())
    top = 2**63 - 1
    wanted = brute(rows, 50, 5, True, lambda v: [math.floor(256 * x) for x in v],
                   lambda x, y: max(-top - 1, min(top, sum(a * b for a, b in zip(x, y, strict=True)))))
    assert got == wanted


def test_vector_searches_take_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neighbours.nearest(empty).count() == 0 and topk.top_products(empty).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 0, 0)], SCHEMA)
    assert neighbours.nearest(alone).count() == 0 and topk.top_products(alone).count() == 0


def test_code_products_stay_within_their_bounds():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(40, 1500)), rng.normal(size=(50, 1500)) * 100
    a, a_scale, a_norm, a_rest = neighbours.quantise(x)
    b, b_scale, b_norm, b_rest = neighbours.quantise(y)
    whole = a.astype(np.int64) @ b.astype(np.int64).T
    assert (neighbours.code_products(a, b) == whole).all()
    slip = np.abs(whole * np.outer(a_scale, b_scale) - x @ y.T)
    assert (slip <= np.outer(a_norm, b_rest) + np.outer(a_rest, b_norm + b_rest) + 1e-9).all()


def test_pivots_never_bound_a_product_too_low():
    rng = np.random.default_rng(6)
    x, y = rng.integers(-256, 256, (30, 9)).astype(float), rng.integers(-256, 256, (80, 9)).astype(float)
    pivots = topk.choose_pivots(y)
    high = topk.bounds(x, y, topk.distances(x, pivots), topk.distances(y, pivots))
    assert (high >= x @ y.T).all()
