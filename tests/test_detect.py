import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators.detect import anomaly_batch, score_with_model, velocity_batch
from tidewell.operators.frames import (
    _sorted,
    _with_earlier,
    trailing_count,
    trailing_rows,
)
from tidewell.plans.detection import LinearModel

START = dt.datetime(2024, 1, 1)
SCHEMA = "id long, user_id long, amount decimal(10,2), created_at timestamp"


def transactions(spark, entries):
    """Entries are (user, seconds, amount)."""
    return spark.createDataFrame(
        [
            (i, user, Decimal(str(amount)), START + dt.timedelta(seconds=seconds))
            for i, (user, seconds, amount) in enumerate(entries)
        ],
        SCHEMA,
    )


def spend(spark, *amounts, **options):
    """Whether each amount of one user is an anomaly, in order."""
    df = transactions(spark, [(1, i, a) for i, a in enumerate(amounts)])
    return [r.is_anomaly for r in anomaly_batch(df, **options).orderBy("id").collect()]


def test_too_little_history(spark):
    assert spend(spark, 1, 1, 5000) == [False] * 3


def test_enough_history(spark):
    assert spend(spark, 100, 100, 100, 600)[-1]


def test_exactly_three_times_the_mean(spark):
    assert not spend(spark, 200, 200, 200, 600)[-1]
    assert spend(spark, 200, 200, 200, 600.01)[-1]


def test_exactly_the_floor(spark):
    assert not spend(spark, 10, 10, 10, 500)[-1]
    assert spend(spark, 10, 10, 10, 500.01)[-1]


def test_history_is_capped_at_fifty(spark):
    # With the huge first amount still known, 600 would be below three times the mean.
    assert spend(spark, 1_000_000, *[100] * 50, 600)[-1]
    assert not spend(spark, 1_000_000, *[100] * 49, 600)[-1]


def test_an_anomaly_enters_the_history(spark):
    assert spend(spark, 100, 100, 100, 3000, 2400)[-2:] == [True, False]


def test_history_columns(spark):
    df = transactions(spark, [(1, 0, 10), (1, 1, 20), (2, 2, 7)])
    got = anomaly_batch(df).orderBy("id").select("history_n", "history_avg").collect()
    assert [tuple(r) for r in got] == [(0, None), (1, 10.0), (0, None)]


def test_zscore(spark):
    steady = [100, 101, 99, 100, 102]
    assert spend(spark, *steady, 104, zscore=3.0)[-1]
    assert not spend(spark, *steady, 103, zscore=3.0)[-1]
    assert not spend(spark, *steady, 90, zscore=3.0)[-1]
    # No spread at all: anything above the mean is beyond any number of deviations.
    assert spend(spark, 5, 5, 5, 5.01, zscore=3.0)[-1]


def velocities(spark, entries, **options):
    got = velocity_batch(transactions(spark, entries), **options).orderBy("id")
    return [(r.velocity, r.score, r.is_alert) for r in got.collect()]


def test_fifth_and_sixth_in_a_minute(spark):
    got = velocities(spark, [(1, i, 10) for i in range(6)])
    assert got[4] == (5, 0, False) and got[5] == (6, 40, False)


def test_sixty_seconds_is_inside(spark):
    assert velocities(spark, [(1, 0, 1), (1, 60, 1)])[1][0] == 2
    assert velocities(spark, [(1, 0, 1), (1, 60.001, 1)])[1][0] == 1


def test_high_amount(spark):
    assert velocities(spark, [(1, 0, 4000), (2, 0, 4000.01)]) == [(1, 0, False), (1, 50, False)]


def test_both_rules_alert(spark):
    assert velocities(spark, [(1, i, 10) for i in range(5)] + [(1, 5, 4500)])[5] == (6, 90, True)


def test_equal_times_count_for_each_other(spark):
    assert [v[0] for v in velocities(spark, [(1, 0, 1), (1, 0, 1), (2, 0, 1)])] == [2, 2, 1]


ENTRIES = st.lists(
    st.tuples(
        st.sampled_from([1, 1, 1, 1, 2, 3, None]),
        st.integers(0, 400).map(lambda n: n / 4),
        st.sampled_from([1, 5, 20, 100, 700, 4500]),
    ),
    min_size=1, max_size=120,
)
FEW = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(ENTRIES, st.integers(1, 6), st.integers(0, 8))
def test_split_rows_equal_plain_rows(spark, entries, n, extra):
    df = transactions(spark, entries)
    measures = {"n": F.count("amount"), "s": F.sum("amount"), "first": F.min("id")}
    order = ("created_at", "id")
    whole = trailing_rows(df, "user_id", order, n, measures)
    split = trailing_rows(df, "user_id", order, n, measures, split_rows=n + extra)
    assert rows(split) == rows(whole)


@FEW
@given(
    st.lists(st.tuples(
        st.sampled_from([1, 1, 1, 2, None]),
        st.one_of(st.none(), st.integers(0, 400).map(lambda n: n / 4), st.just(3e9)),
        st.sampled_from([None, 1, 1, 2, 7]),
    ), min_size=1, max_size=100),
    st.sampled_from(["1 second", "7 seconds", "60 seconds", "1 hour"]),
)
def test_rank_counts_equal_frame_counts(spark, entries, window):
    """Ids repeat or are null, times too, and some are far out."""
    df = spark.createDataFrame(
        [(i, user, Decimal(1), at if at is None else START + dt.timedelta(seconds=at))
         for user, at, i in entries], SCHEMA)
    args = (df, "user_id", "created_at", window, "v")
    assert rows(trailing_count(*args, dense_rows=0)) == rows(trailing_count(*args))


def test_a_far_out_time_does_not_join_the_pieces(spark):
    df = transactions(spark, [(1, i / 100, 1) for i in range(900)] + [(2, 2e11, 1)])
    pieces = _with_earlier(
        _sorted(df, "user_id", [F.col("created_at"), F.col("id")]), "user_id", F.lit(1))
    last = pieces.filter("user_id = 1").agg(
        F.max(F.col("_before") + F.col("_row") - F.col("_first"))).first()
    assert last[0] == 899
    split = trailing_rows(df, "user_id", ("created_at", "id"), 3, {"n": F.count("id")}, split_rows=50)
    whole = trailing_rows(df, "user_id", ("created_at", "id"), 3, {"n": F.count("id")})
    assert rows(split) == rows(whole)


def test_boundary_of_a_ratio_is_exact(spark):
    assert not spend(spark, *["0.20"] * 5, "0.46", ratio=2.3, floor=0.1)[-1]
    assert spend(spark, *["0.20"] * 5, "0.47", ratio=2.3, floor=0.1)[-1]
    for bad in ({"ratio": 1 / 3}, {"zscore": 1 / 3}):
        with pytest.raises(ValueError):
            spend(spark, 1, 2, **bad)


def test_velocity_amounts_keep_their_scale(spark):
    df = transactions(spark, [(1, 0, 1)]).withColumn("amount", F.lit("4000.004"))
    assert velocity_batch(df, scale=3).first().score == 50
    assert velocity_batch(df).first().score == 0


def test_one_user_with_most_rows_is_cut_into_pieces(spark):
    df = transactions(spark, [(7 if i % 3 else i, i, i % 50 + 1) for i in range(3000)])
    whole = anomaly_batch(df)
    split = anomaly_batch(df, split_rows=200)
    assert rows(split) == rows(whole)
    order = [str(p) for p in split.columns]
    assert order == whole.columns


def test_split_needs_room_for_the_history(spark):
    with pytest.raises(ValueError):
        anomaly_batch(transactions(spark, [(1, 0, 1)]), split_rows=10)


def test_score_with_model(spark):
    df = spark.range(5).withColumn("amount", F.col("id") * 10)
    got = score_with_model(df, ["id", "amount"], LinearModel()).collect()
    assert [r.model_score for r in got] == [i * 0.125 + i * 10 * 0.25 for i in range(5)]
