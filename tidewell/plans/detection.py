"""Anomaly and velocity rules over the events table.

Thresholds that would match nothing in this table are lowered; the operators'
defaults stay as they are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tidewell.operators import detect
from tidewell.operators.frames import DENSE_ROWS, SPLIT_ROWS
from tidewell.plans.tables import table

ORDER = ("ts", "event_id")
FLOOR, HIGH_VALUE, FRAME = 100.0, 150.0, "1 day"
JUDGED = ("event_id", "user_id", "value", "history_n", "history_avg", "is_anomaly")
SCORED = ("event_id", "user_id", "value", "velocity", "score", "is_alert")


def _anomalies(spark, sf_dir, split_rows=SPLIT_ROWS, **rule) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return detect.anomaly_batch(
        events, "user_id", "value", ORDER, floor=FLOOR, split_rows=split_rows, **rule
    ).select(*JUDGED)


def anomaly_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anomalies(spark, sf_dir)


def anomaly_batch_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every user cut into pieces, as a user with most rows would be."""
    return _anomalies(spark, sf_dir, split_rows=60)


def anomaly_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anomalies(spark, sf_dir, zscore=3.0)


def _velocity(spark, sf_dir, dense_rows=DENSE_ROWS) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return detect.velocity_batch(
        events, "user_id", "value", "ts", "event_id", FRAME,
        high_amount=HIGH_VALUE, dense_rows=dense_rows,
    ).select(*SCORED)


def velocity_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _velocity(spark, sf_dir)


def velocity_batch_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counted by rank, as for users with very many rows in a frame."""
    return _velocity(spark, sf_dir, dense_rows=0)


def velocity_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, as a topic may deliver it: both count, by rank."""
    events = table(spark, sf_dir, "events")
    return detect.velocity_batch(
        events.union(events), "user_id", "value", "ts", "event_id", FRAME,
        high_amount=HIGH_VALUE, dense_rows=0,
    ).select(*SCORED)


class LinearModel:
    """A stand-in for a trained model: fixed weights for velocity and amount."""

    weights = np.array([0.125, 0.25])

    def predict(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights


def score_with_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = detect.score_with_model(
        _velocity(spark, sf_dir), ["velocity", "value"], LinearModel()
    )
    return scored.selectExpr("event_id", "round(model_score, 4) AS model_score")


QUERIES = {
    f.__name__: f
    for f in (
        anomaly_batch, anomaly_batch_split, anomaly_zscore, velocity_batch,
        velocity_batch_ranked, velocity_repeated_ids, score_with_model,
    )
}

_FRAMED = """
    SELECT event_id, user_id, value, u,
           count(*) OVER h AS n, sum(u) OVER h AS s, sum(u * u) OVER h AS q
    FROM (SELECT *, CAST(CAST(value AS DECIMAL(18, 2)) * 100 AS HUGEINT) AS u FROM events)
    WINDOW h AS (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)"""

ANOMALIES = f"""
    SELECT event_id, user_id, value, n AS history_n,
           CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / 100.0 / n END AS history_avg,
           coalesce(n >= 3 AND u * n > 3 * s AND u > 10000, false) AS is_anomaly
    FROM ({_FRAMED})"""

VELOCITY = """
    SELECT event_id, user_id, value, velocity, CAST(score AS INTEGER) AS score,
           score > 70 AS is_alert
    FROM (SELECT *, CASE WHEN velocity > 5 THEN 40 ELSE 0 END
                    + CASE WHEN CAST(value AS DECIMAL(18, 2)) > 150 THEN 50 ELSE 0 END AS score
          FROM (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY ts
                    RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS velocity
                FROM events))"""

ORACLE = {
    "anomaly_batch": ANOMALIES,
    "anomaly_batch_split": ANOMALIES,
    "anomaly_zscore": f"""
        SELECT event_id, user_id, value, n AS history_n,
               CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / 100.0 / n END AS history_avg,
               coalesce(n >= 3 AND n * u - s > 0
                   AND (n * u - s) * (n * u - s) * (n - 1) > 9 * n * (n * q - s * s), false)
                   AS is_anomaly
        FROM ({_FRAMED})""",
    "velocity_batch": VELOCITY,
    "velocity_batch_ranked": VELOCITY,
    "velocity_repeated_ids": VELOCITY.replace(
        "FROM events", "FROM (SELECT * FROM events UNION ALL SELECT * FROM events)"),
    "score_with_model": f"""
        SELECT event_id, round(0.125 * velocity + 0.25 * value, 4) AS model_score
        FROM ({VELOCITY})""",
}
