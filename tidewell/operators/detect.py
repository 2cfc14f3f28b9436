"""Per-user anomaly and velocity detection over a finished table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewell.functions import rules
from tidewell.functions.numbers import from_minor_units, minor_units
from tidewell.operators.frames import DENSE_ROWS, SPLIT_ROWS, trailing_count, trailing_rows


def anomaly_batch(
    df: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    order: tuple[str, ...] = ("created_at", "id"),
    history: int = rules.HISTORY,
    min_n: int = rules.MIN_HISTORY,
    ratio: float = rules.RATIO,
    floor: float = rules.FLOOR,
    zscore: float | None = None,
    scale: int = 2,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Judges each row against the user's ``history`` earlier ones.

    Adds ``history_n``, ``history_avg`` and ``is_anomaly``. The rule is the ratio
    to the mean, or with ``zscore`` the distance from it in standard deviations.
    """
    units = F.col("_units")
    measures = {"history_n": F.count(units), "_sum": F.sum(units)}
    if zscore is not None:
        wide = units.cast(DecimalType(19, 0))
        measures["_sum_sq"] = F.sum(wide * wide)
    framed = trailing_rows(
        df.withColumn("_units", minor_units(F.col(amount), scale)),
        user, order, history, measures, split_rows,
    )
    n, total = F.col("history_n"), F.col("_sum")
    if zscore is None:
        rule = rules.above_ratio(units, n, total, min_n, ratio, round(floor * 10**scale))
    else:
        rule = rules.above_zscore(units, n, total, F.col("_sum_sq"), min_n, zscore)
    return framed.select(
        *df.columns,
        "history_n",
        (from_minor_units(total, scale) / n.cast("double")).alias("history_avg"),
        F.coalesce(rule, F.lit(False)).alias("is_anomaly"),
    )


def velocity_batch(
    df: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    window: str = rules.WINDOW,
    max_velocity: int = rules.MAX_VELOCITY,
    high_amount: float = rules.HIGH_AMOUNT,
    alert: int = rules.ALERT_ABOVE,
    split_rows: int = SPLIT_ROWS,
    dense_rows: int = DENSE_ROWS,
    scale: int = 2,
) -> DataFrame:
    """Scores each row by the user's recent rows and its own amount.

    Adds ``velocity``, ``score`` and ``is_alert``. ``id_col`` is there as in the other
    detectors; ids may repeat or be null, since every row counts.
    """
    counted = trailing_count(df, user, ts, window, "velocity", split_rows, dense_rows)
    score = rules.velocity_score(
        F.col("velocity"), minor_units(F.col(amount), scale), max_velocity,
        round(high_amount * 10**scale),
    )
    return counted.withColumn("score", score).withColumn("is_alert", F.col("score") > alert)


def score_with_model(
    df: DataFrame, features: list[str], model, name: str = "model_score"
) -> DataFrame:
    """Adds ``model.predict(rows)``, called on one Arrow batch of rows at a time.

    ``model`` is anything with a ``predict`` over a two-dimensional array. It is
    broadcast, so each Python worker reads it once.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predict(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.predict(rows.to_numpy(dtype="float64")), dtype="float64")

    return df.withColumn(name, predict(F.struct(*[F.col(c).cast("double") for c in features])))
