"""Per-user detectors on a stream, with the rules of `tidewell.operators.detect`.

Spark partitions the stream by user and keeps each user's state. A group's rows
of one micro-batch are judged together with array operations, in order of time
and id, so the cost per row stays small for a user with very many rows. A group is
a lot, a fixed share of the users by hash, since a call per user costs far more than the judging
of a user's few rows; state is read and written per user. The size
of a micro-batch is bounded at the source (``max_files``, ``max_offsets``), and
with it the rows of one user in memory. Rows of a later micro-batch are judged
after those of an earlier one, whatever their times.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, DataType

from tidewell.functions import rules
from tidewell.functions.numbers import from_minor_units, minor_units
from tidewell.functions.times import duration_micros, micros
from tidewell.session import ship_package

LOTS = 64  # of users, for the life of a checkpoint
WHO = "who string"
MAX_TEXT = (1 << 31) - 1
LOOKS_PER_WINDOW = 8


def in_lots(rows: DataFrame) -> DataFrame:
    """Rows with their user as a text that is never null, and with the lot of that user."""
    kind, user = rows.schema["user_key"].dataType, F.col("user_key")
    text = F.hex(user) if isinstance(kind, BinaryType) else user.cast("string")
    who = F.coalesce(F.concat(F.lit("="), text), F.lit(""))
    named = rows.withColumn("who", who).drop("user_key")
    return named.withColumn("lot", F.pmod(F.xxhash64("who"), F.lit(LOTS)).cast("int"))


def with_users(judged: DataFrame, kind: DataType) -> DataFrame:
    """``user_key`` for the text of `in_lots`."""
    text = F.substring("who", 2, MAX_TEXT)
    user = F.unhex(text) if isinstance(kind, BinaryType) else text.cast(kind)
    columns = [c for c in judged.columns if c != "who"]
    return judged.select(F.when(F.col("who") != "", user).alias("user_key"), *columns)


def runs_of(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    if not len(values):
        return []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True))


def aligned(units: np.ndarray, runs: list[tuple[int, int]], earlier: list[np.ndarray]):
    """Runs of ``units``, each behind the amounts ``earlier`` than it, in one array; where in it
    each of ``units`` is, where its run begins, and the bounds of the runs."""
    parts = [part for (a, b), before in zip(runs, earlier, strict=True) for part in (before, units[a:b])]
    known = np.concatenate([np.array([], "int64"), *parts])
    before = np.array([len(e) for e in earlier], "int64")
    own = np.array([b - a for a, b in runs], "int64")
    ends = np.cumsum(before + own)
    starts = ends - before - own
    here = np.arange(len(units)) + np.repeat(np.cumsum(before), own)
    return known, here, np.repeat(starts, own), list(zip(starts.tolist(), ends.tolist(), strict=True))


def flag_anomalies(
    earlier: np.ndarray, units: np.ndarray,
    history: int, min_n: int, ratio: float, floor_units: int, zscore: float | None,
):
    """Number and sum of the ``history`` amounts before each of ``units``, which follow
    ``earlier``, and whether each is an anomaly by them."""
    known, here, start, _ = aligned(units, [(0, len(units))], [earlier])
    return flag_runs(known, here, start, history, min_n, ratio, floor_units, zscore)


def flag_runs(
    known: np.ndarray, here: np.ndarray, start: np.ndarray,
    history: int, min_n: int, ratio: float, floor_units: int, zscore: float | None,
):
    """`flag_anomalies` of the amounts at ``here``, each by those before it from ``start`` on."""
    p, q = rules.as_fraction(ratio)
    # sums[i] is the total of the first i known amounts.
    sums = np.concatenate([[0], np.cumsum(known.astype(object))]).astype(object)
    units, first = known[here], np.maximum(here - history, start)
    n, total = here - first, (sums[here] - sums[first]).astype("int64")
    if zscore is None:
        # In Python's integers, as rules.above_ratio in wide decimals.
        beyond = units.astype(object) * n * q > total.astype(object) * p
        return n, total, (n >= min_n) & beyond.astype(bool) & (units > floor_units)
    # As in rules.above_zscore, in Python's integers: squares outgrow 64 bits.
    squares = np.concatenate([[0], np.cumsum(known.astype(object) ** 2)])
    count, whole, units = n.astype(object), total.astype(object), units.astype(object)
    gap, spread = count * units - whole, count * (squares[here] - squares[first]) - whole * whole
    z_squared = round(zscore * zscore * 10_000)
    beyond = gap * gap * (count - 1) * 10_000 > z_squared * count * spread
    flagged = (count >= max(min_n, 2)) & (gap > 0) & beyond
    return n, total, flagged.astype(bool)


class RecentJudge(StatefulProcessor):
    """Judges the rows of a lot's users. State: each user's last ``history`` amounts, oldest first,
    of which a micro-batch reads and writes those of its own users."""

    def __init__(self, history: int, min_n: int, ratio: float, floor_units: int, zscore: float | None):
        self.history = history
        self.rule = (history, min_n, ratio, floor_units, zscore)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.users = handle.getMapState("users", WHO, "units binary")

    def _earlier(self, who: str) -> np.ndarray:
        state = self.users.getValue((who,))
        return np.frombuffer(state[0] if state else b"", "int64")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        own = pd.concat(list(rows), ignore_index=True)
        own = own.sort_values(["who", "row_at", "row_id"], kind="stable")
        names = own["who"].to_numpy()
        users = runs_of(names)
        known, here, start, bounds = aligned(
            own["units"].to_numpy("int64"), users, [self._earlier(names[a]) for a, _ in users])
        n, total, flagged = flag_runs(known, here, start, *self.rule)
        for (a, _), (first, end) in zip(users, bounds, strict=True):
            self.users.updateValue((names[a],), (known[max(first, end - self.history):end].tobytes(),))
        yield pd.DataFrame({
            "who": names, "id": own["row_id"].to_numpy(), "at": own["row_at"].to_numpy("int64"),
            "history_n": n, "history_sum": total, "is_anomaly": flagged})

    def close(self) -> None:
        pass


class VelocityScan(StatefulProcessor):
    """Judges the rows of a lot's users. State: per user the times that a later row can still see.

    A user is forgotten once even the newest of these times is out of reach, by a timer of the
    lot. It looks through the lot once in a part of the window, so that it costs little.
    """

    def __init__(self, width: int, max_velocity: int, high_units: int, alert: int, mode: str):
        self.rule = (width, max_velocity, high_units, alert)
        self.mode = mode

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.users = handle.getMapState("users", WHO, "at binary")

    def _now(self, timer_values) -> int:
        """The watermark or the clock, in milliseconds."""
        if self.mode == "EventTime":
            return timer_values.getCurrentWatermarkInMs()
        return timer_values.getCurrentProcessingTimeInMs()

    def _needed_until(self, newest: int) -> int:
        return (newest + self.rule[0]) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        width, max_velocity, high_units, alert = self.rule
        own = pd.concat(list(rows), ignore_index=True)
        if self.mode == "ProcessingTime":
            own["row_at"] = self._now(timerValues) * 1000
        own = own.sort_values(["who", "row_at", "row_id"], kind="stable")
        names, at = own["who"].to_numpy(), own["row_at"].to_numpy("int64")
        velocity, newest = np.zeros(len(own), "int64"), []
        for a, b in runs_of(names):
            state = self.users.getValue((names[a],))
            known = at[a:b]
            if state:
                known = np.sort(np.concatenate([np.frombuffer(state[0], "int64"), known]), kind="stable")
            upto = np.searchsorted(known, at[a:b], side="right")
            velocity[a:b] = upto - np.searchsorted(known, at[a:b] - width, side="left")
            kept = known[np.searchsorted(known, known[-1] - width):]
            self.users.updateValue((names[a],), (kept.tobytes(),))
            newest.append(int(known[-1]))
        if self.mode != "None" and not list(self.handle.listTimers()):
            # Rows can be older than the watermark: Spark drops late ones by an earlier value.
            self.handle.registerTimer(max(self._needed_until(min(newest)), self._now(timerValues) + 1))
        score = rules.VELOCITY_POINTS * (velocity > max_velocity)
        score = score + rules.AMOUNT_POINTS * (own["units"].to_numpy("int64") > high_units)
        yield pd.DataFrame({
            "who": names, "id": own["row_id"].to_numpy(), "at": at, "velocity": velocity,
            "score": score.astype("int32"), "is_alert": score > alert})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        held = [(who, self._needed_until(int(np.frombuffer(at, "int64")[-1])))
                for (who,), (at,) in self.users.iterator()]
        for who, until in held:
            if until <= now:
                self.users.removeKey((who,))
        if left := [until for _, until in held if until > now]:
            pause = self.rule[0] // 1000 // LOOKS_PER_WINDOW
            self.handle.registerTimer(max(min(left), now + 1 + pause))
        yield from ()

    def close(self) -> None:
        pass


def detector_input(sdf: DataFrame, user: str, amount: str, ts: str, id_col: str, scale: int) -> DataFrame:
    """The columns a detector needs. Rows without id, time or amount are not judged, and
    are counted in the query's progress as ``detector.rejected``."""
    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in (id_col, ts, amount)])
    counted = sdf.observe(
        "detector", F.count("*").alias("records"), F.sum(missing).alias("rejected"))
    rows = counted.select(
        F.col(user).alias("user_key"),
        F.col(id_col).alias("row_id"),
        micros(F.col(ts)).alias("row_at"),
        minor_units(F.col(amount), scale).alias("units"),
        F.col(ts).cast("timestamp").alias("event_time"),
    )
    return rows.dropna(subset=["row_id", "row_at", "units"])


def with_history_avg(judged: DataFrame, scale: int) -> DataFrame:
    """``history_avg`` for ``history_sum``; a user without history gets null as in batch."""
    n = F.col("history_n")
    mean = F.when(n > 0, from_minor_units(F.col("history_sum"), scale) / n.cast("double"))
    return judged.select("user_key", "id", "at", "history_n", mean.alias("history_avg"), "is_anomaly")


def named_result(judged: DataFrame, user: str, ts: str, id_col: str) -> DataFrame:
    return judged.withColumn("at", F.timestamp_micros("at")).withColumnsRenamed(
        {"user_key": user, "id": id_col, "at": ts}
    )


def anomaly_stream(
    sdf: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    history: int = rules.HISTORY,
    min_n: int = rules.MIN_HISTORY,
    ratio: float = rules.RATIO,
    floor: float = rules.FLOOR,
    zscore: float | None = None,
    scale: int = 2,
) -> DataFrame:
    """Judges each arriving row against the user's ``history`` earlier ones.

    The rule is the ratio to their mean, or with ``zscore`` the distance from it. A call judges
    the users of one of LOTS lots; state is kept per user.
    """
    ship_package(sdf.sparkSession)
    rows = in_lots(detector_input(sdf, user, amount, ts, id_col, scale).drop("event_time"))
    id_kind = rows.schema["row_id"].dataType.simpleString()
    judged = rows.groupBy("lot").transformWithStateInPandas(
        RecentJudge(history, min_n, ratio, round(floor * 10**scale), zscore),
        f"who string, id {id_kind}, at long, history_n long, history_sum long, is_anomaly boolean",
        "Append", "None")
    judged = with_users(judged, sdf.schema[user].dataType)
    return named_result(with_history_avg(judged, scale), user, ts, id_col)


def velocity_stream(
    sdf: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    window: str = rules.WINDOW,
    max_velocity: int = rules.MAX_VELOCITY,
    high_amount: float = rules.HIGH_AMOUNT,
    alert: int = rules.ALERT_ABOVE,
    time_mode: str = "event",
    watermark: str | None = "10 minutes",
    scale: int = 2,
) -> DataFrame:
    """Scores each arriving row by the user's recent rows and its own amount.

    Times are the rows' own, or with ``time_mode="processing"`` the time at which
    Spark reads them. A user's state is dropped once its last row is older than
    the window, by the watermark or the clock, or up to an eighth of the window later. Rows later than the watermark are
    not judged but counted in the query's progress; without a watermark all rows
    are judged and no state is dropped. By the clock, Spark looks for idle users for ever: start such a
    query with an interval, or with ``no_data_batches=False`` if it is to end.
    """
    if time_mode not in ("event", "processing"):
        raise ValueError(f"unknown time mode {time_mode!r}")
    ship_package(sdf.sparkSession)
    rows, kept = in_lots(detector_input(sdf, user, amount, ts, id_col, scale)), "None"
    if time_mode == "processing":
        rows, kept = rows.drop("event_time"), "ProcessingTime"
    elif watermark is not None:
        rows, kept = rows.withWatermark("event_time", watermark), "EventTime"
    id_kind = rows.schema["row_id"].dataType.simpleString()
    judged = rows.groupBy("lot").transformWithStateInPandas(
        VelocityScan(duration_micros(window), max_velocity, round(high_amount * 10**scale), alert, kept),
        f"who string, id {id_kind}, at long, velocity long, score int, is_alert boolean",
        "Append", kept)
    return named_result(with_users(judged, sdf.schema[user].dataType), user, ts, id_col)
