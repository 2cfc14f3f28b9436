"""Per-user detectors on a stream whose work on one user is spread over slices of time.

`tidewell.streaming.agents` judges all rows of a user in one task. Here only summaries of
slices do so, and the rows of each slice of a user are a task's work of their own:

1. Tasks reduce their rows to one summary per user and slice, before any shuffle.
2. A scan keyed by lot of users keeps what later slices need in state, per user, and gives each
   slice of the micro-batch what it has to know of the slices before it.
3. Rows and that knowledge meet per lot and slice, and are judged there.

A lot is a fixed share of the users by hash. Most users have few rows in a slice, so a call per
user and slice would cost far more than judging them; a call handles the users of a lot
together, with arrays. The number of lots stays for the life of a checkpoint. A slice is a range of
event time, so a user's share of a task is what arrives of them within one slice, beside the
other users of the lot; choose it by the busiest user. All three steps are one streaming query with one
checkpoint. The source is read twice per micro-batch, once for the summaries and once for
the rows, so it must give the same rows again, as files and topics do.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewell.functions import rules
from tidewell.functions.times import duration_micros
from tidewell.session import ship_package
from tidewell.streaming.agents import (
    WHO,
    aligned,
    detector_input,
    flag_runs,
    in_lots,
    named_result,
    runs_of,
    with_history_avg,
    with_users,
)

# What a message of the third step is.
ROW, KNOWN, LEAVING, FORGET = 0, 1, 2, 3
RECENT = "units binary, seen bigint"
COUNTS = "slices binary, counts binary, seen bigint"
TIMES = "names string, codes binary, at binary"


def _messages(id_kind: str) -> str:
    """The schema of messages to a slice."""
    return (f"lot int, who string, slice long, kind int, row_id {id_kind}, row_at long,"
            " units long, known binary")


def _rows(sdf: DataFrame, user: str, amount: str, ts: str, id_col: str, scale: int, width: int):
    rows = detector_input(sdf, user, amount, ts, id_col, scale).drop("event_time")
    return in_lots(rows).withColumn("slice", F.floor(F.col("row_at") / width).cast("long"))


def _as_messages(rows: DataFrame, kind: int) -> DataFrame:
    return rows.select("lot", "who", "slice", F.lit(kind).alias("kind"), "row_id", "row_at", "units",
                       F.lit(None).cast("binary").alias("known"))


def _joined(chunks: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(chunks), ignore_index=True)


def _message(lot: int, who: list, slices, kind: int, units=None, known=None) -> pd.DataFrame:
    n = len(who)
    return pd.DataFrame({
        "lot": np.full(n, lot, "int32"), "who": who, "slice": np.array(slices, "int64"),
        "kind": np.full(n, kind, "int32"), "row_id": [None] * n, "row_at": pd.array([None] * n, "Int64"),
        "units": pd.array([None] * n if units is None else units, "Int64"),
        "known": [None] * n if known is None else known})


def _last_rows(history: int):
    """Step 1 of the anomaly detector: the last rows of each user and slice in a chunk."""
    def run(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            ordered = chunk.sort_values(["row_at", "row_id"], kind="stable")
            yield ordered.groupby(["who", "slice"]).tail(history)
    return run


class _Scan(StatefulProcessor):
    """Step 2 of a detector. State: per user of a lot a value, of which the last field is when the user was
    seen; a user that is idle for ``idle_ms`` is forgotten by the lot's timer."""

    value = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.users = handle.getMapState("users", WHO, self.value)

    def _now(self, timer_values) -> int:
        return 0 if self.idle_ms is None else timer_values.getCurrentProcessingTimeInMs()

    def _wait(self, now: int) -> None:
        """One timer per lot, which is there as long as the lot has users."""
        if self.idle_ms is not None and not list(self.handle.listTimers()):
            self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, held = self._now(timerValues), [(k[0], v) for k, v in self.users.iterator()]
        idle = [(who, value) for who, value in held if value[-1] + self.idle_ms <= now]
        for who, _ in idle:
            self.users.removeKey((who,))
        yield from self._left(key[0], idle)
        if len(idle) < len(held):
            awake = min(v[-1] for _, v in held if v[-1] + self.idle_ms > now)
            self.handle.registerTimer(awake + self.idle_ms)

    def _left(self, lot: int, idle: list) -> Iterator[pd.DataFrame]:
        yield from ()

    def close(self) -> None:
        pass


class RecentScan(_Scan):
    """Step 2 of the anomaly detector. State: the last amounts of each user."""

    value = RECENT

    def __init__(self, history: int, idle_ms: int | None):
        self.history, self.idle_ms = history, idle_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tails = _joined(rows).sort_values(["who", "slice", "row_at", "row_id"], kind="stable")
        now, units = self._now(timerValues), tails["units"].to_numpy("int64")
        slices, names = tails["slice"].to_numpy("int64"), tails["who"].to_numpy()
        who, numbers, contexts = [], [], []
        for a, b in runs_of(names):
            state = self.users.getValue((names[a],))
            earlier = np.frombuffer(state[0], "int64") if state else np.array([], "int64")
            known = np.concatenate([earlier, units[a:b]])
            for first, _ in runs_of(slices[a:b]):
                upto = len(earlier) + first
                who.append(names[a])
                numbers.append(slices[a + first])
                contexts.append(known[max(0, upto - self.history):upto].tobytes())
            self.users.updateValue((names[a],), (known[-self.history:].tobytes(), now))
        self._wait(now)
        yield _message(key[0], who, numbers, KNOWN, known=contexts)


class AnomalyJudge(StatefulProcessor):
    """Step 3 of the anomaly detector: the rows of a lot's users in a slice, each user's behind the
    amounts known before it. It keeps no state."""

    def __init__(self, history: int, min_n: int, ratio: float, floor_units: int, zscore: float | None):
        self.rule = (history, min_n, ratio, floor_units, zscore)

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        messages = _joined(rows)
        kind = messages["kind"].to_numpy()
        told = messages[kind == KNOWN]
        earlier = {w: np.frombuffer(k, "int64") for w, k in zip(told["who"], told["known"], strict=True)}
        own = messages[kind == ROW].sort_values(["who", "row_at", "row_id"], kind="stable")
        names = own["who"].to_numpy()
        known, here, start, _ = aligned(
            own["units"].to_numpy("int64"), runs_of(names),
            [earlier.get(names[a], np.array([], "int64")) for a, _ in runs_of(names)])
        n, total, flagged = flag_runs(known, here, start, *self.rule)
        yield pd.DataFrame({
            "who": names, "id": own["row_id"].to_numpy(), "at": own["row_at"].to_numpy("int64"),
            "history_n": n, "history_sum": total, "is_anomaly": flagged})

    def close(self) -> None:
        pass


def anomaly_sliced(
    sdf: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    slice_width: str = "1 minute",
    history: int = rules.HISTORY,
    min_n: int = rules.MIN_HISTORY,
    ratio: float = rules.RATIO,
    floor: float = rules.FLOOR,
    zscore: float | None = None,
    scale: int = 2,
    idle: str | None = None,
) -> DataFrame:
    """`agents.anomaly_stream` without a task that holds one user's rows.

    Of a slice only its last ``history`` rows go to the user's own task. With ``idle`` the state
    of users without rows for that long by the clock is dropped; start such a query with an
    interval, or with ``no_data_batches=False`` if it is to end.
    """
    ship_package(sdf.sparkSession)
    rows = _rows(sdf, user, amount, ts, id_col, scale, duration_micros(slice_width))
    id_kind = rows.schema["row_id"].dataType.simpleString()
    tails = rows.mapInPandas(_last_rows(history), rows.schema)
    mode = "None" if idle is None else "ProcessingTime"
    known = tails.groupBy("lot").transformWithStateInPandas(
        RecentScan(history, _millis(idle)), _messages(id_kind), "Append", mode)
    judged = _as_messages(rows, ROW).unionByName(known).groupBy("lot", "slice")
    judged = with_users(judged.transformWithStateInPandas(
        AnomalyJudge(history, min_n, ratio, round(floor * 10**scale), zscore),
        f"who string, id {id_kind}, at long, history_n long, history_sum long,"
        " is_anomaly boolean", "Append", mode), sdf.schema[user].dataType)
    return named_result(with_history_avg(judged, scale), user, ts, id_col)


def _millis(duration: str | None) -> int | None:
    return None if duration is None else duration_micros(duration) // 1000


def _counted(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Step 1 of the velocity detector: how many rows each user and slice has in a chunk."""
    for chunk in chunks:
        counts = chunk.groupby(["lot", "who", "slice"]).size()
        yield counts.rename("n").reset_index()


class CountScan(_Scan):
    """Step 2 of the velocity detector. State: rows per slice of each user.

    Each slice of the micro-batch is told the rows in the whole slices that its window covers.
    Slices out of reach of the user's newest one are dropped, and the third step is told so.
    """

    value = COUNTS

    def __init__(self, slices: int, delay: int, idle_ms: int | None):
        self.slices, self.delay, self.idle_ms = slices, delay, idle_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _joined(rows).groupby(["who", "slice"], sort=True)["n"].sum().reset_index()
        now, names = self._now(timerValues), new["who"].to_numpy()
        slices, added = new["slice"].to_numpy("int64"), new["n"].to_numpy("int64")
        inside, gone = np.zeros(len(new), "int64"), []
        for a, b in runs_of(names):
            state, touched = self.users.getValue((names[a],)), slices[a:b]
            numbers, counts = touched, added[a:b]
            if state:
                numbers, where = np.unique(
                    np.concatenate([np.frombuffer(state[0], "int64"), touched]), return_inverse=True)
                every, counts = np.concatenate([np.frombuffer(state[1], "int64"), counts]), np.zeros(len(numbers), "int64")
                np.add.at(counts, where, every)
            upto = np.concatenate([[0], np.cumsum(counts)])
            inside[a:b] = (upto[np.searchsorted(numbers, touched)]
                           - upto[np.searchsorted(numbers, touched - self.slices + 1)])
            kept = numbers >= numbers[-1] - self.delay - self.slices
            if not kept.all():
                gone.append((names[a], numbers[~kept]))
            self.users.updateValue((names[a],), (numbers[kept].tobytes(), counts[kept].tobytes(), now))
        self._wait(now)
        yield _message(key[0], names, slices, KNOWN, units=inside)
        yield from self._forget(key[0], gone)

    def _forget(self, lot: int, gone: list) -> Iterator[pd.DataFrame]:
        told = [(who, np.unique([numbers, numbers + self.slices])) for who, numbers in gone]
        if told:
            yield _message(lot, [who for who, n in told for _ in n], np.concatenate([n for _, n in told]), FORGET)

    def _left(self, lot: int, idle: list) -> Iterator[pd.DataFrame]:
        yield from self._forget(lot, [(who, np.frombuffer(value[0], "int64")) for who, value in idle])


class VelocityJudge(StatefulProcessor):
    """Step 3 of the velocity detector. State: the times of a lot's rows in a slice, and of those in the
    slice one window before, of which a part leaves the window within the slice. Each is a
    list with an element per micro-batch, so a batch adds its own times only.
    """

    def __init__(self, width: int, max_velocity: int, high_units: int, alert: int):
        self.rule = (width, max_velocity, high_units, alert)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.own = handle.getListState("own", TIMES)
        self.leaving = handle.getListState("leaving", TIMES)

    @staticmethod
    def _packed(names, at: np.ndarray) -> tuple:
        codes, distinct = pd.factorize(names)
        return json.dumps(distinct.tolist()), codes.astype("int32").tobytes(), at.tobytes()

    @staticmethod
    def _held(state) -> tuple[np.ndarray, np.ndarray]:
        """Users and times of all elements of a list."""
        names, at = [np.array([], object)], [np.array([], "int64")]
        for distinct, codes, times in state.get():
            names.append(np.array(json.loads(distinct), object)[np.frombuffer(codes, "int32")])
            at.append(np.frombuffer(times, "int64"))
        return np.concatenate(names), np.concatenate(at)

    def _added(self, state, new: pd.DataFrame, needed: bool) -> tuple[np.ndarray, np.ndarray]:
        if len(new):
            state.appendValue(self._packed(new["who"].to_numpy(), new["row_at"].to_numpy("int64")))
        return self._held(state) if needed else (None, None)

    def _without(self, state, users: set) -> None:
        names, at = self._held(state)
        keep = ~pd.Series(names, dtype=object).isin(users).to_numpy(bool)
        state.clear()
        if keep.any():
            state.put([self._packed(names[keep], at[keep])])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        width, max_velocity, high_units, alert = self.rule
        messages = _joined(rows)
        kind = messages["kind"].to_numpy()
        own, told = messages[kind == ROW], messages[kind == KNOWN]
        at, units = own["row_at"].to_numpy("int64"), own["units"].to_numpy("int64")
        known_of, known_at = self._added(self.own, own, len(at) > 0)
        leaving_of, leaving_at = self._added(self.leaving, messages[kind == LEAVING], len(at) > 0)
        if len(at):
            # One whole number per user and time, so that one search serves all users.
            users, _ = pd.factorize(np.concatenate([known_of, leaving_of, own["who"].to_numpy()]))
            times, ranks = np.unique(np.concatenate([known_at, leaving_at + width, at]), return_inverse=True)
            places = users.astype("int64") * len(times) + ranks
            known = np.sort(places[:len(known_at)])
            leaving = np.sort(places[len(known_at):len(places) - len(at)])
            here = places[len(places) - len(at):]
            first = users[len(places) - len(at):].astype("int64") * len(times)
            inside = own["who"].map(told.groupby("who")["units"].sum()).fillna(0).to_numpy("int64")
            velocity = (np.searchsorted(known, here, side="right") - np.searchsorted(known, first) + inside
                        + np.searchsorted(leaving, first + len(times)) - np.searchsorted(leaving, here))
            score = rules.VELOCITY_POINTS * (velocity > max_velocity)
            score = score + rules.AMOUNT_POINTS * (units > high_units)
            yield pd.DataFrame({
                "who": own["who"].to_numpy(), "id": own["row_id"].to_numpy(), "at": at,
                "velocity": velocity.astype("int64"), "score": score.astype("int32"),
                "is_alert": score > alert})
        if (kind == FORGET).any():
            users = set(messages.loc[kind == FORGET, "who"])
            self._without(self.own, users)
            self._without(self.leaving, users)

    def close(self) -> None:
        pass


def velocity_sliced(
    sdf: DataFrame,
    user: str = "user_id",
    amount: str = "amount",
    ts: str = "created_at",
    id_col: str = "id",
    slice_width: str = "1 minute",
    window: str = rules.WINDOW,
    max_velocity: int = rules.MAX_VELOCITY,
    high_amount: float = rules.HIGH_AMOUNT,
    alert: int = rules.ALERT_ABOVE,
    delay: str = "10 minutes",
    scale: int = 2,
    idle: str | None = None,
) -> DataFrame:
    """`agents.velocity_stream` without a task that holds one user's rows.

    ``window`` is a whole number of slices. A row's count is that of its own slice up to its
    time, of the whole slices inside its window, and of those rows of the slice in which its
    window begins that are still inside. So each row goes to two slices, its own and the one
    a window later, and only counts go to the user's own task. All rows are judged; those more than ``delay``
    behind the user's newest row may miss some of the rows before them, which are forgotten
    then. ``idle`` is as for `anomaly_sliced`.
    """
    ship_package(sdf.sparkSession)
    width, slice_micros = duration_micros(window), duration_micros(slice_width)
    slices = width // slice_micros
    if slices * slice_micros != width or not slices:
        raise ValueError(f"{window} is not a whole number of slices of {slice_width}")
    rows = _rows(sdf, user, amount, ts, id_col, scale, slice_micros)
    id_kind = rows.schema["row_id"].dataType.simpleString()
    counts = rows.select("lot", "who", "slice").mapInPandas(
        _counted, "lot int, who string, slice long, n long")
    mode = "None" if idle is None else "ProcessingTime"
    delay_slices = -(-duration_micros(delay) // slice_micros)
    known = counts.groupBy("lot").transformWithStateInPandas(
        CountScan(slices, delay_slices, _millis(idle)), _messages(id_kind), "Append", mode)
    # Both uses of a row are made of one reading of it.
    uses = F.explode(F.array(
        F.struct(F.col("slice").alias("to"), F.lit(ROW).alias("kind")),
        F.struct((F.col("slice") + slices).alias("to"), F.lit(LEAVING).alias("kind"))))
    sent = rows.select("lot", "who", "row_id", "row_at", "units", uses.alias("use")).select(
        "lot", "who", F.col("use.to").alias("slice"), "use.kind", "row_id", "row_at", "units",
        F.lit(None).cast("binary").alias("known"))
    judged = sent.unionByName(known).groupBy("lot", "slice").transformWithStateInPandas(
        VelocityJudge(width, max_velocity, round(high_amount * 10**scale), alert),
        f"who string, id {id_kind}, at long, velocity long, score int, is_alert boolean",
        "Append", mode)
    return named_result(with_users(judged, sdf.schema[user].dataType), user, ts, id_col)
