"""Trailing frames per key that stay balanced when one key holds much of the data.

Spark computes a window partition in one task. That is right for ordinary keys,
and the plain window is used while no key is large. The rows of larger keys are
sorted over the whole cluster and numbered by their place, as `assign_ids` does,
so they are cut by rank: a burst, or one row with a wrong time, moves no cut. The
results are the same as with one window per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.times import duration_micros, micros
from tidewell.session import checkpointed
from tidewell.sources.ids import ROW_BITS

SPLIT_ROWS = 2_000_000  # a key with more rows than this is cut into pieces
DENSE_ROWS = 5_000  # more rows than this in one time frame: count by rank instead
BROADCAST_ROWS = 200_000  # a table of keys or offsets up to this size may be broadcast


def _small(df: DataFrame) -> DataFrame:
    """``df`` written out, with a broadcast hint only if it proved to be small."""
    written = checkpointed(df)
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality on ``columns`` in which null equals null."""
    match = F.lit(True)
    for c in columns:
        match = match & left[c].eqNullSafe(right[f"_{c}_r"])
    return match


def _matchable(df: DataFrame, columns: list[str]) -> DataFrame:
    for c in columns:
        df = df.withColumnRenamed(c, f"_{c}_r")
    return df


def _parted(df: DataFrame, large: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys, and those of the ``large`` ones."""
    large = _matchable(_small(large.select(key)), [key])
    match = _same(df, large, [key])
    return df.join(large, match, "left_anti"), df.join(large, match, "left_semi")


def _sorted(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``df`` sorted over the cluster and written, each row with its partition ``_part``
    and the number ``_row``. Written, so that a re-run task can't number rows anew."""
    placed = checkpointed(
        df.orderBy(key, *order).withColumn("_row", F.monotonically_increasing_id()))
    return placed.withColumn("_part", F.shiftright(F.col("_row"), ROW_BITS))


def _with_earlier(placed: DataFrame, key: str, counted: Column) -> DataFrame:
    """Adds ``_first``, the key's first row in the partition, and ``_before``, the sum of
    ``counted`` over the key's rows in earlier partitions. One row per key and partition
    is summed, and few keys are in more than one."""
    parts = placed.groupBy(key, "_part").agg(
        F.min("_row").alias("_first"), F.sum(counted).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        key, "_part", "_first", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    offsets = _matchable(_small(offsets), [key, "_part"])
    return placed.join(offsets, _same(placed, offsets, [key, "_part"])).drop(f"_{key}_r", "__part_r")


def trailing_rows(
    df: DataFrame,
    key: str,
    order: tuple[str, ...],
    n: int,
    measures: dict[str, Column],
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Adds ``measures`` over the ``n`` rows of the key before each row, itself excluded.

    ``order`` starts with the time column and must order a key's rows fully. ``df``
    is read more than once: write it to a table first where it is costly.
    """
    if split_rows < n:
        raise ValueError("split_rows must be at least n")
    large = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > split_rows)
    large = checkpointed(large)
    frame = Window.partitionBy(key).orderBy(*order).rowsBetween(-n, -1)
    if large.isEmpty():
        return df.withColumns({name: m.over(frame) for name, m in measures.items()})
    usual, heavy = _parted(df, large, key)
    usual = usual.withColumns({name: m.over(frame) for name, m in measures.items()})

    placed = _with_earlier(_sorted(heavy, key, [F.col(c) for c in order]), key, F.lit(1))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    pieces = placed.withColumn("_place", place).withColumn(
        "_piece", F.floor(F.col("_place") / split_rows)).drop("_row", "_part", "_first", "_before")
    # The last n rows of a piece, which all hold split_rows, also go to the next as context.
    context = pieces.filter(F.pmod("_place", F.lit(split_rows)) >= split_rows - n).withColumn(
        "_piece", F.col("_piece") + 1)
    both = pieces.withColumn("_own", F.lit(True)).unionByName(
        context.withColumn("_own", F.lit(False)))
    in_piece = Window.partitionBy(key, "_piece").orderBy("_place").rowsBetween(-n, -1)
    judged = both.withColumns({name: m.over(in_piece) for name, m in measures.items()})
    return usual.unionByName(judged.filter("_own").drop("_own", "_piece", "_place"))


def trailing_count(
    df: DataFrame,
    key: str,
    ts: str,
    window: str,
    name: str,
    split_rows: int = SPLIT_ROWS,
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """Adds how many rows of the key lie within ``window`` up to each row's time.

    The row itself, rows exactly ``window`` old and rows with the same time all
    count. Rows need no id: equal ones are rows of their own.
    """
    width = duration_micros(window)
    per_span = df.groupBy(key, F.floor(micros(F.col(ts)) / width).alias("_span")).agg(
        F.count("*").alias("_n")
    )
    large = checkpointed(
        per_span.groupBy(key)
        .agg(F.sum("_n").alias("_total"), F.max("_n").alias("_densest"))
        .filter((F.col("_total") > split_rows) | (F.col("_densest") > dense_rows))
        .select(key)
    )
    frame = Window.partitionBy(key).orderBy(micros(F.col(ts))).rangeBetween(-width, 0)
    if large.isEmpty():
        return df.withColumn(name, F.count("*").over(frame))
    usual, heavy = _parted(df, large, key)
    counted = _count_by_rank(heavy, key, ts, width, name)
    return usual.withColumn(name, F.count("*").over(frame)).unionByName(counted)


def _count_by_rank(df: DataFrame, key: str, ts: str, width: int, name: str) -> DataFrame:
    """The same count as a difference: rows up to a time, less those before its frame.

    Every row is entered three times: before all rows at the start of its frame, at
    its time, where it counts, and behind all rows at its time. In the sorted entries, the
    rows counted before the last entry less those before the first are the count. A running
    sum needs the entries of one sorted partition only, so neither a key nor a burst is
    one task's work, and the work per row does not grow with the rows in its frame. Rows
    without a time count each other, as in a window.
    """
    rows = checkpointed(df.withColumn("_id", F.monotonically_increasing_id()))
    at = micros(F.col(ts))

    def entry(time: Column, turn: int) -> Column:
        return F.struct(time.alias("_at"), F.lit(turn).alias("_turn"))

    entries = rows.select(
        key, "_id", F.explode(F.array(entry(at - width, 0), entry(at, 1), entry(at, 2))).alias("_e")
    ).select(key, "_id", "_e._at", "_e._turn")
    counts = (F.col("_turn") == 1).cast("long")
    placed = _with_earlier(_sorted(entries, key, [F.col("_at"), F.col("_turn")]), key, counts)
    upto = Window.partitionBy("_part", key).orderBy("_row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("_rank", F.col("_before") + F.sum(counts).over(upto))
    signed = F.when(F.col("_turn") == 2, F.col("_rank")).when(F.col("_turn") == 0, -F.col("_rank"))
    counted = ranked.groupBy("_id").agg(F.sum(signed).alias(name)).withColumnRenamed("_id", "_of")
    return rows.join(counted, F.col("_id") == F.col("_of")).drop("_id", "_of")
