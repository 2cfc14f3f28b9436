"""Surrogate ids for rows that have none."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import checkpointed

ROW_BITS = 33  # monotonically_increasing_id: partition above, row in partition below


def assign_ids(
    df: DataFrame, name: str = "id", dense: bool = True, order_by: tuple[str, ...] = ()
) -> DataFrame:
    """Adds a unique long id; ``dense`` makes it 1..N.

    Dense ids are a per-partition row number plus the rows of all earlier
    partitions, so no task ever sees more than its own partition. The numbered
    rows are written to the checkpoint folder first: a re-run task could
    otherwise place rows differently from the run that was counted. With
    ``order_by`` the ids follow that order, through a distributed sort.
    """
    if order_by:
        df = df.orderBy(*order_by)
    if not dense:
        return df.withColumn(name, F.monotonically_increasing_id())
    numbered = checkpointed(df.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_row"), ROW_BITS)
    in_part = F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition, so a single ordered task over it stays small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + in_part + 1)
        .drop("_part", "_row", "_before")
    )
