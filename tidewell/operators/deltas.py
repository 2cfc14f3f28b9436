"""Tables kept as a folded base plus one folder per later batch.

Layout under a target: ``base/upto=<n>`` holds batches up to ``n`` merged, and
``delta/batch=<n>`` the rows of batch ``n``. Readers take the newest complete
base and the batches after it, and merge them with the operator's own function.
Nothing is changed in place, so a reader or a lost task never sees half a write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.session import list_dirs, path_exists


def write_delta(df: DataFrame, target: str, batch_id: int) -> None:
    """Writes batch ``batch_id``; writing it again replaces it."""
    df.write.mode("overwrite").parquet(f"{target}/delta/batch={batch_id}")


def complete(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the completely written ``<name>=<number>`` folders, ascending."""
    return sorted(
        int(name.split("=", 1)[1])
        for name in list_dirs(spark, folder)
        if path_exists(spark, f"{folder}/{name}/_SUCCESS")
    )


def part_paths(spark: SparkSession, target: str) -> tuple[list[str], int]:
    """The folders that make up the table now, and the last batch among them."""
    bases = complete(spark, f"{target}/base")
    upto = bases[-1] if bases else -1
    batches = [b for b in complete(spark, f"{target}/delta") if b > upto]
    paths = [f"{target}/base/upto={upto}"] if bases else []
    paths += [f"{target}/delta/batch={b}" for b in batches]
    return paths, max([upto, *batches])


def read_parts(spark: SparkSession, target: str) -> DataFrame:
    paths, _ = part_paths(spark, target)
    if not paths:
        raise FileNotFoundError(f"nothing complete under {target}")
    return spark.read.parquet(*paths)


def fold(spark: SparkSession, target: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Writes a new base from all current parts; returns the last batch in it."""
    paths, last = part_paths(spark, target)
    if len(paths) > 1:
        merge(spark.read.parquet(*paths)).write.mode("overwrite").parquet(
            f"{target}/base/upto={last}"
        )
    return last
