"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import new_dir, ship_package

# White space and words as the contracts define them.
SPACE = r"\x20\x09-\x0D"
FIRST_LETTERS = rf"[{SPACE}]*+([^{SPACE}])[^{SPACE}]*+|[{SPACE}]++"

BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again.

    Cuts the lineage as a checkpoint does, in a compact form that is pruned by
    column when read, and that outlives any executor.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Lets Python tasks take texts in small batches, unless the session's are smaller.

    Spark's default of 10,000 rows is much memory where rows are documents, for Python
    and for the buffers that the JVM keeps beside its heap. Batches of long texts are
    bounded in bytes by Spark itself.
    """
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def ready_for_python(spark: SparkSession) -> None:
    """Lets workers import this package, and take texts in small batches."""
    ship_package(spark)
    bounded_batches(spark)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_count(text: Column) -> Column:
    """Words of ``text``, 0 for null. Each word is cut to its first letter and these
    are counted, so no array of all words is held."""
    firsts = F.regexp_replace(text, FIRST_LETTERS, "$1")
    return F.coalesce(F.length(firsts), F.lit(0)).cast("long")


def text_id(doc_id: Column, text: Column) -> Column:
    """32 hex digits that tell rows apart by id and text; equal rows share them."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))]
    return F.md5(F.concat_ws("/", *parts))
