"""Training rows of a classifier: a fixed fold of labels, in a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sampled_ids(rows: DataFrame, limit: int, seed: int) -> DataFrame:
    """At most ``limit`` rows, those whose ids have the smallest hashes; ids not null."""
    return rows.where(F.col("doc_id").isNotNull()).orderBy(
        F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(limit)


def texts_of(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``sample`` with the texts of its documents. The sample's bound is the broadcast's."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(sample), "doc_id")
