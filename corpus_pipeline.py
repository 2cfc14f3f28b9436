"""From documents to training tokens: five stages, each on all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import minhash, mixing, pieces, pii, toxicity
from tidewell.llm.common import written
from tidewell.plans.tables import table
from tidewell.session import ship_package


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents called toxic."""
    ship_package(spark)
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    ship_package(spark)
    return minhash.single_documents(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that reveal it; ``n_chars`` follows the text."""
    return pii.sanitised(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources reach their targets."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Turns texts into piece ids: ``doc_id, lang, source, ids, n_ids``."""
    ship_package(spark)
    encoded = pieces.encode(docs.select("doc_id", "lang", "source", "text"))
    return encoded.drop("text").withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near-duplicates", dedup_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
    ("pieces", encoding_stage),
]

# SQL can't express the classifier of the first stage or the pieces of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
