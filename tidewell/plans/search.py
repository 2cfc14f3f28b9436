"""Substring and token search over documents."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import index_levels, search
from tidewell.operators.aggregates import topk_groups
from tidewell.plans.tables import table
from tidewell.session import new_dir
from tidewell.sources.files import in_order_of
from tidewell.streaming.runner import run_to_end, scratch, start_query

TERM = "license"


def like_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.contains_count(
        docs, "text", TERM, "source", eq={"lang": "en"}, ignore_case=False
    )


def filter_eq_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.contains_count(docs, "text", TERM, "source", eq={"lang": "en"})


def filter_in_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search.contains_count(docs, "text", TERM, "source", isin={"lang": ["en", "de"]})


def _by_source(docs: DataFrame) -> DataFrame:
    return topk_groups(docs, "source", F.count("*"), None, "match_count")


def text_match_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'")
    return _by_source(search.text_match(docs, "text", TERM))


def _index(spark: SparkSession, sf_dir: str) -> str:
    path = new_dir(spark, "text-index")
    search.build_text_index(table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return path


@functools.cache
def _kept_index(spark: SparkSession, sf_dir: str) -> str:
    """An index built once per session: searches share it, as they would a stored table."""
    return _index(spark, sf_dir)


def build_text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_terms(spark.read.parquet(_index(spark, sf_dir)), 50)


def text_match_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = spark.read.parquet(_kept_index(spark, sf_dir))
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'")
    return _by_source(search.text_match_indexed(docs, index, "doc_id", TERM))


def text_index_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents indexed as they arrive, then searched through that index."""
    out, checkpoints = scratch(spark, "index-stream")
    docs = table(spark, sf_dir, "documents")
    sink = search.index_sink("doc_id", "text", out, search.bucket_count(docs))
    arriving = in_order_of(docs, "doc_id", new_dir(spark, "documents-in-order"))
    run_to_end(start_query(arriving, "index", sink, checkpoints))
    search.compact_index(spark, out)
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'")
    index = search.read_index(spark, out)
    return _by_source(search.text_match_indexed(docs, index, "doc_id", TERM))


def text_index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents indexed in levels, of which the last micro-batch merges one; then searched."""
    out, checkpoints = scratch(spark, "index-levels")
    docs = table(spark, sf_dir, "documents")
    arriving = in_order_of(docs, "doc_id", new_dir(spark, "documents-in-order"))
    sink = index_levels.leveled_index_sink("doc_id", "text", out)
    run_to_end(start_query(arriving, "index_levels", sink, checkpoints))
    docs = table(spark, sf_dir, "documents").filter("lang = 'en'")
    return _by_source(index_levels.match_by_blocks(docs, out, "doc_id", TERM))


QUERIES = {
    f.__name__: f
    for f in (
        like_group_count, filter_eq_contains, filter_in_contains, text_match_scan,
        build_text_index, text_match_indexed, text_index_stream,
        text_index_levels,
    )
}

_TOKEN_MATCH = """
        SELECT source, count(*) AS match_count FROM documents
        WHERE lang = 'en'
          AND regexp_matches(lower(text), '(^|[^a-z0-9])license([^a-z0-9]|$)')
        GROUP BY source ORDER BY match_count DESC, source"""

ORACLE = {
    "like_group_count": """
        SELECT source, count(*) AS match_count FROM documents
        WHERE text LIKE '%license%' AND lang = 'en'
        GROUP BY source ORDER BY match_count DESC, source""",
    "filter_eq_contains": """
        SELECT source, count(*) AS match_count FROM documents
        WHERE lower(text) LIKE '%license%' AND lang = 'en'
        GROUP BY source ORDER BY match_count DESC, source""",
    "filter_in_contains": """
        SELECT source, count(*) AS match_count FROM documents
        WHERE lower(text) LIKE '%license%' AND lang IN ('en', 'de')
        GROUP BY source ORDER BY match_count DESC, source""",
    "text_match_scan": _TOKEN_MATCH,
    "text_match_indexed": _TOKEN_MATCH,
    "text_index_stream": _TOKEN_MATCH,
    "text_index_levels": _TOKEN_MATCH,
    "build_text_index": """
        SELECT term, count(*) AS doc_count, CAST(sum(tf) AS BIGINT) AS term_count FROM (
            SELECT doc_id, term, count(*) AS tf FROM (
                SELECT doc_id,
                       unnest(regexp_split_to_array(lower(text), '[^a-z0-9]+')) AS term
                FROM documents)
            WHERE term <> '' GROUP BY doc_id, term)
        GROUP BY term ORDER BY doc_count DESC, term LIMIT 50""",
}
