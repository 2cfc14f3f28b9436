from collections import Counter

from conftest import SMALL, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.operators import search
from tidewell.plans.tables import table
from tidewell.session import data_files, new_dir

DOCS = [
    (1, "the license of the text", "en", "x"), (2, "License LICENSE license", "en", "y"),
    (3, "licensed", "en", "y"), (4, "", "en", "y"), (5, None, "en", "z"), (6, "license", "de", "x"),
]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")


def index_of(spark, df, **sizes):
    path = new_dir(spark, "index")
    search.build_text_index(df, "doc_id", "text", path, **sizes)
    return spark.read.parquet(path)


def test_contains_count_variants(spark):
    df = docs(spark)
    assert rows(search.contains_count(df, "text", "license", "source", {"lang": "en"}, ignore_case=False)) == [
        ("x", 1), ("y", 2)]
    got = search.contains_count(df, "text", "LICENSE", "source", isin={"lang": ["en", "de"]})
    assert [tuple(r) for r in got.collect()] == [("x", 2), ("y", 2)]


def test_case_sensitive_search_is_pushed_down(spark):
    df = search.contains_count(
        table(spark, SMALL, "documents"), "text", "license", "source", {"lang": "en"},
        ignore_case=False,
    )
    text = plan(df)
    assert "StringContains(text,license)" in text and "EqualTo(lang,en)" in text


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abAB1 -.é\n", max_size=30), min_size=1, max_size=15))
def test_postings_count_tokens(spark, texts):
    import re

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.term): r.tf for r in search.postings(df, "doc_id", "text").collect()}
    want = {}
    for i, text in enumerate(texts):
        for term, n in Counter(t for t in re.split("[^a-z0-9]+", text.lower()) if t).items():
            want[i, term] = n
    assert got == want


def test_index_search_equals_scan(spark):
    df = docs(spark)
    for sizes in ({}, {"buckets": 3, "spread": 2}, {"buckets": 1, "spread": 1}):
        index = index_of(spark, df, **sizes)
        for term in ("license", "LICENSE", "the", "absent"):
            found = search.text_match_indexed(df, index, "doc_id", term)
            assert rows(found.select("doc_id")) == rows(
                search.text_match(df, "text", term).select("doc_id")), (sizes, term)


def test_an_index_grows_with_each_batch(spark):
    target = new_dir(spark, "index")
    sink = search.index_sink("doc_id", "text", target, buckets=4, spread=2)
    df = docs(spark)
    sink(df.filter("doc_id <= 2"), 0)
    sink(df.filter("doc_id > 2"), 1)
    sink(df.filter("doc_id > 2"), 1)
    found = search.text_match_indexed(df, search.read_index(spark, target), "doc_id", "license")
    assert rows(found.select("doc_id")) == [(1,), (2,), (6,)]
    assert search.lookup(search.read_index(spark, target), "license").count() == 3


def test_lookup_reads_one_bucket(spark):
    index = index_of(spark, table(spark, SMALL, "documents"), buckets=8, spread=2)
    found = search.lookup(index, "license")
    folders = {f.rsplit("/", 2)[1] for f in found.inputFiles()}
    assert "PartitionFilters" in plan(found)
    read = found.select(F.input_file_name().alias("f")).distinct().collect()
    assert len({r.f.rsplit("/", 2)[1] for r in read}) <= 1
    assert len(folders) >= 1
    scanned = [line for line in plan(found).splitlines() if "FileScan" in line]
    assert "bucket#" in scanned[0].split("PartitionFilters:")[1].split("PushedFilters")[0]


def test_a_hot_term_is_spread_over_files(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same words").alias("text"))
    index = index_of(spark, df, buckets=2, spread=4)
    files = index.filter("term = 'same'").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(files) == 4
    assert max(r["count"] for r in files) < 1300


def test_top_terms(spark):
    got = search.top_terms(index_of(spark, docs(spark)), 2).collect()
    assert [tuple(r) for r in got] == [("license", 3, 5), ("licensed", 1, 1)]


def test_compaction_gives_each_share_of_a_bucket_its_own_task(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[
        F.concat(F.lit("w"), F.col("id") * k % 50) for k in range(1, 6)]).alias("text"))
    target = new_dir(spark, "index")
    write = search.index_sink("doc_id", "text", target, buckets=6)
    for batch_id in range(2):
        write(docs.filter(F.col("doc_id") % 2 == batch_id), batch_id)
    before = rows(search.read_index(spark, target).select("term", "doc_id", "tf"))
    search.compact_index(spark, target)
    assert rows(search.read_index(spark, target).select("term", "doc_id", "tf")) == before
    for bucket in range(6):
        folder = f"{target}/base/upto=1/buckets=6/bucket={bucket}"
        assert len(data_files(spark, folder)) == search.MIN_SPREAD
