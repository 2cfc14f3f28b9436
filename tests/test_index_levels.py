"""The token index in levels."""

import collections
import re

from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators import index_levels
from tidewell.session import new_dir

WORDS = ["alpha", "beta", "gamma", "delta", "Ünïcode", "x1"]


def texts(spark, first, n):
    parts = [F.element_at(F.array(*map(F.lit, WORDS)), (F.col("id") % k + 1).cast("int")) for k in (2, 3, 5)]
    return spark.range(first, first + n).select(
        "id", F.concat_ws(" ", F.lit("everywhere, Everywhere"), *parts, F.concat(F.lit("w"), F.col("id"))).alias("text"))


def plain(first, n, term):
    out = []
    for i in range(first, first + n):
        text = " ".join(["everywhere, Everywhere"] + [WORDS[i % k] for k in (2, 3, 5)] + [f"w{i}"])
        count = collections.Counter(re.findall("[a-z0-9]+", text.lower()))[term]
        if count:
            out.append((term, i, count))
    return sorted(out, key=repr)


def levels(spark, target):
    return sorted((r["level"], r["commit"]) for r in index_levels.index_parts(spark, target).select(
        "level", "commit").distinct().collect())


def test_levels_merge_and_give_the_same_postings(spark):
    target = new_dir(spark, "index")
    sink = index_levels.leveled_index_sink("id", "text", target, fan=3, file_bytes=20_000)
    for batch in range(7):
        for _ in range(1 + (batch in (2, 5))):  # batches that merge, twice
            sink(texts(spark, batch * 200, 200), batch)
    assert levels(spark, target) == [(0, 6), (1, 2), (1, 5)]
    for term in ("everywhere", "alpha", "w205", "nowhere", "x1"):
        assert rows(index_levels.lookup_blocks(spark, target, term)) == plain(0, 1400, term), term
    some = index_levels.lookup_blocks(spark, target, "everywhere", 300, 420)
    assert rows(some) == plain(300, 121, "everywhere")
    for batch in (7, 8):
        sink(texts(spark, batch * 200, 200), batch)
    assert levels(spark, target) == [(2, 8)]
    assert rows(index_levels.lookup_blocks(spark, target, "everywhere")) == plain(0, 1800, "everywhere")


def test_a_term_of_all_documents_fills_several_files_of_equal_size(spark):
    target = new_dir(spark, "index")
    index_levels.leveled_index_sink("id", "text", target, file_bytes=40_000)(texts(spark, 0, 20_000), 0)
    files = index_levels.index_parts(spark, target).collect()
    sizes = sorted(f.postings for f in files)
    assert len(sizes) > 6 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    holding = [f for f in files if f.first_term <= "everywhere" <= f.last_term]
    assert len(holding) >= 2
    opened = index_levels.lookup_blocks(spark, target, "w17").inputFiles()
    assert len(opened) < len(files) / 2
    found = index_levels.match_by_blocks(texts(spark, 0, 30), target, "id", "W17")
    assert rows(found.select("id")) == [(17,)]


def test_no_texts(spark):
    target = new_dir(spark, "index")
    sink = index_levels.leveled_index_sink("id", "text", target)
    sink(spark.createDataFrame([(1, None), (2, "")], "id long, text string"), 0)
    sink(texts(spark, 5, 2), 1)
    assert rows(index_levels.lookup_blocks(spark, target, "w5")) == [("w5", 5, 1)]
    assert rows(index_levels.lookup_blocks(spark, target, "nothing")) == []
