"""Near-duplicates and connected components against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import components, minhash

SCHEMA = "doc_id long, text string, id string, n_shingles int"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 75 * (len(x) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(i) and rows[j][0] is not None]
        if not sets[i]:
            ids = [doc_id]
        least = min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return out


def corpus():
    rng = random.Random(4)
    word = [f"Wört{i}" if i % 5 else f"W{i}." for i in range(3000)]
    rows = []
    base = rng.choices(word, k=60)
    for i in range(220):  # copies with one or two words changed: a family without a center
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(60)] = rng.choice(word)
        rows.append((1000 + i, " ".join(copy)))
    passage = rng.choices(word, k=40)
    for i in range(120):  # a common passage in texts that are not alike enough
        rows.append((3000 + i, " ".join(passage + rng.choices(word, k=20))))
    for i in range(60):
        rows.append((5000 + i, " ".join(rng.choices(word, k=rng.randint(1, 90)))))
    rows += [(7000 + i, rows[5][1]) for i in range(50)]
    rows += [(1, "one two"), (2, "ONE\ttwo"), (3, "two one"), (4, None), (5, ""), (6, " \n\x0b"), (8, None)]
    rows += [(9, "É a b c d e"), (10, "é a b c d e"), (11, "a b c d e"), (12, "A B C D E"),
             (13, "a b c d e a b c d e a b c d e"), (None, "A b c d e"), (None, None), (None, "alone here"),
             (14, "x y z"), (15, "x y z"), (16, "twice the row"), (16, "twice the row"),
             (17, "long " * 30000), (18, "long " * 29000 + "end")]
    return rows


@pytest.mark.parametrize("tile", [512, 32])
def test_groups_match_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "SPLIT", 50)
    rows = corpus()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "own", -1) for i, t in rows], SCHEMA).repartition(4)
    found = minhash.near_duplicates(docs).drop("id")
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute(rows)))
    left = minhash.unique_documents(docs)
    assert left.columns == docs.columns
    kept = [r for r in brute(rows) if r[3]]
    assert left.count() == len(kept)


def test_one_row_of_each_group_stays_in_the_pipeline(spark):
    text = "one text of some words that is here " * 3
    rows = [(1, "twice the row", "x", 0), (1, "twice the row", "x", 0), (1, "twice the row", "y", 0),
            (2, text + "first", "x", 0), (2, text + "other", "x", 0), (3, text + "first", "x", 0),
            (4, "same id", "x", 0), (4, "another text", "x", 0), (None, "null ids alone", "x", 0),
            (None, "NULL ids alone", "x", 0), (5, None, "x", 0), (5, None, "x", 0), (6, None, "x", 0)]
    left = corpus_pipeline.dedup_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    assert left.columns == ["doc_id", "text", "id", "n_shingles"]
    got = [(r.doc_id, (r.text or "").lower()[:8]) for r in left.collect()]
    assert sorted(got, key=str) == sorted([(1, "twice th"), (2, "one text"), (4, "same id"), (4, "another "),
                                           (None, "null ids"), (5, ""), (6, "")], key=str)
    assert minhash.single_documents(left.limit(0)).count() == 0


def test_empty_and_blank_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(empty).count() == 0 and minhash.unique_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "", 0), (2, "", "", 0)], SCHEMA)
    assert minhash.near_duplicates(blank).where("kept").count() == 2


def test_bands_find_pairs_at_the_limit():
    rng = np.random.default_rng(8)
    missed = 0
    for _ in range(300):
        both, x, y = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 50, 50))
        a, b = (minhash.band_keys(minhash.signature(np.concatenate([both, own]))) for own in (x, y))
        missed += not (a == b).any()
    assert missed == 0


def test_signatures_lose_fewer_pairs_at_the_limit_than_bands():
    n, p = minhash.HASHES, minhash.SHARED / 100
    low = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(n) if i / n < minhash.SIGNATURE)
    assert low < (1 - p**minhash.ROWS)**minhash.BANDS


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    links = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 80)] + [(80, 81)],
             "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(90)], "none": []}[shape]
    rng.shuffle(links)
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(links + links[:5], "x long, y long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    least = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least


def test_shingles_are_whole_texts():
    long = " ".join(f"w{i}" for i in range(20000))
    assert len(minhash.shingles(long)) == 19996
    assert minhash.similar(minhash.shingles("a b c"), minhash.shingles("A\nB\tC"))
    assert not np.array_equal(minhash.shingles("a b"), minhash.shingles("b a"))


def test_hot_copies_stay_narrow(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the very same text in a third of all rows"))
        .otherwise(F.concat_ws(" ", *[F.xxhash64("id", F.lit(i)).cast("string") for i in range(8)]))
        .alias("text"))
    got = minhash.near_duplicates(docs)
    assert got.where("kept").count() == 2001
    assert got.where("component_id = 0").count() == 1000
