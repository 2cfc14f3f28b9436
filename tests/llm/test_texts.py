"""WARC archives, pieces, classifiers and the pipeline."""

import gzip
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from tidewell.llm import folds, pieces, quality, toxicity, warc

PAGES = "page_id long, url string, html string, digest string, offset int"


def pages(spark):
    long = "<p>" + "x" * 120 + "</p>"
    rows = [(i, f"http://a/{i} b\r\nX: y", f"<p>{i} é𝄞\r\n\r\nWARC/1.1</p>" * (i % 9)) for i in range(60)]
    rows += [(100 + i, "http://same", long) for i in range(40)] + [(100, "http://same", long)]
    rows += [(200, None, None), (201, "", ""), (202, "u", None), (203, "u", "short"), (204, "u", "short")]
    rows += [(None, "u", long), (None, "u", long + "!"), (None, "u", long + "!")]
    return rows, spark.createDataFrame([(*r, "own", 5) for r in rows], PAGES).repartition(4)


def test_archives_give_back_every_page(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 3000)
    monkeypatch.setattr(warc, "READ_BYTES", 900)
    monkeypatch.setattr(warc, "SPLIT_BYTES", 1000)
    rows, df = pages(spark)
    got = warc.archived(df, folder).collect()
    wanted = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        first = min(same, default=None) if len(raw) >= 100 else page_id
        revisit = page_id != first and first is not None
        wanted.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(),
                       "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, wanted))
    texts = {p: (h or "").encode() for p, _, h in rows if p is not None}
    assert all(bytes(r.payload) == texts[r.page_id] for r in got
               if r.page_id is not None and r.record_type == "response")
    names = os.listdir(folder)
    assert len(names) > 4
    raw = gzip.open(os.path.join(folder, names[0])).read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_selected_records_are_read_in_few_ranges(spark, folder):
    _, df = pages(spark)
    index = warc.write_archives(warc.with_originals(df.coalesce(1)), folder)
    some = index.where("page_id in (3, 4, 5, 50, 130)")
    assert sorted(r.page_id for r in warc.read_records(some).collect()) == [3, 4, 5, 50, 130]
    places = [("a", 0, 10), ("a", 10, 10), ("a", 20, 5), ("a", 10**6, 7), ("b", 10**6 + 7, 3)]
    assert [len(g) for _, g in warc.coalesced(places)] == [3, 1, 1]
    assert warc.archived(df.limit(0)).count() == 0


def test_damaged_records_are_refused():
    data = warc.record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), None, False)
    with pytest.raises(ValueError):
        warc._decoded(gzip.compress(data))
    with pytest.raises((ValueError, zlib.error)):
        warc._decoded(gzip.compress(data[:-3]))


TEXTS = [None, "", " ", "  a  b ", "hello world", "line\n\nend\ttab\r\n", "é ﬁ 𝄞 漢字 Ａ", "x" * 5000,
         "wordswithoutspaces" * 300, "   " * 40, "The quick brown fox, 12345.67!", "a b" * 1000,
         "\x00\x01", "tion ation the of and ing", "<0x0A> <s> </s> <unk>", "ÄÖÜ ß straße"]


@pytest.fixture(scope="module")
def coder():
    return pieces.Coder(pieces.Vocabulary(pieces.MODEL))


def test_texts_come_back(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pieces.decode(pieces.encode(docs)).collect()}
    assert {i: r.decoded for i, r in got.items()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert got[0].ids == [] and got[1].ids == []
    assert pieces.encode(docs.limit(0)).count() == 0
    shown = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert all(shown.decode(r.ids) == r.decoded for r in got.values())


def brute_path(coder, text):
    """Best sums by trying every piece at every place."""
    scores = {p: (s, i) for p, s, i in coder.vocabulary.pieces}
    best = [(0.0, None)]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - 16), end):
            if text[start:end] in scores:
                options.append(best[start][0] + scores[text[start:end]][0])
        if text[end - 1:end] not in scores:
            options.append(best[end - 1][0] + coder.unknown_score)
        best.append((max(options), None))
    return best[-1][0]


def test_paths_have_the_best_sum(coder):
    rng = random.Random(3)
    scores = {i: s for _, s, i in coder.vocabulary.pieces}
    names = [p for p, _, _ in coder.vocabulary.pieces]
    for _ in range(300):
        word = "▁" + "".join(rng.choice(names) for _ in range(rng.randint(1, 6))).replace("▁", "")
        path = coder.best_path(word)
        assert "".join(coder.vocabulary.surface[i] for i in path) == word
        assert abs(sum(scores[i] for i in path) - brute_path(coder, word)) < 1e-6


def test_paths_are_the_library_s_over_the_same_pieces(coder):
    # The same file, marked as a model whose pieces are chosen by the best sum.
    raw = open(pieces.MODEL, "rb").read()
    mark = b"\x18\x02 \x80\xfa\x01"
    assert raw.count(mark) == 1
    library = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(mark, b"\x18\x01 \x80\xfa\x01"))
    rng = random.Random(5)
    letters = "eeeaaiioutnsrhldcmfpgwybvkTAS.,'"
    for _ in range(200):
        text = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(5))
        assert coder.encode(text) == library.encode(text)


def test_cut_words_are_encoded_as_in_the_whole(coder):
    for text in TEXTS[2:]:
        assert coder.encode(text) == coder.best_path("▁" + text.replace(" ", "▁"))


def test_toxic_documents_are_learnt_from_positives_alone(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        text = rng.choices(words, k=rng.randint(5, 80)) + (["vile"] * 2 + [f"awful{i % 3}"] if toxic else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), "s"))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    rows += [(5000, None, "s"), (5001, "", "s"), (None, "vile awful1", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels + [(7777, 1), (2, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.p for r in toxicity.with_toxicity(docs, marks, "p").collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    right = [(got[i] >= 0.7) == (i % 8 == 0) for i in held]
    assert np.mean(right) > 0.97
    assert got[5000] == got[5001] < 0.7 and got[None] >= 0.7
    clean = toxicity.clean_documents(docs, marks)
    assert clean.columns == docs.columns and clean.where("doc_id = 5000").count() == 1
    none = toxicity.with_toxicity(docs, marks.limit(0), "p")
    assert none.count() == len(rows) and none.where("p > 0").count() == 0
    assert toxicity.with_toxicity(docs.limit(0), marks, "p").count() == 0


def slurs(n, rare_every):
    """Documents of plain words; each eighth toxic, and of these some with a rare slur."""
    rng, rows, labels = random.Random(11), [], []
    for i in range(n):
        text = rng.choices([f"w{k}" for k in range(400)], k=rng.randint(5, 40))
        if i % 8 == 0:
            text += ["vile", f"awful{i % 5}"] if i % (8 * rare_every) else ["zorblax"]
            labels.append((i, 1))
        elif i % 3 == 0:
            labels.append((i, 0))
        rows.append((i, " ".join(text)))
    return rows, labels


def test_telling_words_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "COUNTED", 500)
    rows, labels = slurs(1600, 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marked = {i for i, toxic in labels if toxic}
    toxic = docs.where(F.col("doc_id").isin(list(marked)))
    got = toxicity.telling_words(toxic, docs)
    everywhere, own = Counter(), Counter()
    for i, text in rows:
        everywhere.update(set(text.split()))
        own.update(set(text.split()) if i in marked else ())
    wanted = {}
    for word, k in own.items():
        expected = everywhere[word] * len(marked) / len(rows)
        if k > expected and k * np.log(k / expected) - (k - expected) >= np.log(max(len(everywhere) / toxicity.CHANCE, 1)):
            wanted[xxhash.xxh64_intdigest(word)] = (k, everywhere[word])
    assert xxhash.xxh64_intdigest("zorblax") in wanted
    assert dict(zip(got.words.tolist(), zip(got.own.tolist(), got.everywhere.tolist()))) == wanted
    assert (got.n_own, got.n_all) == (len(marked), len(rows)) and (np.diff(got.words.astype(float)) > 0).all()


def test_a_rare_slur_is_learnt_although_the_sample_lacks_it(spark, monkeypatch):
    rows, labels = slurs(8000, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "POSITIVES", 40)
    monkeypatch.setattr(toxicity, "UNLABELLED", 160)
    asked = spark.createDataFrame([(1, "w1 zorblax w2"), (2, "w1 w2"), (3, None)], "doc_id long, text string")
    scored = toxicity.with_toxicity(docs.union(asked), marks).where("text is null or text in ('w1 zorblax w2', 'w1 w2')")
    got = {r.doc_id: r.score for r in scored.collect() if r.doc_id < 4}
    assert got[1] >= 0.7 > max(got[2], got[3])


def test_slopes_are_those_of_the_non_negative_risk():
    rng = np.random.default_rng(3)
    for shift in (-1.0, 3.0):
        toxic, other = rng.normal(shift, 1, 7), rng.normal(0, 1, 9)

        def clean(t, o):
            return np.log1p(np.exp(o)).mean() - 0.4 * np.log1p(np.exp(t)).mean()

        def risk(t, o):
            return (0.4 * np.log1p(np.exp(-t)).mean() if clean(toxic, other) >= 0 else 0) + abs(clean(t, o))

        own, others = toxicity.risk_slopes(toxic, other, 0.4)
        for slopes, n, at in ((own, 7, 0), (others, 9, 1)):
            for k in range(n):
                step = np.eye(n)[k] * 1e-6
                up, down = ((toxic + s * step, other) if at == 0 else (toxic, other + s * step) for s in (1, -1))
                assert abs((risk(*up) - risk(*down)) / 2e-6 - slopes[k]) < 1e-6


def test_weights_from_counts_minimise_the_risk_of_a_words_documents():
    telling = toxicity.Telling(np.zeros(3, np.uint64), np.array([10, 400, 3]), np.array([30, 2000, 3]), 1000, 10000)
    for k, odds in enumerate(toxicity.counted_log_odds(telling, 0.2)):
        toxic = 0.2 * (telling.own[k] + 0.5) / 1001
        clean = max((telling.everywhere[k] + 0.5) / 10001 - toxic, 0)
        z = np.linspace(-8, 8, 16001)
        best = z[np.argmin(toxic * np.log1p(np.exp(-z)) + clean * np.log1p(np.exp(z)))]
        assert abs(odds - best) < 2e-3 or (odds < best and telling.own[k] / telling.everywhere[k] > 0.3)


def test_kept_words_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_BYTES", 20_000)
    coder = pieces.Coder(pieces.Vocabulary(pieces.MODEL))
    plain = {t: coder.best_path("\u2581" + t) for t in ("\u6587" * 5_000, "word")}
    for text in [f"x{i} y{i}" for i in range(2000)] + list(plain):
        coder.encoded(text)
        assert sum(map(len, coder.kept.values())) + 4 * sum(map(len, coder.kept)) < 25_000
    assert all(len(word) <= pieces.CACHED_LETTERS for word in coder.kept)
    assert all(coder.encode(t) == ids for t, ids in plain.items())


def test_encoding_beside_any_columns(spark):
    rows = spark.createDataFrame([("a b", [9], 1)], "text string, ids array<int>, `a.b` int")
    got = pieces.decode(pieces.encode(rows, name="own.ids"), name="back", ids="own.ids")
    assert got.columns == ["text", "ids", "a.b", "own.ids", "back"] and got.first()["back"] == "a b"


def test_archives_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, folder, monkeypatch):
    monkeypatch.setattr(warc, "SPLIT_BYTES", 2000)
    _, df = pages(spark)
    index = warc.write_archives(warc.with_originals(df), folder)
    size = index.agg(F.sum("length")).first()[0]
    read = warc.read_records(index)
    assert read.rdd.getNumPartitions() == 2 * size // 2000 > 4 and read.count() == index.count()
    assert warc.read_records(index.limit(0)).count() == 0


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for module, column, number, out in (
            (toxicity.with_toxicity, "toxic", 3, 1), (quality.with_quality, "quality", 4, 2)):
        flipped = labels.withColumn(column, F.when(
            folds.fold(F.col("doc_id"), number) == out, 1 - F.col(column)).otherwise(F.col(column)))
        a = {r.doc_id: r.score for r in module(docs, labels).collect()}
        b = {r.doc_id: r.score for r in module(docs, flipped).collect()}
        assert a == b and len(a) == docs.count()


def test_quality_on_held_out_labels(spark):
    sf = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("quality", F.lit("own"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").alias("quality"))
    marked = quality.with_quality(docs, labels).select("doc_id", "score").join(labels, "doc_id")
    held = marked.where(folds.fold(F.col("doc_id"), 4) == 2).collect()
    assert np.mean([(r.score >= 0.5) == bool(r.quality) for r in held]) > 0.93
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    scores = [r.score for r in quality.with_quality(blank, labels).collect()]
    assert scores[0] == scores[1] and 0 <= scores[0] <= 1
    assert quality.with_quality(docs.limit(0), labels).count() == 0


def plain_words(text):
    return re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+|[^0-9A-Za-z_\x80-\U0010ffff\s]+", text or "")


def plain_index(word):
    h, vector = xxhash.xxh64_intdigest(word.encode()), np.zeros(quality.WIDTH)
    for k in range(quality.NONZERO):
        bits = h >> 16 * k
        vector[bits % quality.WIDTH] += 1 if bits & 1 << 12 else -1
    return vector


QUALITY_TEXTS = [
    "Ein Wort, ein ein WORT!! é𝄞 _x 日本 (a) a a a", None, "", " \n", "...", "one", "one two", "ALL CAPS x1 X1 ?!? ?!",
    "the cat and the dog and the cat " * 9, "é", "\x1c sep\x1fsep", "rare unseen words here",
]


@pytest.mark.parametrize("cut", [1 << 17, 3])
def test_word_vectors_and_features_are_those_of_brute_force(spark, monkeypatch, cut):
    monkeypatch.setattr(quality, "SLICE", cut)
    monkeypatch.setattr(quality, "VOCABULARY", 12)
    monkeypatch.setattr(quality, "CHUNK_BYTES", 40 if cut == 3 else 1 << 22)
    texts = QUALITY_TEXTS * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    counts = Counter(w for t in texts for w in plain_words(t))
    frequent = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:12]
    sums = {w: np.zeros(quality.WIDTH) for w in frequent}
    for text in texts:
        words = plain_words(text)
        for i, w in enumerate(words):
            if w in sums:
                for j in range(max(0, i - 2), min(len(words), i + 3)):
                    sums[w] += plain_index(words[j]) if j != i else 0
    vectors = quality.word_vectors(docs)
    assert [w.decode() for w in vectors.vocabulary.to_pylist()] == frequent
    wanted = quality.WordVectors(vectors.vocabulary, np.array([sums[w] for w in frequent]))
    assert np.allclose(vectors.vectors, wanted.vectors, atol=1e-6)

    own = dict(zip(frequent, wanted.vectors.astype(float)))
    got = quality.features(pa.array(QUALITY_TEXTS), vectors)
    for text, x in zip(QUALITY_TEXTS, got, strict=True):
        words = plain_words(text)
        n = len(words)
        if not n:
            assert not x.any()
            continue
        v = np.array([own.get(w, plain_index(w) / max(np.linalg.norm(plain_index(w)), 1e-9)) for w in words])
        plain = [len(set(words)) / n, np.log1p(n) / 10,
                 sum(a == b for a, b in zip(words, words[1:])) / max(n - 1, 1),
                 sum(len(w) > 1 and w.isupper() for w in words) / n,
                 sum(re.match(r"[!-/:-@\[-^`{-~\x00-\x1f]", w) is not None for w in words) / n,
                 sum(map(len, words)) / n / 10]
        assert np.allclose(x, [*v.mean(axis=0), *v.std(axis=0), *plain], atol=1e-5), text


def test_every_word_has_its_own_vector_and_long_texts_count_words():
    names = pa.array([f"w{i}".encode() for i in range(3000)])
    assert len(np.unique(quality.index_vectors(names), axis=0)) > 2950
    none = quality.WordVectors(pa.array([], pa.binary()), np.zeros((0, quality.WIDTH)))
    x = quality.features(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (100, 5_000, 50_000)]), none)
    assert (x[:, 2 * quality.WIDTH] == 1).all()


def test_labelled_ids_with_several_texts_are_learnt_from_alike(spark):
    rows = [(i % 40, f"good words {i % 7} of prose" if i % 2 else "bad bad !!! bad") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    a, b = (sorted(map(tuple, quality.with_quality(d, labels).collect())) for d in (docs, docs.orderBy(F.rand(5))))
    assert a == b


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "lang", "source", "ids", "n_ids"] and got.count() > 0
    assert got.where("n_ids != size(ids)").count() == 0
