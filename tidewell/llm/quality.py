"""Quality: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_batches, written
from tidewell.llm.folds import fold, sampled_ids, texts_of
from tidewell.llm.words import Words, byte_class, chunks, split
from tidewell.plans.tables import table
from tidewell.session import ship_package

FOLDS, HELD_OUT = 4, 2
LABELLED = 8_000  # documents learnt from, at most
VOCABULARY = 1 << 15  # most frequent words of the corpus, whose contexts make their vectors
WIDTH, NONZERO = 32, 4  # of a random index vector
WINDOW = 2  # words on each side that make a context
CHUNK_BYTES = 1 << 22  # of text taken at a time, and one text more
SLICE = 1 << 17  # words whose vectors are in memory at a time
HIDDEN, STEPS, RATE, DECAY = 16, 600, 0.01, 1e-3
VALIDATION = 5  # every so many-th labelled document calibrates the temperature
LIMIT = 0.7
# Words are runs of ASCII letters, digits and low lines and of all characters beyond
# ASCII; runs of other signs than white space are words too.
SPACE, SIGN = 0, 2
KINDS = np.full(256, SIGN, np.uint8)
KINDS[byte_class((0x30, 0x39), (0x41, 0x5A), (0x5F, 0x5F), (0x61, 0x7A), (0x80, 0xFF))] = 1
KINDS[byte_class((0x09, 0x0D), (0x1C, 0x20))] = SPACE
SURFACE = 6  # features of a document beside its vectors


def words_of(texts: pa.Array) -> Words:
    """Words and runs of other signs of whole texts, case kept."""
    return split(texts, KINDS, lower=False)


def index_vectors(words: pa.Array) -> np.ndarray:
    """The sparse random vector of each word, NONZERO times 1 or -1 at places that its own hash
    gives. No table of words is needed, and each word has its own."""
    values = words.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, values), np.uint64, len(values))
    vectors = np.zeros((len(values), WIDTH), np.int8)
    rows = np.arange(len(values))
    for k in range(NONZERO):
        bits = hashes >> np.uint64(16 * k)
        place = (bits % np.uint64(WIDTH)).astype(np.int64)
        np.add.at(vectors, (rows, place), np.where(bits & np.uint64(1 << 12), 1, -1).astype(np.int8))
    return vectors


def contexts(codes: np.ndarray, text: np.ndarray, index: np.ndarray, low: int, high: int) -> np.ndarray:
    """For each word from ``low`` to ``high``, the sum of its neighbours' index vectors in its
    own text. Neighbours may stand outside of that range."""
    around = np.zeros((high - low, WIDTH), np.int16)
    here = np.arange(low, high)
    for d in (*range(-WINDOW, 0), *range(1, WINDOW + 1)):
        there = np.clip(here + d, 0, len(codes) - 1)
        same = (here + d >= 0) & (here + d < len(codes)) & (text[there] == text[here])
        around += index[codes[there]] * same[:, None].astype(np.int8)
    return around


def _counted(batches):
    """Each chunk's words with their counts."""
    for rows in chunks(batches, "text", CHUNK_BYTES):
        found = words_of(rows.column("text").combine_chunks())
        counts = np.bincount(found.codes, minlength=len(found.distinct))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [found.distinct.take(pa.array(used)).cast(pa.binary()), pa.array(counts[used])], names=["word", "n"])


def frequent_words(docs: DataFrame) -> pa.Array:
    """The VOCABULARY most frequent words of all texts, of equal ones the first by their bytes."""
    counts = docs.select("text").mapInArrow(_counted, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY).toArrow()
    return top["word"].combine_chunks().cast(pa.binary())


def _summed(vocabulary):
    """One task's texts to context sums per vocabulary word. Memory is that of the vocabulary and
    of a chunk, and sums are whole numbers, so the order of tasks doesn't matter."""
    def run(batches):
        known = vocabulary.value
        sums, seen = np.zeros((len(known), WIDTH), np.int64), np.zeros(len(known), bool)
        for rows in chunks(batches, "text", CHUNK_BYTES):
            found = words_of(rows.column("text").combine_chunks())
            if not len(found.codes):
                continue
            index, number = index_vectors(found.distinct), numbers(found.distinct, known)
            text = np.repeat(np.arange(len(found.sizes)), found.sizes)
            for low in range(0, len(found.codes), SLICE):
                high = min(low + SLICE, len(found.codes))
                own = number[found.codes[low:high]]
                order = np.argsort(own, kind="stable")
                order = order[own[order] >= 0]
                ranked = own[order]
                first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]][:len(ranked)])
                if len(first):
                    around = contexts(found.codes, text, index, low, high)[order]
                    sums[ranked[first]] += np.add.reduceat(around, first, axis=0, dtype=np.int64)
                    seen[ranked[first]] = True
        used = np.flatnonzero(seen)
        vectors = pa.ListArray.from_arrays(
            pa.array(np.arange(len(used) + 1, dtype=np.int32) * WIDTH), pa.array(sums[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), vectors], names=["word", "vec"])
    return run


def numbers(words: pa.Array, vocabulary: pa.Array) -> np.ndarray:
    """The words' places in the vocabulary, -1 outside."""
    places = pc.index_in(words.cast(pa.binary()), value_set=vocabulary)
    return pc.fill_null(places, -1).to_numpy(zero_copy_only=False).astype(np.int64)


class WordVectors:
    """Unit vectors of words: from their contexts in the vocabulary, else their index vector."""

    def __init__(self, vocabulary: pa.Array, sums: np.ndarray):
        self.vocabulary = vocabulary
        vectors = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1)
        # What all words share, their company of the most frequent ones, tells nothing.
        used = vectors.any(axis=1)
        if used.any():
            vectors[used] -= vectors[used].mean(axis=0)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        self.vectors = (vectors / np.maximum(norms, 1e-9)).astype(np.float32)

    def of(self, words: pa.Array) -> np.ndarray:
        number = numbers(words, self.vocabulary)
        own = index_vectors(words).astype(np.float32)
        own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
        inside = number >= 0
        own[inside] = self.vectors[number[inside]]
        return own


def word_vectors(docs: DataFrame) -> WordVectors:
    """Vectors of the frequent words from their contexts in all documents, 8 MB at most.

    Each task sends its sums once, and Spark adds them up per word.
    """
    vocabulary = frequent_words(docs)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    parts = docs.select("text").mapInArrow(_summed(sent), "word long, vec array<long>")
    added = written(
        parts.groupBy("word").agg(*[F.sum(F.col("vec")[i]).alias(f"v{i}") for i in range(WIDTH)]),
        "quality-vectors").toArrow()
    sums = np.zeros((len(vocabulary), WIDTH))
    sums[added["word"].to_numpy()] = np.column_stack(
        [added[f"v{i}"].to_numpy() for i in range(WIDTH)])
    return WordVectors(vocabulary, sums)


def features(texts: pa.Array, vectors: WordVectors) -> np.ndarray:
    """Features of whole texts: the mean and the spread of their words' vectors, and plain
    measures of repetition, signs, case and length. A text without words has zeros."""
    found = words_of(texts)
    x = np.zeros((len(found.sizes), 2 * WIDTH + SURFACE))
    if not len(found.codes):
        return x
    own = vectors.of(found.distinct)
    text = np.repeat(np.arange(len(found.sizes)), found.sizes)
    total, squares = (np.zeros((len(found.sizes), WIDTH)) for _ in range(2))
    for low in range(0, len(found.codes), SLICE):
        part, of = own[found.codes[low:low + SLICE]].astype(np.float64), text[low:low + SLICE]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        total[of[first]] += np.add.reduceat(part, first, axis=0)
        squares[of[first]] += np.add.reduceat(part * part, first, axis=0)
    n = np.maximum(found.sizes, 1)

    def per_text(of_words: np.ndarray) -> np.ndarray:
        return np.bincount(text, of_words[found.codes], len(n)) / n

    names = found.distinct.cast(pa.string()).to_pylist()
    upper = np.array([len(w) > 1 and w.isupper() for w in names], float)
    signs = np.array([bool(w) and KINDS[ord(w[0])] == SIGN if w[:1].isascii() else False for w in names], float)
    lengths = np.array([len(w) for w in names], float)
    pairs = np.unique(text * len(names) + found.codes)
    distinct = np.bincount(pairs // len(names), minlength=len(n))
    again = (found.codes[1:] == found.codes[:-1]) & (text[1:] == text[:-1])
    repeats = np.bincount(text[1:][again], minlength=len(n)) / np.maximum(n - 1, 1)
    mean = total / n[:, None]
    spread = np.sqrt(np.maximum(squares / n[:, None] - mean * mean, 0))
    plain = [distinct / n, np.log1p(n) / 10, repeats, per_text(upper), per_text(signs), per_text(lengths) / 10]
    x = np.column_stack([mean, spread, *plain])
    x[found.sizes == 0] = 0
    return x


def _feature_parts(text: pd.Series, vectors: WordVectors):
    """Features of a batch of texts, CHUNK_BYTES at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array(text, pa.string(), from_pandas=True)], names=["text"])
    for rows in chunks(iter([batch]), "text", CHUNK_BYTES):
        yield features(rows.column("text").combine_chunks(), vectors)


def _in_parts(text: pd.Series, vectors: WordVectors):
    for part in _feature_parts(text, vectors):
        yield from part


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Two layers on standardised features, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rest = np.arange(len(y)) % VALIDATION == VALIDATION - 1
        if len(np.unique(y[~rest])) < 2 or not rest.any():
            rest = np.zeros(len(y), bool)
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.temperature = 1.0
        self._train(self._scaled(x[~rest]), y[~rest])
        if rest.any():
            self.temperature = self._calibrated(self.logits(x[rest]), y[rest])

    def _scaled(self, x):
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def _train(self, x, y):
        """Adam over the whole sample, on log loss with decay."""
        rng = np.random.default_rng(11)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.weights = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.log(share / (1 - share))]
        first, second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))
        for step in range(1, STEPS + 1):
            w1, _, w2, _ = self.weights
            hidden, out = self._forward(x)
            slope = (sigmoid(out) - y) / len(y)
            back = np.outer(slope, w2) * (1 - hidden * hidden)
            slopes = [x.T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ slope + DECAY * w2, slope.sum()]
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                pace = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                self.weights[i] = self.weights[i] - RATE * pace

    def _forward(self, x):
        w1, b1, w2, b2 = self.weights
        hidden = np.tanh(x @ w1 + b1)
        return hidden, hidden @ w2 + b2

    def logits(self, x):
        return self._forward(self._scaled(x))[1]

    @staticmethod
    def _calibrated(logits, y):
        """The temperature with the least log loss on documents not trained on."""
        choices = np.geomspace(0.25, 8, 121)
        losses = [np.logaddexp(0, np.where(y > 0, -1, 1) * logits / t).mean() for t in choices]
        return float(choices[int(np.argmin(losses))])

    def probability(self, x):
        return sigmoid(self.logits(x) / self.temperature)


def quality_model(docs: DataFrame, labels: DataFrame):
    """Word vectors and network, or the share of good documents where that is all there is.

    Vectors come from all texts; labels outside the held-out fold, a bounded sample of
    them, train the network, and only the sample's features reach the driver.
    """
    learnt = (labels.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
              .select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
              .where(F.col("quality").isNotNull()).groupBy("doc_id")
              .agg(F.max("quality").alias("quality")))
    sample = sampled_ids(learnt, LABELLED, 3)
    vectors = word_vectors(docs)

    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    @F.pandas_udf("array<double>")
    def measured(text: pd.Series) -> pd.Series:
        return pd.Series(list(_in_parts(text, sent.value)), index=text.index, dtype=object)

    rows = texts_of(docs, sample).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = rows.select("doc_id", F.col("quality").cast("double").alias("quality"),
                        measured("text").alias("x")).toArrow()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    y = found["quality"].to_numpy()[order]
    if len(np.unique(y)) < 2:
        return vectors, float(y.mean()) if len(y) else 0.5
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)[order]
    return vectors, Network(x, y)


def with_quality(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with the probability that a document is good, from its whole text.

    Null and empty texts have the score of no words, texts of any length are taken whole.
    Where the labels to learn from are of one kind, that share is every score; without any it is
    0.5, as for an empty table. Rows and other columns stay, and repeated rows have equal scores;
    of a labelled id with several texts the smallest is learnt from.
    """
    ship_package(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    vectors, network = quality_model(docs, labels)
    if isinstance(network, float):
        return docs.withColumn(name, F.lit(network))
    # Vectors of 8 MB at most and a network of some thousand weights, whatever the input.
    kept = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        own_vectors, own = kept.value
        parts = [own.probability(x) for x in _feature_parts(text, own_vectors)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return docs.withColumn(name, score("text"))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_quality(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"))
