"""Toxicity: non-negative positive-unlabelled learning on words."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ready_for_python, whole_row, written
from tidewell.llm.folds import fold, sampled_ids, texts_of
from tidewell.plans.tables import table

FOLDS, HELD_OUT = 3, 1
POSITIVES = 6_000  # confirmed toxic documents that weights are fitted to, at most
UNLABELLED = 18_000  # other documents that weights are fitted to, at most
VOCABULARY = 1 << 18  # words with a weight, at most; those with the most evidence
RARE = 5  # toxic documents of the sample that must hold a word for its weight to be fitted
COUNTED = 1 << 21  # words of documents that a task counts at a time
CHANCE = 100  # words of the corpus that may pass for telling by chance
MEMBERS = 3  # classifiers whose log-odds are averaged, each without its share of the sample
STEPS, RATE = 250, 1.0
SPARSITY = 2e-5  # price of a unit of weight, which leaves words without evidence at zero
LIMIT = 0.7
WORD = re.compile(r"\w+")


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the distinct words of a whole text in lower case, sorted."""
    words = set(WORD.findall((text or "").lower()))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def placed(words: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The places in ``known`` of those of ``words`` that it has. Both are sorted."""
    at = np.searchsorted(known, words)
    inside = at < len(known)
    at = at[inside]
    return at[known[at] == words[inside]]


class Rows:
    """Documents as sets of words."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.words = np.concatenate(sets) if sets else np.zeros(0, np.int32)
        self.of = np.repeat(np.arange(len(sets)), self.sizes)

    def scores(self, weights, bias):
        return bias + np.bincount(self.of, weights[self.words], minlength=len(self.sizes))

    def gradient(self, per_row, n):
        return np.bincount(self.words, per_row[self.of], minlength=n)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def softplus(x):
    return np.logaddexp(0, x)


def risk_slopes(toxic, other, prior: float):
    """Slopes of the non-negative risk by the scores of toxic and unlabelled documents.

    The risk of calling documents clean is that over the unlabelled ones less ``prior``
    times that over the toxic ones. The true one can't be negative; where the estimate is,
    the step goes against it, which keeps the toxic ones among the unlabelled from being
    learnt as clean.
    """
    clean = softplus(other).mean() - prior * softplus(toxic).mean()
    down, other_down = prior * sigmoid(toxic) / len(toxic), sigmoid(other) / len(other)
    if clean < 0:
        return down, -other_down
    return -prior * sigmoid(-toxic) / len(toxic) - down, other_down


def _counts(batches):
    """Partial document counts of words, for each COUNTED words of a task or so."""
    held, n = [np.zeros(0, np.uint64)], 0

    def sums():
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text"):
            held.append(word_hashes(text.as_py()))
            n += len(held[-1])
            if n >= COUNTED:
                yield sums()
                held, n = [np.zeros(0, np.uint64)], 0
    yield sums()


def document_counts(texts: DataFrame, name: str) -> DataFrame:
    """In how many rows each word stands: ``word, name``, words as hashes."""
    return (texts.select("text").mapInArrow(_counts, "word long, n long")
            .groupBy("word").agg(F.sum("n").alias(name)))


@dataclass
class Telling:
    """Words that are more frequent among toxic documents than chance allows, sorted, with
    the numbers of toxic and of all documents that hold each, and of documents."""

    words: np.ndarray
    own: np.ndarray
    everywhere: np.ndarray
    n_own: int
    n_all: int


def telling_words(toxic: DataFrame, learnt: DataFrame) -> Telling:
    """The telling words of ``toxic``, rows of ``learnt``, by counts over all of both.

    Were a word's documents toxic by chance, it would be in so many toxic ones with a
    probability of at most exp(-evidence) (Chernoff's bound), so that of all words of the
    corpus CHANCE at most are expected to pass. Only telling words get weights. Thousands of others
    would fit the sample by accident, and a long document's many words would then add up
    to a verdict. Of more than VOCABULARY those with the most evidence are taken.
    """
    n_own, n_all = toxic.count(), learnt.count()
    if not n_own:
        return Telling(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0, n_all)
    everywhere = written(document_counts(learnt, "everywhere"), "toxicity-words")
    least = math.log(max(everywhere.count() / CHANCE, 1))
    own, expected = F.col("own"), F.col("everywhere") * F.lit(n_own / n_all)
    found = (
        document_counts(toxic, "own").join(everywhere, "word").where(own > expected)
        .withColumn("evidence", own * F.log(own / expected) - (own - expected))
        .where(F.col("evidence") >= least)
        .orderBy(F.desc("evidence"), "word").limit(VOCABULARY).select("word", "own", "everywhere").toArrow())
    words = found["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return Telling(words[order], found["own"].to_numpy()[order],
                   found["everywhere"].to_numpy()[order], n_own, n_all)


def counted_log_odds(telling: Telling, prior: float) -> np.ndarray:
    """For each telling word, the log-odds that minimise the same risk over the documents
    that hold it, from their numbers alone.

    Of these documents the share prior * P(word | toxic) / P(word) is toxic. Where counts
    make that more than there are, the non-negative risk leaves none clean; half a document
    more or less keeps the odds finite and small counts modest.
    """
    toxic = (telling.own + 0.5) / (telling.n_own + 1)
    share = prior * toxic * (telling.n_all + 1) / (telling.everywhere + 0.5)
    share = np.minimum(share, 1 - 0.5 / (telling.own + 1))
    return np.log(share / (1 - share))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, n: int):
    """Weights of ``n`` words and bias of a linear classifier, on log loss, by Adagrad with
    soft thresholds."""
    p, u = Rows(positive), Rows(unlabelled)
    weights, bias = np.zeros(n), float(np.log(prior / (1 - prior)))
    squares, bias_square = np.full(n, 1e-8), 1e-8
    for _ in range(STEPS):
        p_slope, u_slope = risk_slopes(p.scores(weights, bias), u.scores(weights, bias), prior)
        slope = p.gradient(p_slope, n) + u.gradient(u_slope, n)
        down = p_slope.sum() + u_slope.sum()
        squares += slope * slope
        bias_square += down * down
        pace = RATE / np.sqrt(squares)
        weights = weights - pace * slope
        weights = np.sign(weights) * np.maximum(np.abs(weights) - pace * SPARSITY, 0)
        bias -= RATE * down / np.sqrt(bias_square)
    return weights, bias


def calibrate(toxic, other, prior: float):
    """Scale and shift that make log-odds of scores, by the same risk."""
    scale, shift = 1.0, 0.0
    squares = np.full(2, 1e-8)
    for _ in range(1000):
        p_slope, u_slope = risk_slopes(scale * toxic + shift, scale * other + shift, prior)
        slope = np.array([p_slope @ toxic + u_slope @ other, p_slope.sum() + u_slope.sum()])
        squares += slope * slope
        step = 0.1 * slope / np.sqrt(squares)
        scale, shift = max(scale - step[0], 0.1), shift - step[1]
    return scale, shift


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, telling: Telling):
    """The mean of MEMBERS classifiers, calibrated. Each leaves out its share of the sample,
    and the scores of what each left out calibrate them all. A telling word that hardly
    any toxic document of the sample holds has its weight from the counts."""
    n = len(telling.words)
    weights, bias, toxic, other = np.zeros(n), 0.0, [], []
    members = MEMBERS if min(len(positive), len(unlabelled)) >= 2 * MEMBERS else 1
    for m in range(members):
        p_in, u_in = ([w for i, w in enumerate(x) if members == 1 or i % members != m]
                      for x in (positive, unlabelled))
        own, own_bias = train(p_in, u_in, prior, n)
        weights, bias = weights + own / members, bias + own_bias / members
        toxic.append(Rows(positive[m::members]).scores(own, own_bias))
        other.append(Rows(unlabelled[m::members]).scores(own, own_bias))
    scale, shift = calibrate(np.concatenate(toxic), np.concatenate(other), prior)
    bias = scale * bias + shift
    seen = Rows(positive).gradient(np.ones(len(positive)), n)
    by_counts = np.maximum(counted_log_odds(telling, prior) - bias, 0)
    return np.where(seen < RARE, by_counts, scale * weights), bias


def toxicity_model(docs: DataFrame, labels: DataFrame):
    """Telling words, their weights and the bias, or None where no toxic document may be
    learnt from.

    The class prior is the toxic share of the labels that may be learnt from. Unlabelled
    are all documents outside the held-out fold, whatever their labels, which are not
    used. Words are counted over all of them; the weights are fitted to bounded samples,
    of which only places of telling words reach the driver. An id with several texts is
    counted by all of them and fitted to the smallest.
    """
    own_fold = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    marks = (labels.where(own_fold).select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
             .where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not share:
        return None
    prior = min(float(share), 0.99)
    confirmed = written(marks.where("toxic = 1").select("doc_id"), "toxicity-confirmed")
    learnt = docs.where(own_fold & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    telling = telling_words(learnt.join(confirmed, "doc_id", "left_semi"), learnt)
    if not telling.n_own:
        return None
    known = telling.words

    @F.pandas_udf("array<int>")
    def places(text: pd.Series) -> pd.Series:
        return text.map(lambda t: placed(word_hashes(t), known).astype(np.int32))

    def sets(ids, limit, seed):
        sample = sampled_ids(ids, limit, seed)
        rows = texts_of(learnt, sample).groupBy("doc_id").agg(F.min("text").alias("text"))
        found = rows.select("doc_id", places("text").alias("words")).toArrow()
        order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
        return [found["words"][int(i)].values.to_numpy() for i in order]

    positive = sets(learnt.select("doc_id").distinct().join(confirmed, "doc_id", "left_semi"), POSITIVES, 1)
    unlabelled = sets(learnt.select("doc_id").distinct(), UNLABELLED, 2)
    return known, *fit(positive, unlabelled, prior, telling)


def with_toxicity(docs: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``docs`` with the probability that a document is toxic, from its whole text.

    Null and empty texts have the score of no words, texts of any length are read whole, and
    equal texts have equal scores. Without a toxic document to learn from, all scores are 0;
    an empty table gives no rows. Rows and other columns stay as they are, so give a
    ``name`` that none of them has. Equal input gives equal scores in every run.
    """
    ready_for_python(docs.sparkSession)
    model = toxicity_model(docs, labels)
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    # 16 bytes for each of at most VOCABULARY words.
    kept = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        known, weights, bias = kept.value
        odds = [bias + weights[placed(word_hashes(t), known)].sum() for t in text]
        return pd.Series(odds, dtype="float64").map(sigmoid)

    return docs.withColumn(name, score("text"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those called toxic; columns unchanged, whatever their names. Null and
    empty texts, repeated rows and empty tables are as in with_toxicity."""
    rows = docs.select(whole_row(docs).alias("_row"), "doc_id", "text")
    return with_toxicity(rows, labels).where(F.col("score") < LIMIT).select("_row.*")


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"))
