"""Secrets in texts: fixed patterns, and tokens that pass for random."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import let, text_id, written
from tidewell.llm.spans import counted, described, labelled, matches
from tidewell.plans.tables import table

# The kinds in their order, what they look like, and the alphabets.
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{14,}+", "hex": "(?<![0-9a-f])[0-9a-f]{16,}+"}
ASSIGN_LENGTH = 12
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {  # the smaller ones first; the last holds every token
    "decimal": (DIGITS, "^[0-9]+$"),
    "hex": (DIGITS + "abcdef", "^[0-9a-f]+$"),
    "hex_upper": (DIGITS + "ABCDEF", "^[0-9A-F]+$"),
    "lower": (LOWER, "^[a-z]+$"),
    "upper": (UPPER, "^[A-Z]+$"),
    "base32": (UPPER + "234567", "^[A-Z2-7]+$"),
    "base36": (LOWER + DIGITS, "^[a-z0-9]+$"),
    "letters": (UPPER + LOWER, "^[A-Za-z]+$"),
    "base64": (UPPER + LOWER + DIGITS + "+/", "^[A-Za-z0-9+/]+$"),
    "base64_url": (UPPER + LOWER + DIGITS + "-_", "^[A-Za-z0-9_-]+$"),
    "mixed": (UPPER + LOWER + DIGITS + "+/-_", "^[A-Za-z0-9+/_-]+$"),
}
LEVEL = 0.05  # share of wrong calls allowed among tokens called not random, and among secrets
WORD = r"[A-Za-z0-9+/_-]+"  # of the corpus, of fewer symbols than a token
TOKEN_LENGTH = 20
RECURS = 5  # occurrences that make a run of symbols a word, which random ones don't reach
SYMBOLS = UPPER + LOWER + DIGITS + "+/-_"
PRIOR = 20.0  # neighbours' worth of the even and single-symbol shares in the word model
ODDS_STEPS, MOST_ODDS = 10, 500  # steps per natural log of the odds, and the largest log
STEPS = 50  # steps per power of ten in which probabilities are counted
LAST = 300 * STEPS


def base_spans(text: Column) -> Column:
    """All matches of the three patterns that pass their test, as labelled spans."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        spans = matches(text, pattern)
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.length(
                F.regexp_extract(s["match"], ASSIGN, 1)) >= ASSIGN_LENGTH)
        found.append(labelled(spans, rank, kind))
    return F.concat(*found)


def _body(token: Column) -> Column:
    return F.rtrim(token, F.lit("="))


def encoding(token: Column) -> Column:
    """The smallest alphabet that holds all symbols of a token, padding aside; or null."""
    body, name = _body(token), F.lit(None).cast("string")
    for kind, (_, pattern) in reversed(ENCODINGS.items()):
        name = F.when(body.rlike(pattern), kind).otherwise(name)
    return name


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a rational approximation that keeps its
    relative precision in the tail."""
    # Coefficients of the approximation (Abramowitz and Stegun 26.2.17).
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)

    def tail(a, t):
        poly = F.lit(0.0)
        for c in reversed(terms):
            poly = (poly + c) * t
        return F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly

    above = let(F.abs(z), lambda a: let(1 / (1 + 0.2316419 * a), lambda t: tail(a, t)))
    return let(above, lambda q: F.when(z >= 0, q).otherwise(1 - q))


def _two_sided(z: Column) -> Column:
    return F.least(2 * _upper_tail(F.abs(z)), F.lit(1.0))


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, v: a + v)


def _pairs(array: Column, f) -> Column:
    """``f`` of each two neighbours."""
    less = F.size(array) - 1
    return F.zip_with(F.slice(array, 1, less), F.slice(array, 2, less), f)


def _even_counts(values: Column, n: Column, size: Column) -> Column:
    """Chi-squared: probability of symbol counts as uneven as these, or more."""
    squares = F.aggregate(
        F.array_sort(values),
        F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum")),
        # The k-th of equal symbols adds 2k - 1, the difference of two squares.
        lambda a, v: F.struct(
            v.alias("last"), F.when(v == a["last"], a["run"] + 1).otherwise(1).alias("run"),
            (a["sum"] + F.when(v == a["last"], 2 * a["run"] + 1).otherwise(1)).alias("sum")),
        lambda a: a["sum"])
    z = (size / n * squares - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    return let(z, _upper_tail)


def _runs(values: Column, n: Column, size: Column) -> Column:
    """Probability of so many or so few changes between the halves of the alphabet."""

    def judged(ones, changes):
        def against(mean):
            return let((mean - 1) * (mean - 2) / (n - 1), lambda variance: F.when(
                variance > 0,
                let((1 + changes - mean) / F.sqrt(variance), _two_sided),
            ).otherwise(2.0 * F.pow(F.lit(0.5), n)))  # one half only: n equal tosses

        return let(2 * ones * (n - ones) / n + 1, against)

    high = F.transform(values, lambda v: (v * 2 >= size).cast("double"))
    return let(high, lambda h: let(_total(h), lambda ones: let(
        _total(_pairs(h, lambda x, y: F.abs(x - y))), lambda changes: judged(ones, changes))))


def _serial(values: Column, n: Column, size: Column) -> Column:
    """Probability of so strong a correlation between neighbours."""
    middle, spread = (size - 1) / 2.0, (size * size - 1) / 12.0
    products = _total(_pairs(values, lambda x, y: (x - middle) * (y - middle)))
    return let(products / (spread * F.sqrt(n - 1)), _two_sided)


def not_random(token: Column) -> Column:
    """How unlikely a token's symbols are if each was drawn evenly from its alphabet: the
    combined probability of three tests, as -log10 in whole STEPS, or null without encoding.

    Chi-squared compares symbol counts with even ones, the runs test counts changes
    between the halves of the alphabet, and serial correlation compares neighbours. Fisher's
    method joins the three. Each uses exact means and variances, so short tokens are
    judged by what their length can show, and of long ones every symbol is.
    """
    body = _body(token)

    def steps(values, size):
        least = F.lit(1e-99)

        def joined(n):
            logs = [F.log(F.greatest(test(values, n, size), least))
                    for test in (_even_counts, _runs, _serial)]
            return -(logs[0] + logs[1] + logs[2])  # half of Fisher's statistic, 6 degrees

        half = let(F.size(values).cast("double"), joined)
        ten = let(half, lambda h: (h - F.log(1 + h + h * h / 2)) / math.log(10))
        return F.least(F.greatest(F.floor(ten * STEPS), F.lit(0)), F.lit(LAST)).cast("int")

    def judged(alphabet):
        return let(F.length(alphabet).cast("double"), lambda size: let(
            _symbols(alphabet, body), lambda values: steps(values, size)))

    return let(_alphabet(encoding(token)), judged)


def _alphabet(kind: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, (alphabet, _) in ENCODINGS.items():
        found = F.when(kind == name, alphabet).otherwise(found)
    return found


def _symbols(alphabet: Column, body: Column) -> Column:
    """Places of all of a token's symbols in an alphabet, in linear time."""
    return F.transform(F.split(body, ""), lambda c: F.instr(alphabet, c) - 1)


def word_model(docs: DataFrame) -> list[float]:
    """How structured text goes on: the log of each symbol's probability behind each other.

    Counted from all texts: the neighbouring symbols of every distinct word that occurs RECURS
    times. Pairs never seen fall back on the shares of single symbols, and these on even ones.
    The result has one number per pair of symbols, whatever the corpus.
    """
    runs = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))
    words = docs.select(F.explode(runs).alias("word")).where(
        F.length("word").between(2, TOKEN_LENGTH - 1)).groupBy("word").agg(F.count("*").alias("n"))
    known = words.where(F.col("n") >= RECURS).select("word", F.explode(
        F.expr("sequence(1, length(word) - 1)")).alias("at"))
    pairs = known.groupBy(F.substring("word", F.col("at"), F.lit(2)).alias("pair")).agg(
        F.count("*").alias("n"))
    counts = {r["pair"]: r["n"] for r in pairs.toArrow().to_pylist()}
    size = len(SYMBOLS)
    behind = {b: sum(counts.get(a + b, 0) for a in SYMBOLS) for b in SYMBOLS}
    before = {a: sum(counts.get(a + b, 0) for b in SYMBOLS) for a in SYMBOLS}
    total = sum(behind.values())
    share = {b: (behind[b] + PRIOR / size) / (total + PRIOR) for b in SYMBOLS}
    return [math.log((counts.get(a + b, 0) + PRIOR * share[b]) / (before[a] + PRIOR))
            for a in SYMBOLS for b in SYMBOLS]


def structured_odds(token: Column, model: Column) -> Column:
    """How much likelier a token's symbols are in words of the corpus than if drawn evenly from
    its alphabet: the log of the odds, in whole ODDS_STEPS."""
    def odds(values, size):
        known = _total(_pairs(values, lambda x, y: F.element_at(model, x * len(SYMBOLS) + y + 1)))
        step = F.floor((known + (F.size(values) - 1) * F.log(size)) * ODDS_STEPS)
        most = MOST_ODDS * ODDS_STEPS
        return F.least(F.greatest(step, F.lit(-most)), F.lit(most)).cast("int")

    body = _body(token)
    own = _alphabet(encoding(token))
    return let(F.length(own).cast("double"), lambda size: let(
        _symbols(F.lit(SYMBOLS), body), lambda values: odds(values, size)))


def candidates(text: Column, base: Column, model: Column) -> Column:
    """All tokens outside the base spans: (start, end, match, stratum, steps, odds). Words and
    numbers are among them; the tests and their limits leave them out."""
    tokens = F.filter(matches(text, TOKEN), lambda t: ~F.exists(
        base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return F.transform(tokens, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), t["match"].alias("match"),
        _stratum(t["match"]).alias("stratum"), not_random(t["match"]).alias("steps"),
        structured_odds(t["match"], model).alias("odds")))


def _stratum(token: Column) -> Column:
    """Tokens of like length, from one power of two to the next, by encoding."""
    return F.concat_ws("/", encoding(token), F.floor(F.log2(F.length(_body(token)))).cast("string"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document, without its text: ``doc_id, base, tokens``. Written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # A constant of some thousand numbers, read from one text so that the plan stays small.
    model = F.from_json(F.lit(json.dumps(word_model(docs))), "array<double>")
    found = docs.select("doc_id", text_id(F.col("doc_id"), F.col("text")).alias("_id"),
                        text.alias("_text"), base_spans(text).alias("base"))
    return written(
        found.withColumn("tokens", candidates(F.col("_text"), F.col("base"), model)).drop("_text"),
        "secrets-scan")


def discovery_limits(scanned: DataFrame) -> DataFrame:
    """Per stratum, the least number of steps at which a token is called not random.

    Benjamini and Hochberg's rule on the distinct tokens of the corpus: the largest
    probability p with p <= LEVEL * (tokens at p or below) / (all tokens). Probabilities
    are rounded up to steps, which keeps the rule valid, so a count for each step replaces
    a sort of all tokens. There are at most LAST steps in some hundreds of strata at most.
    """
    tokens = scanned.select(F.explode("tokens").alias("t")).select("t.match", "t.stratum", "t.steps")
    counts = (tokens.distinct().groupBy("stratum", "steps").agg(F.count("*").alias("n")))
    down = Window.partitionBy("stratum").orderBy(F.col("steps").desc())
    whole = Window.partitionBy("stratum")
    p = F.pow(F.lit(10.0), -F.col("steps") / STEPS)
    found = (counts.withColumn("below", F.sum("n").over(down))
             .withColumn("all", F.sum("n").over(whole))
             .where(p * F.col("all") <= LEVEL * F.col("below")))
    return found.groupBy("stratum").agg(F.min("steps").alias("limit"))


def secret_limits(scanned: DataFrame, limits: Column) -> DataFrame:
    """Per stratum, the largest odds of structure with which a token is reported.

    Of the distinct tokens that the tests don't call structured, each is wrongly reported with
    the probability odds / (1 + odds), words of the corpus and random symbols being held equally
    likely before. The limit is where the mean of these, over all tokens up to it, is still
    LEVEL: the expected share of false ones among those reported. It is found by counts per step.
    """
    tokens = scanned.select(F.explode("tokens").alias("t")).where(_passes(F.col("t"), limits)).select(
        "t.match", "t.stratum", "t.odds")
    counts = tokens.distinct().groupBy("stratum", "odds").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("stratum").orderBy("odds")
    wrong = 1 / (1 + F.exp(-F.col("odds") / ODDS_STEPS))
    found = (counts.withColumn("wrong", F.sum(F.col("n") * wrong).over(upto))
             .withColumn("all", F.sum("n").over(upto)).where(F.col("wrong") <= LEVEL * F.col("all")))
    return found.groupBy("stratum").agg(F.max("odds").alias("limit"))


def _as_map(limits: DataFrame) -> Column:
    """At most some hundreds of strata, one limit each, as a constant."""
    known = dict(limits.agg(F.collect_list(F.struct("stratum", "limit")).alias("all")).first()["all"])
    return F.from_json(F.lit(json.dumps(known)), "map<string,int>")


def _passes(token: Column, limits: Column) -> Column:
    """Whether the tests don't call a token structured."""
    return token["steps"] < F.coalesce(F.try_element_at(limits, token["stratum"]), F.lit(LAST + 1))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Each row's secrets: ``doc_id, base, spans`` (``spans`` with the random tokens).

    A token outside the patterns is a secret if the tests don't call it structured and the share
    of words and the like among those reported stays at LEVEL, by length and encoding. Null
    text is empty, a null id is kept, equal rows get equal spans, an empty table gives no
    rows, and further columns are ignored.
    """
    scanned = scan(docs)
    tested = _as_map(discovery_limits(scanned))
    reported = _as_map(secret_limits(scanned, tested))

    def passes(token):
        limit = F.coalesce(F.try_element_at(reported, token["stratum"]), F.lit(-MOST_ODDS * ODDS_STEPS - 1))
        return _passes(token, tested) & (token["odds"] <= limit)

    random = F.filter("tokens", passes)
    return scanned.select("doc_id", "base", F.concat(
        "base", labelled(random, len(PATTERNS), "random")).alias("spans"))


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[counted(F.col("base"), kind).alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(described(F.col("base")), 256).alias("base_sha256"),
        described(F.col("spans")).alias("spans"))
