"""Phrase collocations: stripes of next words, merged elementwise."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_batches, written
from tidewell.llm.words import LOWER, byte_class, chunks, split
from tidewell.plans.tables import table
from tidewell.session import ship_package

LONGEST = 4  # words of a phrase
SUPPORT = 30  # least count of a candidate
SUBSUMED = 80  # percent of a phrase's count in a longer candidate that drop it
SCALE = 2_000_000  # of scores
TOP = 2000  # phrases of a language
# What ends a piece of text and what stands between its words.
BREAKS = byte_class(*((ord(c), ord(c)) for c in ".,;:!?"), (0x0A, 0x0D))
WORD = ~(BREAKS | byte_class((0x20, 0x20), (0x09, 0x09)))
NO_LANG = "und"

CHUNK_BYTES = 1 << 23  # of text whose stripes are combined in a task
ROWS_OUT = 1 << 15  # stripes in an output batch
FILTER_BITS = 1 << 25  # of the filter of frequent pairs, whatever the corpus: 4 MB
SAMPLE = 64  # one text of so many is looked at for frequent first words
HOT = 1024  # first words with more than this part of all words are dealt to several tasks
SALTS = 256  # parts of a ranking
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]

STRIPES = ("lang string, size int, prefix string, slot int, next array<string>, n array<long>")


def _pair_hash(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (lang + first * MIX[0]) ^ (second * MIX[1] + (first >> np.uint64(31)))
    mixed = (mixed ^ (mixed >> np.uint64(33))) * MIX[2]
    return mixed ^ (mixed >> np.uint64(29))


def _hashes(values: pa.Array) -> np.ndarray:
    found = map(xxhash.xxh64_intdigest, values.cast(pa.large_binary()).to_pylist())
    return np.fromiter(found, np.uint64, len(values))


def _places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each pair."""
    bits = np.uint64(FILTER_BITS)
    return (hashes % bits).astype(np.int64), ((hashes >> np.uint64(32)) % bits).astype(np.int64)


class Chunk:
    """The words of some texts, with what their stripes need."""

    def __init__(self, rows: pa.Table, slots: dict[bytes, int]):
        texts, langs = (rows.column(c).combine_chunks() for c in ("text", "lang"))
        words = split(texts, WORD, BREAKS)
        langs = langs.fill_null(NO_LANG).dictionary_encode()
        own = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.langs, self.lang = langs.dictionary, np.repeat(own, words.sizes)
        self.words, self.codes = words.distinct, words.codes
        self.n = len(self.words)
        text = np.repeat(np.arange(len(own)), words.sizes)
        self.followed = np.zeros(len(self.codes), bool)  # by a word of the same piece
        self.followed[:-1] = ((text[1:] == text[:-1]) & (words.pieces[1:] == words.pieces[:-1]))
        names = self.words.to_pylist()
        self.slots = np.fromiter((slots.get(w, 1) for w in names), np.int64, self.n)
        self.part = np.fromiter(map(zlib.crc32, names), np.int64, self.n) >> 16

    def hashes(self) -> np.ndarray:
        """Of the pair that each followed word begins."""
        words, langs = _hashes(self.words), _hashes(self.langs)
        at = np.flatnonzero(self.followed)
        return _pair_hash(langs[self.lang[at]], words[self.codes[at]], words[self.codes[at + 1]])

    def counted(self, prefix: np.ndarray, following: np.ndarray):
        """Distinct (prefix, next word) in order, with their counts."""
        keys = np.sort(prefix * (self.n + 1) + following)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
        counts = np.diff(np.r_[first, len(keys)])
        return keys[first] // (self.n + 1), keys[first] % (self.n + 1), counts

    def stripes(self, size: int, prefix, following, counts, lang, first, names: pa.Array):
        """Rows of STRIPES. ``prefix`` numbers stripes in ascending order; ``lang`` and
        ``first`` (word) are per stripe, as are ``names``. The next words of a frequent first
        word are dealt to slots by their hash, so that its stripe is not one task's work."""
        salted = self.slots[first][prefix]
        part = np.append(self.part, 0)[following]
        slot = np.where(salted > 1, (part * salted) >> 16, 0)
        if (salted > 1).any():
            order = np.argsort(prefix * SALTS + slot, kind="stable")
            prefix, following, counts, slot = (x[order] for x in (prefix, following, counts, slot))
        new = np.r_[True, (prefix[1:] != prefix[:-1]) | (slot[1:] != slot[:-1])][:len(prefix)]
        starts = np.flatnonzero(new)
        ends = np.r_[starts[1:], len(prefix)]
        words = pa.concat_arrays([self.words.cast(pa.string()), pa.array([""])])
        for at in range(0, len(starts), ROWS_OUT):
            rows = slice(at, at + ROWS_OUT)
            low, high = int(starts[rows][0]), int(ends[rows][-1])
            offsets = pa.array(np.r_[starts[rows] - low, high - low].astype(np.int32))
            own = prefix[starts[rows]]
            yield pa.RecordBatch.from_arrays([
                self.langs.take(pa.array(lang[own])),
                pa.array(np.full(len(own), size, np.int32)),
                names.take(pa.array(own)),
                pa.array(slot[starts[rows]].astype(np.int32)),
                pa.ListArray.from_arrays(offsets, words.take(pa.array(following[low:high]))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[low:high].astype(np.int64))),
            ], names=["lang", "size", "prefix", "slot", "next", "n"])


def _pair_stripes(chunk: Chunk):
    """Stripes of single words. Each has its own total, as an entry without a word."""
    first = chunk.lang * chunk.n + chunk.codes
    at = chunk.followed
    prefix, following, counts = chunk.counted(
        np.r_[first, first[at]],
        np.r_[np.full(len(first), chunk.n), chunk.codes[1:][at[:-1]]])
    own = np.unique(prefix)
    code = own % chunk.n
    yield from chunk.stripes(
        2, np.searchsorted(own, prefix), following, counts, own // chunk.n, code,
        chunk.words.cast(pa.string()).take(pa.array(code)))


def _longer_stripes(chunk: Chunk, known: np.ndarray):
    """Stripes of two words and of three, of phrases all whose pairs may be frequent."""
    at = np.flatnonzero(chunk.followed)
    one, two = _places(chunk.hashes())
    may = np.zeros(len(chunk.codes), bool)
    may[at] = ((known[one >> 6] >> (one & 63).astype(np.uint64))
               & (known[two >> 6] >> (two & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    starts = np.flatnonzero(may)
    code, lang = chunk.codes, chunk.lang
    key = lang[starts] * chunk.n + code[starts]
    first, key = np.unique(key, return_inverse=True)
    prefixes, inverse = np.unique(key * chunk.n + code[starts + 1], return_inverse=True)
    words = chunk.words.cast(pa.string())
    own = first[prefixes // chunk.n]
    head, of_lang = own % chunk.n, own // chunk.n
    names = pc.binary_join_element_wise(
        words.take(pa.array(head)), words.take(pa.array(prefixes % chunk.n)), " ")
    number = np.full(len(code), -1)
    number[starts] = inverse
    for size in range(3, LONGEST + 1):
        # A phrase of one word more begins where this one does and its last pair may be frequent.
        last = size - 2
        starts = starts[starts + last < len(code)]
        starts = starts[may[starts + last]]
        prefix, following, counts = chunk.counted(number[starts], code[starts + last + 1])
        used, place = np.unique(prefix, return_inverse=True)
        yield from chunk.stripes(size, place, following, counts, of_lang[used], head[used],
                                 names.take(pa.array(used)))
        if size < LONGEST:
            keys = prefix * (chunk.n + 1) + following
            number[starts] = np.searchsorted(
                keys, number[starts] * (chunk.n + 1) + code[starts + last + 1])
            names = pc.binary_join_element_wise(
                names.take(pa.array(prefix)), words.take(pa.array(following)), " ")
            head, of_lang = head[prefix], of_lang[prefix]


def _stripes(docs: DataFrame, slots: dict[bytes, int], known=None) -> DataFrame:
    def run(batches):
        for rows in chunks(batches, "text", CHUNK_BYTES):
            chunk = Chunk(rows, slots)
            if len(chunk.codes):
                yield from (_pair_stripes(chunk) if known is None
                            else _longer_stripes(chunk, known.value))

    return docs.mapInArrow(run, STRIPES)


def _merged(stripes: DataFrame) -> DataFrame:
    """Stripes added up elementwise. All parts of a stripe's slot meet in one task and are
    summed there in Spark's hash tables, which spill; the sum needs no shuffle of its own."""
    keys = ["lang", "size", "prefix", "slot"]
    entries = stripes.repartition(*keys).select(
        *keys, F.inline(F.arrays_zip("next", "n")))
    return entries.groupBy(*keys, "next").agg(F.sum("n").alias("n")).drop("slot")


def _frequent_firsts(docs: DataFrame) -> dict[bytes, int]:
    """How many slots the stripes of frequent words are dealt to, by their share in one of
    SAMPLE texts. At most HOT words. Only where work is done depends on it."""
    def run(batches):
        for rows in chunks(batches, "text", CHUNK_BYTES):
            words = split(rows.column("text").combine_chunks(), WORD)
            counts = np.bincount(words.codes, minlength=len(words.distinct))
            some = np.flatnonzero(counts * 2 * HOT > len(words.codes))
            yield pa.RecordBatch.from_arrays(
                [words.distinct.cast(pa.string()).take(pa.array(some)), pa.array(counts[some]),
                 pa.array(np.full(len(some), 0))], names=["word", "n", "total"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.string()), pa.array([0]), pa.array([len(words.codes)])],
                names=["word", "n", "total"])

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(run, "word string, n long, total long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    top = counts.orderBy(F.desc_nulls_first("total"), F.desc("n")).limit(HOT + 1).toArrow()
    rows = top.to_pylist()
    total = max([r["total"] for r in rows], default=0)
    return {r["word"].encode(): min(SALTS, -(-r["n"] * HOT // total)) for r in rows
            if r["word"] is not None and r["n"] * HOT > total}


def _pair_filter(pairs: DataFrame):
    """A Bloom filter of frequent pairs, of a fixed size. A pair outside is not frequent;
    some that are inside may not be either, which costs work and changes nothing."""
    def run(batches):
        bits = np.zeros(FILTER_BITS // 64, np.uint64)
        for batch in batches:
            hashes = _pair_hash(*(_hashes(batch.column(c)) for c in ("lang", "prefix", "next")))
            for place in _places(hashes):
                np.bitwise_or.at(bits, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        used = np.flatnonzero(bits)
        for start in range(0, len(used), 1 << 16):
            some = used[start:start + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(bits[some].view(np.int64))], names=["at", "bits"])

    found = pairs.select("lang", "prefix", "next").mapInArrow(run, "at long, bits long")
    rows = found.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    known = np.zeros(FILTER_BITS // 64, np.uint64)
    known[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return pairs.sparkSession.sparkContext.broadcast(known)


def phrase_counts(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Phrases of one to LONGEST words by language: ``lang, size, prefix, next, n``.

    Single words come all, with a ``prefix`` and an empty ``next``; longer ones with at least
    ``support`` occurrences. Two passes over the texts: stripes of single words, then those
    of two and three words, for which only phrases made of frequent pairs are counted, since no
    others can be frequent.
    """
    ship_package(docs.sparkSession)
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    slots = _frequent_firsts(rows)
    pairs = written(_merged(_stripes(rows, slots)).where((F.col("n") >= support) | (F.col("next") == "")),
                    "phrases-pairs")
    known = _pair_filter(pairs.where("next <> ''"))
    longer = written(_merged(_stripes(rows, slots, known)).where(F.col("n") >= support), "phrases-longer")
    known.unpersist()
    return pairs.union(longer)


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """The strongest phrases per language: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``lang`` and ``text``; other columns are not read. A null text is empty, a
    null lang is `und`, an empty table gives no rows, repeated rows count each. Equal scores
    go by count, then by the phrase's bytes. Sums and products are wide decimals.
    """
    counts = phrase_counts(docs, support)
    exact = "decimal(20,0)"
    sizes = counts.where("next = ''").groupBy("lang").agg(F.sum("n").alias("total"))
    known = counts.where(F.col("n") >= support).select(
        "lang", "prefix", "next", "n", F.when(F.col("next") == "", F.lit(1)).otherwise(F.col("size")).alias("size"),
        F.when(F.col("next") == "", F.col("prefix")).otherwise(
            F.concat_ws(" ", "prefix", "next")).alias("phrase"))
    candidates = known.where("next <> ''")
    # A longer candidate's two phrases of one word less: its stripe's prefix, and all but its
    # first word. Phrases further inside are inside these, which are at least as frequent.
    rest = F.expr("substring(phrase, locate(' ', phrase) + 1)")
    longest = (candidates.where("size > 2")
               .select("lang", F.col("n").alias("m"), F.explode(F.array("prefix", rest)).alias("phrase"))
               .groupBy("lang", "phrase").agg(F.max("m").alias("m")))
    own = candidates.join(longest, ["lang", "phrase"], "left").where(
        F.col("m").isNull() | (F.col("m").cast(exact) * 100 < F.col("n").cast(exact) * SUBSUMED))
    words = F.split("phrase", " ")
    cuts = own.select("lang", "phrase", F.col("n").alias("a"), words.alias("w"),
                      F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"))
    parts = known.select("lang", "phrase", "n")
    cuts = (cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"])
            .join(parts.toDF("lang", "right", "r"), ["lang", "right"]))
    score = F.expr(f"cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0))"
                   " div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within parts of a language, so that no task sorts all its phrases.
    salted = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    ranked = near.where(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_OP12 = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
           lambda i: array_to_string(list_slice(w, i, i + m - 1), ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND a >= 30),
inside AS (
  SELECT lang, sub, max(a) AS a FROM (
    SELECT lang, c.a, array_to_string(list_slice(ws, i, j), ' ') AS sub
    FROM c JOIN (VALUES (1, 2), (2, 3), (3, 4), (1, 3), (2, 4)) s(i, j)
      ON j <= m AND j - i + 1 < m) GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.sub = c.phrase
  WHERE i.a IS NULL OR 100 * i.a < 80 * c.a),
cut AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, k, x.a AS l, y.a AS r,
         CAST(2000000 * CAST(cut.a AS HUGEINT) // (x.a + y.a) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(ws, 1, k), ' ')
           JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(ws, k + 1, cut.m), ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, t.n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
JOIN t USING (lang) WHERE rank <= 2000
"""
