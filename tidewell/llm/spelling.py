"""Spelling variants: a bit-sliced position index finds words one error apart."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import written
from tidewell.plans.tables import table
from tidewell.session import ship_package

# Letters of a word, and the ids' residue whose words lose a letter.
LETTERS = r"[a-z\x{00C0}-\x{00FF}]"
SPOILT = 199
LEAST_LENGTH = 6  # code points
LEAST_COUNT = 5  # occurrences of a word
RATIO = 5  # times as frequent a word's form is, at least

TILE_CHARS = 1 << 16  # letters of the words in one index
QUERIES = 512  # words looked up together

FOUND = "word string, n_near long, form_n long, form string"
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_counts(docs: DataFrame) -> DataFrame:
    """The words of all texts with their counts: ``word, n``.

    Words are the maximal runs of letters, of which a fixed one in SPOILT by the hash of id
    and run loses one. Shorter runs can't give a word. Counted per task before the shuffle.
    """
    runs = F.regexp_extract_all(
        F.translate(F.col("text"), *LOWER), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}+"), F.lit(0))
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    each = docs.select(doc_id.alias("id"), F.explode(runs).alias("run"))
    hashed = each.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    spoilt = F.concat(F.col("run").substr(F.lit(1), at),
                      F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % SPOILT == 0, spoilt).otherwise(F.col("run"))
    counts = hashed.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return counts.groupBy("word").agg(F.count("*").alias("n"))


def _halves(words: DataFrame) -> DataFrame:
    """Each word under four keys, of which words one error apart share at least one.

    Let m be the length of the shorter of two such words. The error is behind the first m/2
    letters, which are then equal, or not, and then the last m - m/2 are. A word may be the
    shorter one or the longer, so it stands under the halves of m = its length and one less.
    """
    length = F.length("word")
    keys = []
    for extra in (0, 1):
        m = length - extra
        half = F.floor(m / 2).cast("int")
        for side, part in ((0, F.col("word").substr(F.lit(1), half)),
                           (1, F.col("word").substr(length - (m - half) + 1, m - half))):
            keys.append(F.struct(m.alias("m"), F.lit(side).alias("side"),
                                 F.xxhash64(m, F.lit(side), part).alias("key")))
    return words.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("word", "n", "k.*")


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows dealt to index tiles: ``tile, block, own`` are the group, and the row's part in it.

    Keys of one word have no pair and go. Small keys share a tile by hash. A key with more
    than TILE_CHARS letters is cut into blocks, and each block of words is looked up in each,
    so no group grows with a key.
    """
    keys = written(rows.groupBy("key").agg(
        F.count("*").alias("words"),
        F.sum(F.length("word").cast("long")).alias("chars")).where("words > 1"), "spelling-keys")
    total = keys.agg(F.sum(F.when(F.col("chars") <= TILE_CHARS, F.col("chars")))).first()[0] or 0
    shared = total // TILE_CHARS + 1
    rows = rows.join(keys, "key").withColumn(
        "blocks", F.ceil(F.col("chars") / TILE_CHARS).cast("int"))
    small = rows.where("blocks = 1").select(
        "word", "n", "m", "side", "key",
        F.pmod(F.xxhash64("key"), F.lit(shared)).alias("tile"),
        F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(3).alias("part"))
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    large = rows.where("blocks > 1").withColumn("block", block).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = [large.select("word", "n", "m", "side", "key", F.col("key").alias("tile"),
                          F.col(r).alias("row"), F.col(c).alias("col"), F.lit(p).alias("part"))
             for r, c, p in (("block", "other", 1), ("other", "block", 2))]
    return small.unionByName(cells[0]).unionByName(cells[1])


class Slices:
    """Bitsets over some words, one per position and letter, in 64-bit words."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, letters: int):
        n, width = codes.shape
        self.n, self.words = n, -(-n // 64)
        self.lengths = lengths
        # A position behind any word's end has no letter.
        self.at = np.zeros((width + 2, letters + 1, self.words), np.uint64)
        for position in range(width):
            column = codes[:, position]
            for letter in np.unique(column[column > 0]):
                self.at[position, letter] = self.packed(column == letter)

    def packed(self, members: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, bool)
        padded[:self.n] = members
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray, start: np.ndarray):
        """Words one error from each query, all of one length, as three sets of bitsets:
        one letter replaced, one more, one less. ``start`` are the words each query may find.

        ``exact`` are the words without an error so far; of those with one error, ``same``
        stand at the query's position, ``ahead`` one further and ``behind`` one less. Each
        letter narrows all sets by the slice of its position, shifted for the last two.
        """
        zero = np.zeros_like(start)
        exact, same, ahead, behind = start, zero, start, zero
        for i in range(queries.shape[1]):
            letter = queries[:, i]
            here = self.at[i, letter]
            same = (same & here) | (exact & ~here)
            behind = (behind & self.at[i - 1, letter] if i else zero) | exact
            exact = exact & here
            ahead = (ahead & self.at[i + 1, letter]) | exact
        size = queries.shape[1]
        return (same & self.packed(self.lengths == size), ahead & self.packed(self.lengths == size + 1),
                behind & self.packed(self.lengths == size - 1))


def _members(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each set bit."""
    rows, words = np.nonzero(bits)
    flags = np.unpackbits(bits[rows, words].astype("<u8").view(np.uint8).reshape(-1, 8),
                          axis=1, bitorder="little")
    hit, bit = np.nonzero(flags)
    return rows[hit], words[hit] * 64 + bit


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Words as rows of letter numbers from 1, 0 behind the end; lengths; how many letters."""
    lengths = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    used, numbers = np.unique(points, return_inverse=True)
    codes = np.zeros((len(words), int(lengths.max())), np.int16)
    inside = np.arange(codes.shape[1])[None, :] < lengths[:, None]
    codes[inside] = numbers + 1
    return codes, lengths, len(used)


def _tile_pairs(words: list[str], m, side, key, part):
    """Pairs one error apart that share a key: places of the word and of the near one."""
    codes, lengths, letters = _letters(words)
    index = np.flatnonzero(part & 1)  # words that are found
    asked = np.flatnonzero(part & 2)  # words that are looked up
    slices = Slices(codes[index], lengths[index], letters)
    numbers, own = np.unique(key, return_inverse=True)
    groups = np.zeros((len(numbers), slices.words), np.uint64)
    np.bitwise_or.at(groups, (own[index], np.arange(len(index)) // 64),
                     np.uint64(1) << (np.arange(len(index)) % 64).astype(np.uint64))
    pairs = []
    for length in np.unique(lengths[asked]):
        same_length = asked[lengths[asked] == length]
        for at in range(0, len(same_length), QUERIES):
            some = same_length[at:at + QUERIES]
            shorter = (m[some] == length)[:, None]  # the words as the shorter of a pair
            replaced, more, less = slices.near(codes[some, :length], groups[own[some]])
            none = np.uint64(0)
            bits = np.where(shorter, replaced | more, none) | np.where(~shorter, less, none)
            rows, places = _members(bits)
            pairs.append((some[rows], index[places]))
    asked, near = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (index[:0], index[:0])
    # A pair equal in both halves is found under both sides, and counts under the first.
    again = [i for i, (a, b) in enumerate(zip(asked.tolist(), near.tolist(), strict=True))
             if side[a] and words[a][:m[a] // 2] == words[b][:m[a] // 2]]
    return np.delete(asked, again), np.delete(near, again)


def _found(rows: pa.Table) -> pa.Table:
    """FOUND for the words of a tile: how many near words it has here and the most frequent."""
    words = rows["word"].to_pylist()
    n, m, side, key, part = (rows[c].to_numpy() for c in ("n", "m", "side", "key", "part"))
    asked, near = _tile_pairs(words, m, side, key, part)
    by = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[by] = np.arange(len(words))
    order = np.lexsort((rank[near], asked))
    asked, near = asked[order], near[order]
    first = np.flatnonzero(np.r_[True, asked[1:] != asked[:-1]][:len(asked)])
    counts = np.diff(np.r_[first, len(asked)])
    best = near[first].tolist()
    return pa.table({
        "word": pa.array([words[i] for i in asked[first].tolist()], pa.string()),
        "n_near": pa.array(counts, pa.int64()),
        "form_n": pa.array(n[best], pa.int64()),
        "form": pa.array([words[i] for i in best], pa.string()),
    })


def near_words(words: DataFrame) -> DataFrame:
    """Per word of ``word, n`` that has words one error away: their number and the most
    frequent, of equal ones the first in code-point order. As FOUND."""
    ship_package(words.sparkSession)
    tiles = _tiles(_halves(words))
    found = tiles.groupBy("tile", "row", "col").applyInArrow(_found, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """The last of each word's forms: ``word, root`` for ``word, form``.

    Each round doubles the steps that a word is ahead, so rounds grow with the logarithm of
    the longest chain, which is itself at most a logarithm of the largest count.
    """
    ahead = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        steps = ahead.toDF("root", "further")
        moved = written(ahead.join(steps, "root", "left"), "spelling-roots")
        if moved.where("further is not null").isEmpty():
            return ahead
        ahead = moved.select("word", F.coalesce("further", "root").alias("root"))


def variant_groups(docs: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """Words with the more frequent spelling that each may be an error for:
    ``word, form, root, n, n_near, form_n``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. Null texts have no
    words, a null id is an empty text, repeated rows count each, an empty table gives no
    rows. Words of any length are compared, in blocks of bounded size.
    """
    words = written(word_counts(docs).where(F.col("n") >= least_count), "spelling-words")
    near = words.join(near_words(words), "word", "left")
    form = F.col("form_n") >= F.col("n") * ratio
    named = written(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(form, F.col("form")).alias("form"),
        F.when(form, F.col("form_n")).alias("form_n")), "spelling-forms")
    last = roots(named.where("form is not null"))
    return named.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    return variant_groups(table(spark, sf_dir, "documents"))


# DuckDB has no crc32: it is folded here over a text's bytes, by a table of 256 remainders.
# Its levenshtein works on bytes, so letters beyond ASCII stand as single other ones.
ORACLE_OP11 = r"""
WITH RECURSIVE bits(b, i, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT b, i + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
  FROM documents),
each AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hex AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM each),
h AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2),
           lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM hex, crc),
made AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, n FROM h),
v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n, length(word) AS len, translate(word,
    'ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖ×ØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ',
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!"#$%&''()*+,-./:;<=>?@[]^_{}') AS e
  FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
pair AS (
  SELECT a.word, a.n, b.word AS form, b.n AS form_n
  FROM v a JOIN v b ON b.len BETWEEN a.len - 1 AND a.len + 1 AND a.word <> b.word
   AND levenshtein(a.e, b.e) = 1),
best AS (
  SELECT word, CAST(count(*) AS BIGINT) AS n_near, max(form_n) AS form_n,
         arg_min(form, (-form_n, form)) AS form
  FROM pair GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= 5 * v.n THEN form END AS form,
         CASE WHEN form_n >= 5 * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL
  SELECT chain.word, f.word, f.form FROM chain JOIN f ON f.word = chain.next)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word AND chain.next IS NULL
"""
