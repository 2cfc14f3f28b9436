"""Benchmark passages in documents: suffix arrays of document shards, searched by test suffix."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import bounded_batches, written
from tidewell.llm.words import byte_class, chunks, split
from tidewell.plans.tables import table
from tidewell.session import ship_package

WINDOW = 10  # words
# ASCII letters and digits, and all bytes of other characters.
WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
SHARD_BYTES = 1 << 24  # of text in a suffix array, and one document more
BLOCK_BYTES = 1 << 22  # of benchmark text that is sent to the tasks at a time

NEW = ("n_words long, items array<string>, spans array<struct<start:int,end:int>>")


class Tests(NamedTuple):
    """A block of benchmark items, for searching. Words are numbered from 1 by ``words``."""

    words: pa.Array  # distinct
    ids: np.ndarray  # of all items' words, a 0 behind each item
    left: np.ndarray  # words from each place to its item's end
    item: np.ndarray  # of each place
    names: list[str]  # item ids as text
    longest: int
    windows: np.ndarray  # places at which distinct windows begin
    sizes: np.ndarray  # their words
    groups: np.ndarray  # of each window, its set of items
    sets: list[list[int]]


def tests_of(item_ids: pa.Array, texts: pa.Array, window: int) -> Tests:
    found = split(texts, WORD)
    used, codes = np.unique(found.codes, return_inverse=True)
    words = found.distinct.cast(pa.binary()).take(pa.array(used))
    sizes = found.sizes
    ends = np.cumsum(sizes + 1)
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    item = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = np.repeat(ends, sizes + 1) - 1 - np.arange(len(ids))
    ids[left > 0] = codes + 1
    # A window begins where enough words are left, or at the start of a shorter item.
    short = np.minimum(sizes, window)
    starts = np.flatnonzero((left > 0) & (left >= short[item]))
    by_window: dict[bytes, list[int]] = {}
    for at in starts:
        by_window.setdefault(ids[at:at + short[item[at]]].tobytes(), []).append(int(at))
    sets: dict[tuple[int, ...], int] = {}
    groups = [sets.setdefault(tuple(sorted({int(item[a]) for a in places})), len(sets))
              for places in by_window.values()]
    first = np.array([places[0] for places in by_window.values()], np.int64)
    names = [n or "" for n in item_ids.cast(pa.string()).to_pylist()]
    return Tests(words, ids, left, item, names, int(sizes.max(initial=0)),
                 first, short[item[first]] if len(first) else first, np.array(groups, np.int64),
                 [list(s) for s in sets])


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``ids`` that hold a word, ordered by the ``depth`` words from there on.

    0 stands for what no test has: a place that holds it matches nothing and is left out, and
    words behind it don't count. Orders by a few words in one key, then by twice as many in
    each round (prefix doubling), where only places not yet told apart are sorted again.
    """
    n = len(ids)
    bits = max(int(ids.max(initial=0)).bit_length(), 1)
    k = max(min(63 // bits, depth), 1)
    padded = np.concatenate([ids, np.zeros(k, np.int64)])
    keys = np.zeros(n, np.int64)
    for i in range(k):
        keys = (keys << bits) | padded[i:i + n]
    known = np.flatnonzero(ids)
    order = known[np.argsort(keys[known], kind="stable")]
    blanks = np.flatnonzero(ids == 0)
    reach = np.append(blanks, n)[np.searchsorted(blanks, np.arange(n))] - np.arange(n)
    new = np.r_[True, np.diff(keys[order]) != 0][:len(order)]
    rank = np.zeros(n + 1, np.int64)  # of a place, 1 and up; 0 where there is no word
    group = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    rank[order] = group + 1
    at = np.arange(len(order))  # entries of ``order`` still to be told apart
    while k < depth:
        own = group[at]
        alone = np.r_[own[1:] != own[:-1], True] & np.r_[True, own[1:] != own[:-1]] if len(at) else at
        at = at[~alone & (reach[order[at]] > k)] if len(at) else at
        if not len(at):
            break
        places = order[at]
        following = rank[np.minimum(places + k, n)]
        by = np.lexsort((following, group[at]))
        order[at], following, own = places[by], following[by], group[at]
        new = np.r_[True, (own[1:] != own[:-1]) | (following[1:] != following[:-1])]
        group[at] = np.maximum.accumulate(np.where(new, at, 0))
        rank[order[at]] = group[at] + 1
        k *= 2
    return order


def _search(ids, order, tests: Tests, at: np.ndarray, sizes: np.ndarray, after: bool) -> np.ndarray:
    """Where in ``order`` the words from ``at`` on, ``sizes`` of them, would stand: before all
    places that begin with them or ``after`` them. All binary searches go on together."""
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(order))
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        sign = _compared(ids, order[middle], tests, at[live], sizes[live])[0]
        right = (sign < 0) | ((sign == 0) & after)
        low[live[right]] = middle[right] + 1
        high[live[~right]] = middle[~right]


def _compared(ids, places, tests: Tests, at, sizes):
    """Sign of the order of document words from ``places`` and test words from ``at`` within
    ``sizes`` words, and how many are equal. ``ids`` ends with a 0."""
    sign, same = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    depth = 0
    while len(live):
        live = live[sizes[live] > depth]
        own = ids[np.minimum(places[live] + depth, len(ids) - 1)]
        differ = np.sign(own - tests.ids[at[live] + depth])
        sign[live] = differ
        live = live[differ == 0]
        same[live] += 1
        depth += 1
    return sign, same


class Shard:
    """Documents as numbers of test words, and their suffix array."""

    def __init__(self, texts: pa.Array, tests: Tests, window: int):
        found = split(texts, WORD)
        self.sizes = found.sizes
        known = pc.index_in(found.distinct.cast(pa.binary()), value_set=tests.words)
        number = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        self.ends = np.cumsum(self.sizes + 1)
        total = int(self.ends[-1]) if len(self.ends) else 0
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes + 1)
        self.begin = self.ends - self.sizes - 1
        self.ids = np.zeros(total + 1, np.int64)
        if len(found.codes):
            inside = np.ones(total, bool)
            inside[self.ends - 1] = False
            self.ids[:total][inside] = number[found.codes]
        self.order = suffix_array(self.ids, tests.longest)

    def windows(self, tests: Tests):
        """Each occurrence of a window: its place in the shard and the window's number."""
        ranges = [_search(self.ids, self.order, tests, tests.windows, tests.sizes, after)
                  for after in (False, True)]
        counts = ranges[1] - ranges[0]
        which = np.repeat(np.arange(len(counts)), counts)
        base = np.repeat(ranges[0] - (np.cumsum(counts) - counts), counts)
        return self.order[base + np.arange(len(which))], which

    def longest(self, tests: Tests):
        """Per item its first suffix with the most words found here, and how many these are."""
        at = np.flatnonzero(tests.left > 0)
        best = np.zeros(len(at), np.int64)
        if len(self.order):
            where = _search(self.ids, self.order, tests, at, tests.left[at], False)
            # The suffixes with most in common stand next to where it would be inserted.
            for beside in (where - 1, where):
                near = self.order[np.clip(beside, 0, len(self.order) - 1)]
                best = np.maximum(best, _compared(self.ids, near, tests, at, tests.left[at])[1])
        by = np.lexsort((at, -best, tests.item[at]))
        item = tests.item[at][by]
        by = by[np.r_[True, item[1:] != item[:-1]][:len(by)]]
        by = by[best[by] > 0]
        return at[by], best[by]

    def first_places(self, tests: Tests, at: np.ndarray, sizes: np.ndarray, rank: np.ndarray):
        """Of the places that have ``sizes`` words from ``at`` on, the first by the documents'
        ``rank``. Ranges of one size are disjoint, so the work is a shard's for each size."""
        key = rank[self.doc] * (len(self.ids) + 1) + np.arange(len(self.doc))
        first = np.zeros(len(at), np.int64)
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            low, high = (_search(self.ids, self.order, tests, at[own], sizes[own], after)
                         for after in (False, True))
            low, inverse = np.unique(low, return_inverse=True)
            ends = np.zeros(len(low), np.int64)
            ends[inverse] = high
            counts = ends - low
            starts = np.cumsum(counts) - counts
            inside = np.arange(counts.sum()) + np.repeat(low - starts, counts)
            least = np.minimum.reduceat(key[self.order[inside]], starts)
            first[own] = (least % (len(self.ids) + 1))[inverse]
        return first


def _intervals(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edges = np.diff(np.r_[0, marks.astype(np.int8), 0])
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.ListArray:
    """``values``, in order of their owners, as a list for each of ``n`` owners."""
    offsets = np.searchsorted(owner, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _marked(rows: pa.Table, tests: Tests, window: int):
    """NEW for the rows of a shard, with what an earlier block of items found there."""
    shard = Shard(rows.column("_text").combine_chunks(), tests, window)
    places, which = shard.windows(tests)
    change = np.zeros(len(shard.ids) + 1, np.int64)
    np.add.at(change, places, 1)
    np.add.at(change, places + tests.sizes[which], -1)
    earlier = rows.column("spans").combine_chunks()
    if earlier.null_count < len(earlier):
        owner = np.repeat(np.arange(len(earlier)), pc.list_value_length(earlier).to_numpy())
        flat = earlier.flatten()
        for name, step in (("start", 1), ("end", -1)):
            np.add.at(change, shard.begin[owner] + flat.field(name).to_numpy(), step)
    starts, ends = _intervals(np.cumsum(change) > 0)
    doc = shard.doc[starts] if len(starts) else starts
    spans = pa.StructArray.from_arrays(
        [pa.array((x - shard.begin[doc]).astype(np.int32)) for x in (starts, ends)], ["start", "end"])
    pairs = np.unique(shard.doc[places] * max(len(tests.sets), 1) + tests.groups[which])
    items = [set(i or ()) for i in rows.column("items").to_pylist()]
    for pair in pairs.tolist():
        items[pair // len(tests.sets)].update(
            tests.names[i] for i in tests.sets[pair % len(tests.sets)])
    return [pa.array(shard.sizes, pa.int64()),
            pa.array([sorted(i) for i in items], pa.list_(pa.string())),
            _lists(spans, doc, len(shard.sizes))]


def _blocks(benchmark: DataFrame, window: int):
    """The benchmark's items in blocks of about BLOCK_BYTES of text, one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    for block in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block)
        rows = own.orderBy("id", "text").toArrow()
        yield tests_of(rows["id"].combine_chunks(), rows["text"].combine_chunks(), window)


def _shards(rows: DataFrame, tests: Tests, schema, made) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(tests)

    def run(batches):
        for shard in chunks(batches, "_text", SHARD_BYTES):
            yield from made(shard, sent.value)

    return rows.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``items`` (ids of the items found, as text, in order) and
    ``spans`` (ranges of words inside any occurrence of a window).

    Each task makes suffix arrays of its documents, SHARD_BYTES of text at a time, and searches
    them for all windows, so no document moves. The benchmark is sent in blocks of a bounded
    size; what a block finds in a document is joined with what earlier ones found. Null texts
    have no words and items without words are never found; a null item id is an empty text.
    Repeated documents are rows of their own, repeated items are one. Columns of ``docs`` that
    are named like the new ones are replaced.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bounded_batches(spark)
    own = F.struct(F.lit(0).alias("_"), *_other_columns(docs)).alias("_row")
    rows = docs.select(own, F.col("text").cast("string").alias("_text"))
    for name, kind in (part.split(" ", 1) for part in NEW.split(", ")):
        rows = rows.withColumn(name, F.lit(None).cast(kind))
    schema = rows.schema

    def made(shard: pa.Table, tests: Tests):
        columns = _marked(shard, tests, window)
        whole = pa.table([*(shard.column(c) for c in ("_row", "_text")), *columns],
                         names=shard.schema.names)
        yield from whole.to_batches(max_chunksize=1000)

    for number, tests in enumerate(_blocks(benchmark, window)):
        if number:
            rows = written(rows, "overlap-block")
        rows = _shards(rows, tests, schema, made)
    kept = [F.col("_text" if c == "text" else f"_row.`{c}`").alias(c) for c in docs.columns
            if c not in ("n_words", "items", "spans")]
    return rows.select(*kept, "n_words", "items", "spans")


def _other_columns(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns if c != "text"]


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per item the most of its consecutive words that stand in some document, and where:
    ``item_id, n_words, item_at, doc_id, doc_at``, places in words from 0.

    Each shard gives its longest match per item; the longest of all remains, of equal ones
    the first in the item, then that of the smallest id and place. Items without any match are left out.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("_text"))
    schema = "item_id string, n_words int, item_at int, doc_id long, doc_at int"

    def made(shard_rows: pa.Table, tests: Tests):
        shard = Shard(shard_rows.column("_text").combine_chunks(), tests, WINDOW)
        at, best = shard.longest(tests)
        ids = shard_rows.column("doc_id").combine_chunks()
        rank = pc.rank(ids, null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        place, item = shard.first_places(tests, at, best, rank), tests.item[at]
        begin = np.searchsorted(tests.item, item)
        yield pa.RecordBatch.from_arrays([
            pa.array([tests.names[i] for i in item], pa.string()),
            pa.array(best.astype(np.int32)), pa.array((at - begin).astype(np.int32)),
            ids.take(pa.array(shard.doc[place])),
            pa.array((place - shard.begin[shard.doc[place]]).astype(np.int32)),
        ], names=["item_id", "n_words", "item_at", "doc_id", "doc_at"])

    found = None
    for tests in _blocks(benchmark, WINDOW):
        part = _shards(rows, tests, schema, made)
        found = part if found is None else found.unionByName(part)
    best = F.struct((-F.col("n_words")).alias("size"), "item_at", "doc_id", "doc_at")
    return found.groupBy("item_id").agg(F.min(best).alias("best")).select(
        "item_id", (-F.col("best.size")).alias("n_words"), "best.item_at", "best.doc_id", "best.doc_at")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark stands; columns unchanged."""
    hidden = docs.select(F.struct(F.lit(0).alias("_"), *_other_columns(docs)).alias("_doc"), "text")
    clean = contamination(hidden, benchmark, window).where(F.size("spans") == 0)
    return clean.select(*[F.col("text" if c == "text" else f"_doc.`{c}`").alias(c)
                          for c in docs.columns])


def op13_overlap(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


ORACLE_OP13 = r"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
           lambda i: array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' '))) AS words
  FROM b WHERE len(w) > 0),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (
  SELECT r, size, unnest(range(1, len(w) - size + 2)) AS i,
         unnest(list_transform(range(1, len(w) - size + 2),
           lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS words
  FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
m AS (SELECT r, i, size, item FROM g JOIN win USING (size, words)),
hit AS (
  SELECT r, count(*) AS n FROM (
    SELECT DISTINCT r, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT r, i, size FROM m))
  GROUP BY r),
found AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(found.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN found USING (r)
"""
