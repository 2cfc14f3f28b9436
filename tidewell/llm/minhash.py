"""Near-duplicates: MinHash bands for candidates, full shingle sets for the decision."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ready_for_python, text_id, whole_row, written
from tidewell.llm.components import components
from tidewell.plans.tables import table

WORDS = 5  # words of a shingle
SHARED = 75  # least intersection of two sets, in percent of their union
BANDS, ROWS = 32, 4  # a pair at the limit misses all bands with probability 5e-6
HASHES = BANDS * ROWS
# Least share of equal minima in a pair that is compared by its sets. A pair at the limit of
# 0.75 has less with probability 4.8e-7, a tenth of that of missing all bands.
SIGNATURE = 0.55
SPLIT = 256  # documents compared with one text in a task
TILE = 1024  # documents of a bucket on each side of a task
CHUNK = 1024  # shingles hashed at a time


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


PLACE, FACTOR, SHIFT = _odd(1, WORDS), _odd(2, HASHES)[:, None], _odd(3, HASHES)[:, None]
MIX = _odd(4, ROWS + 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers, so that minima can be taken of them."""
    x = (x ^ (x >> np.uint64(32))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Words are runs of anything but ASCII white space, A-Z in lower case. Fewer words than
    a shingle has are one shingle together; no words, none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if not words:
        return hashes
    if len(words) < WORDS:
        return _mixed(np.array([(hashes * PLACE[:len(words)]).sum() + np.uint64(len(words))]))
    last = len(words) - WORDS + 1
    summed = np.full(last, WORDS, np.uint64)
    for i in range(WORDS):
        summed += hashes[i:i + last] * PLACE[i]
    return np.unique(_mixed(summed))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minima of a set under HASHES universal hash functions (multiply, add, shift)."""
    least = np.full(HASHES, 2**32 - 1, np.uint64)
    for start in range(0, len(hashes), CHUNK):
        part = (hashes[None, start:start + CHUNK] * FACTOR + SHIFT) >> np.uint64(32)
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, from its minima and its place."""
    rows = minima.reshape(BANDS, ROWS) * MIX[2:]
    return _mixed(rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * MIX[0])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= SHARED * (len(x) + len(y) - both)


SIGNED = ("doc_id long, id string, n_shingles long, set_id string, "
          "bands array<long>, low binary")


def _signed(batches):
    """Text to set size, a hash of the whole set, band keys, and each minimum's low byte."""
    for batch in batches:
        columns = {name: [] for name in ("n", "set", "bands", "low")}
        for text in batch.column("text"):
            found = shingles(text.as_py())
            minima = signature(found) if len(found) else None
            columns["n"].append(len(found))
            columns["set"].append(hashlib.md5(found.tobytes()).hexdigest() if len(found) else None)
            columns["bands"].append(
                band_keys(minima).view(np.int64) if len(found) else np.zeros(0, np.int64))
            columns["low"].append(minima.astype(np.uint8).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("id"), pa.array(columns["n"], pa.int64()),
             pa.array(columns["set"], pa.string()), pa.array(columns["bands"], pa.list_(pa.int64())),
             pa.array(columns["low"], pa.binary())],
            names=["doc_id", "id", "n_shingles", "set_id", "bands", "low"])


def _verified(members: pa.Table, center: pa.Table) -> pa.Table:
    """Links between one text and those that a bucket or several put beside it."""
    out = []
    if len(center):
        own = shingles(center["text"][0].as_py())
        out = [c.as_py() for c, t in zip(members["cls"], members["text"], strict=True)
               if similar(own, shingles(t.as_py()))]
    hub = members["hub"][0].as_py() if out else None
    return pa.table({"a": pa.array(out, pa.int64()), "b": pa.array([hub] * len(out), pa.int64())})


def hub_links(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``edges`` (``cls, hub, part``) whose full sets are similar, as ``a, b``.

    A hub's text is sent once to each part of its documents, SPLIT of them or so.
    """
    members = edges.join(texts, "cls").select("hub", "part", "cls", "text")
    centers = (edges.select("hub", "part").distinct()
               .join(texts.withColumnRenamed("cls", "hub"), "hub")
               .toDF("center", "piece", "text"))
    return members.groupBy("hub", "part").cogroup(centers.groupBy("center", "piece")).applyInArrow(
        _verified, "a long, b long")


def _tile_links(rows: pa.Table) -> pa.Table:
    """Links between documents of one bucket that are not yet in one component.

    Pairs are compared in the first bucket that they share only, by signature and then by
    set. Within the task, linked components count as one, so a link that joins nothing
    new is not looked for.
    """
    def numbers(name):
        return rows[name].to_numpy().astype(np.int64)

    cls, comp, n, block = (numbers(c) for c in ("cls", "component", "n_shingles", "block"))
    i, j, key = (rows[c][0].as_py() for c in ("i", "j", "key"))
    center = rows["hub"].to_numpy() == cls
    low = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(len(cls), HASHES)
    bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(cls), BANDS)
    left, right = np.flatnonzero((block == i) & ~center), np.flatnonzero((block == j) & ~center)
    pairs = []
    for start in range(0, len(left), 64):
        own = left[start:start + 64]
        share = (low[own][:, None] == low[right][None]).mean(axis=2)
        fits = (share >= SIGNATURE) & (comp[own][:, None] != comp[right][None])
        small = np.minimum(n[own][:, None], n[right][None])
        fits &= 100 * small >= SHARED * np.maximum(n[own][:, None], n[right][None])
        if i == j:
            fits &= cls[own][:, None] < cls[right][None]
        x, y = np.nonzero(fits)
        for a, b, s in zip(own[x], right[y], share[x, y], strict=True):
            if bands[a][np.argmax(bands[a] == bands[b])] == key:
                pairs.append((-s, a, b))
    sets, root, links = {}, {}, []

    def top(c):
        while root.get(c, c) != c:
            c = root[c]
        return c

    texts = rows["text"]
    for _, a, b in sorted(pairs):
        x, y = top(comp[a]), top(comp[b])
        if x == y:
            continue
        for r in (a, b):
            if r not in sets:
                sets[r] = shingles(texts[int(r)].as_py())
        if similar(sets[a], sets[b]):
            root[x] = y
            links.append((cls[a], cls[b]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                     "b": pa.array([y for _, y in links], pa.int64())})


def rest_links(buckets: DataFrame, texts: DataFrame, joined: DataFrame) -> DataFrame:
    """Links in buckets that still hold several components, as ``a, b``.

    The hubs are done, so buckets of two are. Large buckets are cut into TILE by TILE
    documents, and a document goes to each tile of its row and column of tiles.
    """
    placed = (
        buckets.where("n > 2").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
             .where("_low != _high").select("key"))
    blocks = F.ceil(F.col("n") / TILE).cast("int")
    rows = (
        placed.join(mixed, "key")
        .withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("key", "cls", "hub", "component", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .join(texts, "cls"))
    return rows.groupBy("key", "i", "j").applyInArrow(_tile_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Each row's group of near-duplicates: ``doc_id, id, n_shingles, component_id, kept``.

    Rows with equal shingle sets are one class. Classes that share a band's key are in
    one bucket; each is compared with the bucket's first class, then, where a bucket still
    holds several components, with the others. Every decision is on full sets. Classes
    and links are what is moved and joined, never all pairs of a group, and no signature,
    link or component goes to the driver.

    ``component_id`` is the smallest id reachable and ``kept`` says that it is the row's
    own. Null and blank texts have no shingles and are linked with nothing. A null id takes
    no part in the smallest one; a group of none but null ids has null and keeps all rows.
    Rows that repeat an id are judged each by their own text. An empty table gives no rows,
    and further columns are ignored.
    """
    return _grouped(docs).drop("group")


def _grouped(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with each row's ``group``, which groups of null ids have too."""
    ready_for_python(docs.sparkSession)
    rows = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    text_id(F.col("doc_id"), F.col("text")).alias("id"), "text")
        .mapInArrow(_signed, SIGNED), "minhash-rows")
    classes = written(
        rows.where("n_shingles > 0").groupBy("set_id")
        .agg(F.min("id").alias("id"), F.min("doc_id").alias("least"),
             F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
             F.first("low").alias("low"))
        .withColumn("cls", F.monotonically_increasing_id()), "minhash-classes")
    keys = classes.select("cls", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("cls").alias("hub")).where("n > 1")
    buckets = written(keys.join(shared, "key"), "minhash-buckets")
    kept = ["n_shingles", "bands", "low"]
    wanted = classes.join(buckets.select("cls").distinct(), "cls", "left_semi").select(
        "cls", "id", *kept)
    texts = written(
        docs.select(text_id(F.col("doc_id"), F.col("text")).alias("id"), "text")
        .join(wanted, "id").groupBy("cls")
        .agg(*[F.first(c).alias(c) for c in ("text", *kept)]), "minhash-texts")
    links = written(
        hub_links(_hub_edges(buckets, classes), texts.select("cls", "text")), "minhash-links")
    joined = written(components(links), "minhash-joined")
    more = written(rest_links(buckets, texts, joined), "minhash-links")
    groups = components(joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
                        .union(more))
    in_group = written(
        classes.select("set_id", "least", "cls")
        .join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls")), "minhash-groups")
    smallest = in_group.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = in_group.join(smallest, "component").select("set_id", "component", "component_id")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    # Rows without a set match nothing; their key is their own, so they are not one group.
    key = F.coalesce("set_id", F.concat(F.lit("none "), "id"))
    return (
        rows.select("doc_id", "id", "n_shingles", key.alias("set_id"))
        .join(by_set, "set_id", "left")
        .select("doc_id", "id", "n_shingles", component_id.alias("component_id"),
                F.coalesce(F.col("component").cast("string"), "set_id").alias("group"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _hub_edges(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class with the hubs of its buckets, once, where size and signature allow a
    link: ``cls, hub, part``."""
    own = classes.select("cls", F.col("n_shingles").alias("n_own"), F.col("low").alias("low_own"))
    hubs = classes.select(F.col("cls").alias("hub"), F.col("n_shingles").alias("n_hub"),
                          F.col("low").alias("low_hub"))
    edges = buckets.where("cls != hub").select("cls", "hub").distinct()
    least, most = F.least("n_own", "n_hub"), F.greatest("n_own", "n_hub")

    def equal(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
                    .reshape(-1, HASHES) for c in ("low_own", "low_hub"))
            fits = (x == y).mean(axis=1) >= SIGNATURE
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("hub")], names=["cls", "hub"]).filter(pa.array(fits))

    kept = written(
        edges.join(own, "cls").join(hubs, "hub").where(100 * least >= SHARED * most)
        .select("cls", "hub", "low_own", "low_hub").mapInArrow(equal, "cls long, hub long"),
        "minhash-edges")
    counts = kept.groupBy("hub").agg(F.ceil(F.count("*") / SPLIT).alias("parts"))
    return kept.join(counts, "hub").select(
        "cls", "hub", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("part"))


def unique_documents(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that near_duplicates does not keep; columns unchanged."""
    gone = written(near_duplicates(docs).where(~F.col("kept")).select("id").distinct(), "minhash-gone")
    rows = docs.select(whole_row(docs).alias("_row"),
                       text_id(F.col("doc_id"), F.col("text")).alias("_id"))
    return rows.join(gone, F.col("_id") == F.col("id"), "left_anti").select("_row.*")


def single_documents(docs: DataFrame) -> DataFrame:
    """One row of each group of ``docs``; columns unchanged.

    Of the rows that near_duplicates keeps in a group (repeated rows, rows that repeat an
    id with like texts, rows of null ids) the one with the smallest text id stays, and of
    rows equal in id and text the one with the smallest hash of all columns. Texts without
    shingles are linked with nothing, but of equal rows of them one stays too.
    """
    counts = written(_grouped(docs).groupBy("group", "id").agg(
        F.count("*").alias("n"), F.first("kept").alias("kept")), "minhash-single")
    chosen = counts.where("kept").groupBy("group").agg(F.min("id").alias("id"))
    gone = counts.join(chosen, ["group", "id"], "left_anti").select("id")
    repeated = written(counts.join(chosen, ["group", "id"], "left_semi").where("n > 1").select("id"),
                       "minhash-repeated")
    rows = docs.select(whole_row(docs).alias("_row"),
                       text_id(F.col("doc_id"), F.col("text")).alias("_id"))
    own = F.col("_id") == F.col("id")
    single = rows.join(written(gone.union(repeated), "minhash-gone"), own, "left_anti")
    # Only rows that are repeated are grouped, and within tasks first.
    first = rows.join(repeated, own, "left_semi").groupBy("_id").agg(
        F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    return single.select("_row.*").union(first.select("_row.*"))


def op10_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("id")


ORACLE_OP10 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT r, doc_id, CASE WHEN len(words) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(words) - 3, 2)),
           lambda i: array_to_string(list_slice(words, i, i + 4), ' '))) END AS shingles
  FROM w),
x AS (SELECT r, unnest(shingles) AS shingle FROM s),
p AS (
  SELECT a.r AS a, b.r AS b, count(*) AS shared
  FROM x a JOIN x b ON a.shingle = b.shingle AND a.r <> b.r GROUP BY ALL),
l AS (
  SELECT p.a, p.b FROM p JOIN s sa ON sa.r = p.a JOIN s sb ON sb.r = p.b
  WHERE 100 * shared >= 75 * (len(sa.shingles) + len(sb.shingles) - shared)),
reach AS (
  SELECT a AS r, b FROM l UNION SELECT reach.r, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (
  SELECT s.r, least(s.doc_id, min(o.doc_id)) AS component_id
  FROM s LEFT JOIN reach ON reach.r = s.r LEFT JOIN s o ON o.r = reach.b GROUP BY s.r, s.doc_id)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM s JOIN c USING (r)
"""
