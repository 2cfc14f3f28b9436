"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import text_id, whole_row, word_count, written
from tidewell.plans.tables import table
from tidewell.sources.ids import assign_ids

CAP = 3  # a target is at most so many times its source's size
LOW, HIGH = 0.5, 1.5  # bounds of a document's quality weight
BUCKET_ROWS = 4096  # rows of a source in one range of keys, on average
KEY_DIGITS = 13  # hex digits of a hash that make one uniform number


def quality_weight(text: Column, size: Column) -> Column:
    """A weight from LOW to HIGH: longer documents of plausible words weigh more.

    Half a point is for 200 words or more, in proportion; half a point for a mean word
    length, one separator included, from 4 to 12.
    """
    mean = F.try_divide(F.length(text) + 1, size)
    plausible = F.when(mean.between(4, 12), 0.5).otherwise(0.0)
    return F.coalesce(LOW + F.least(size, F.lit(200)) / 400.0 + plausible, F.lit(LOW))


def measure(docs: DataFrame, quality: Column | None = None, seed: str = "mix") -> DataFrame:
    """``docs`` with ``_size``, its sampling key ``_key`` and the tie-breaker ``_tie``.

    The key is that of Efraimidis and Spirakis: an exponential number divided by the
    weight, here from a hash, so that reruns and retried tasks agree.
    """
    with_size = docs.withColumn("_size", word_count(F.col("text"))).withColumn(
        "_tie", text_id(F.col("doc_id"), F.col("text"))
    )
    weight = quality_weight(F.col("text"), F.col("_size")) if quality is None else quality
    weight = F.least(F.greatest(F.coalesce(weight, F.lit(LOW)), F.lit(LOW)), F.lit(HIGH))
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.col("_tie"))), 1, KEY_DIGITS)
    uniform = (F.conv(digits, 16, 10).cast("long") + 0.5) / float(16**KEY_DIGITS)
    return with_size.withColumn("_key", -F.log(uniform) / weight)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds ``target`` to one row per source (``source``, ``source_size``).

    ``weights`` go to the sources by code point, null last, and repeat. The total of
    all sizes is shared by weight; what a source is given above CAP times its size is
    shared again among the others, until none is above. Each round is one small
    aggregation, so sources may be many.
    """
    ranked = assign_ids(sizes, "_rank", order_by=(F.col("source").asc_nulls_last(),))
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    weighed = written(
        ranked.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
        .withColumn("_cap", CAP * F.col("source_size")).drop("_rank"), "mix-weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    capped, rest, weight = -1, total, None
    over = F.lit(False)
    while True:
        row = weighed.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0)).alias("cap"),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0)).alias("weight"),
        ).first()
        rest, weight = total - row["cap"], row["weight"]
        if row["n"] == capped or not weight:
            break
        capped = row["n"]
        # Whole numbers are compared, so a source exactly at its cap is never in doubt.
        over = F.col("_cap").cast("decimal(38,0)") * F.lit(weight) < (
            F.col("_weight").cast("decimal(38,0)") * F.lit(rest))
    share = F.col("_weight") * F.lit(float(rest)) / F.lit(float(weight or 1))
    target = F.when(over, F.col("_cap").cast("double")).otherwise(share)
    return weighed.withColumn("target", target).drop("_cap", "_weight")


def mix_plan(measured: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source: size, target, complete epochs, and how far into the sorted
    keys the last, partial epoch reaches.

    No source is sorted as a whole. Words are summed per range of keys, the ranges are
    summed in order, and only the rows of the one range in which a source's budget ends
    are sorted. Ranges hold BUCKET_ROWS rows on average, whatever the source's size.
    """
    sums = measured.groupBy("source").agg(
        F.sum("_size").alias("source_size"), F.count("*").alias("_rows"))
    # DOUBLE targets of a source that is capped are whole, so three epochs stay three.
    size = F.col("source_size")
    plan = written(
        source_targets(sums, weights)
        .withColumn("epochs", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("epochs") * size)
        .withColumn("buckets", F.ceil(F.col("_rows") / BUCKET_ROWS)).drop("_rows"), "mix-plan")
    placed = on_source(measured, plan.select("source", "buckets", "rest"))
    placed = placed.withColumn("bucket", bucket()).where(F.col("rest") > 0)
    by_range = Window.partitionBy("source").orderBy("bucket")
    ranges = (
        placed.groupBy("source", "bucket", "rest").agg(F.sum("_size").alias("_words"))
        .withColumn("_upto", F.sum("_words").over(by_range))
        .withColumn("before", F.col("_upto") - F.col("_words"))
        .where((F.col("before") < F.col("rest")) & (F.col("_upto") >= F.col("rest")))
        .select(F.col("source").alias("_s"), F.col("bucket").alias("edge"), "before")
    )
    in_edge = placed.join(
        ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("edge")))
    # Rows equal in id, source and text count as copies of one, of which any number is taken.
    in_order = Window.partitionBy("source").orderBy("_key", "_tie")
    words = F.col("_size") * F.col("_copies")
    room = F.col("rest") - (F.col("before") + F.col("_upto") - words)
    # The copy in which the budget ends is taken if that comes nearer to the budget.
    nearest = F.when(F.col("_size") > 0, F.floor((2 * room + F.col("_size")) / (2 * F.col("_size"))))
    taken = F.least("_copies", F.coalesce(nearest, F.when(room >= 0, F.col("_copies")).otherwise(0)))
    cut = (
        in_edge.groupBy("source", "edge", "before", "rest", "_key", "_tie", "_size")
        .agg(F.count("*").alias("_copies"))
        .withColumn("_upto", F.sum(words).over(in_order))
        .withColumn("_taken", taken.cast("long"))
        .groupBy("source", "edge")
        .agg(F.max(F.when(F.col("_taken") > 0, F.struct("_key", "_tie", "_taken"))).alias("_last"))
        .select(F.col("source").alias("_s"), "edge", F.col("_last._key").alias("last_key"),
                F.col("_last._tie").alias("last_tie"), F.col("_last._taken").alias("last_copies"))
    )
    joined = plan.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return written(joined, "mix-cut")


def bucket() -> Column:
    """The range of a key. A key over LOW has a distribution no denser than HIGH / LOW
    times the uniform one after this step, so no range holds much more than its share."""
    return F.floor((1 - F.exp(-F.col("_key") * LOW)) * F.col("buckets"))


def on_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Adds the columns of one row per source. That table is written, so Spark knows its
    size, and broadcasts it or splits a hot source's partition itself."""
    other = per_source.withColumnRenamed("source", "_s")
    return rows.join(other, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def times_taken() -> Column:
    """Copies of a row in the mix: complete epochs, and one if the partial one has it.
    Of rows that are the `last` of the partial one, `last_copies` have one more."""
    key, tie = F.col("_key"), F.col("_tie")
    before = (key < F.col("last_key")) | ((key == F.col("last_key")) & (tie < F.col("last_tie")))
    partial = (bucket() < F.col("edge")) | ((bucket() == F.col("edge")) & before)
    return F.col("epochs") + F.when(F.coalesce(partial, F.lit(False)), 1).otherwise(0)


def is_last() -> Column:
    """Whether a row is one of those in which its source's partial epoch ends."""
    same = (F.col("_key") == F.col("last_key")) & (F.col("_tie") == F.col("last_tie"))
    return F.coalesce(same, F.lit(False))


def mix_report(docs: DataFrame, quality: Column | None = None) -> DataFrame:
    """What the mix takes of each document: ``doc_id, size, source_size, target, taken``.

    Null text has size 0, a null source is a source of its own and comes last, an empty table
    gives no rows, and further columns are ignored. Rows equal in id, source and text are
    copies, of which as many have an epoch more as the budget holds. Where no word is in any
    text, all targets are 0.
    """
    kept = measure(docs.select("doc_id", "source", "text"), quality)
    measured = written(kept.drop("text"), "mix-measured")
    placed = on_source(measured, mix_plan(measured)).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        times_taken().cast("long").alias("_n"),
        F.when(is_last(), F.col("last_copies")).alias("_more"))
    # The last ones of a source are alike in all that is reported: counted, then told apart.
    last = placed.where("_more is not null").groupBy(*placed.columns).agg(F.count("*").alias("_copies"))
    numbered = last.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")))
    last = numbered.withColumn("_n", F.col("_n") + (F.col("_copy") <= F.col("_more")).cast("long"))
    rows = placed.where("_more is null").unionByName(last.drop("_copies", "_copy"))
    return rows.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("_n")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, quality: Column | None = None) -> DataFrame:
    """The mix itself: each document's row as often as it is taken, columns unchanged.

    Texts are not moved: the plan has one row per source, and each row decides by its key. Only
    copies in which a source's partial epoch ends are numbered, in the order of a hash of all
    their columns, over the cluster.
    """
    measured = written(
        measure(docs.select("doc_id", "source", "text"), quality).drop("text"), "mix-measured")
    plan = mix_plan(measured).withColumnRenamed("source", "_source")
    rows = docs.select(whole_row(docs).alias("_whole"), "doc_id", "source", "text")
    joined = measure(rows, quality).join(plan, F.col("source").eqNullSafe(F.col("_source")))
    taken = joined.select(
        "_whole", "_source", times_taken().cast("long").alias("_times"),
        F.when(is_last(), F.col("last_copies")).alias("_more"))
    last = written(taken.where("_more is not null"), "mix-last")
    # Rows alike in all columns are interchangeable, so any order among them will do.
    number = assign_ids(
        last.withColumn("_any", F.monotonically_increasing_id()), "_at",
        order_by=("_source", F.xxhash64(F.to_json("_whole")), "_any"))
    first = number.groupBy(F.col("_source").alias("_s")).agg(F.min("_at").alias("_first"))
    number = number.join(first, F.col("_source").eqNullSafe(F.col("_s")))
    last = number.withColumn("_times", F.col("_times") + (F.col("_at") - F.col("_first") < F.col("_more")).cast("long"))
    rows = taken.where("_more is null").select("_whole", "_times").unionByName(last.select("_whole", "_times"))
    return rows.where("_times > 0").select(
        "_whole", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select("_whole.*")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


ORACLE_OP2 = r"""
WITH d AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))) AS tie
  FROM documents),
k AS (
  SELECT *, -ln((CAST('0x' || substr(md5('mix' || tie), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
    / (CASE WHEN size = 0 OR text IS NULL THEN 0.5 ELSE 0.5 + least(size, 200) / 400.0
       + CASE WHEN (length(text) + 1) / size BETWEEN 4 AND 12 THEN 0.5 ELSE 0 END END) AS key
  FROM d),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM k GROUP BY source),
o AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS i,
         sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS caps,
         sum(w) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS ws,
         sum(source_size) OVER () AS total, sum(w) OVER () AS all_w
  FROM s),
n AS (
  SELECT coalesce(max(i) FILTER (
           WHERE 3 * source_size * (all_w - ws + w) < w * (total - caps + 3 * source_size)), 0) AS m
  FROM o),
t AS (
  SELECT source, source_size,
         CASE WHEN i <= m THEN CAST(3 * source_size AS DOUBLE)
              ELSE w * CAST(total - coalesce((SELECT max(caps) FROM o WHERE i <= m), 0) AS DOUBLE)
                   / CAST(all_w - coalesce((SELECT max(ws) FROM o WHERE i <= m), 0) AS DOUBLE) END AS target
  FROM o, n),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
c AS (
  SELECT k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         sum(size) OVER (PARTITION BY k.source ORDER BY key, tie ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END)
            AS BIGINT) AS taken
FROM c
"""
