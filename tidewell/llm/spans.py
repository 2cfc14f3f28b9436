"""Positions of pattern matches in texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.llm.common import let

STRIDE = 256  # matches whose lengths are summed one by one between two stored sums
SPAN = "array<struct<start:int,end:int,match:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches of ``pattern`` in ``text``, in order.

    An array of (start, end, match), in code points, end exclusive. The matches and the
    pieces between them alternate, so their lengths add up to the positions. Sums are
    stored for every STRIDE matches, which keeps the work near the number of matches.
    A match may not be empty. Null text has no match.
    """
    none = F.array().cast(SPAN)
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.coalesce(F.size(found), F.lit(0)) <= 0, none).otherwise(
            let(F.split(text, pattern, -1), lambda gaps: _placed(found, gaps))),
    )


def _placed(found: Column, gaps: Column) -> Column:
    zero = F.lit(0)
    steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)),
                       lambda m, g: F.length(m) + F.length(g))

    def total(lengths, first, count):
        return F.aggregate(F.slice(lengths, first, count), zero, lambda a, b: a + b)

    def stored(lengths):
        blocks = F.sequence(zero, ((F.size(lengths) - 1) / STRIDE).cast("int"))
        return F.aggregate(
            blocks, F.array(zero),
            lambda sums, i: F.concat(
                sums, F.array(F.element_at(sums, -1) + total(lengths, i * STRIDE + 1, STRIDE))))

    def span(match, i, lengths, sums):
        block = F.floor(i / F.lit(STRIDE)).cast("int")
        start = (F.get(sums, block) + total(lengths, block * STRIDE + 1, i % STRIDE)
                 + F.length(F.get(gaps, i)))
        return F.struct(start.alias("start"), (start + F.length(match)).alias("end"),
                        match.alias("match"))

    return let(steps, lambda lengths: let(stored(lengths), lambda sums: F.transform(
        found, lambda match, i: span(match, i, lengths, sums)))).cast(SPAN)


def labelled(spans: Column, rank: int, kind: str) -> Column:
    """Spans as (start, rank, end, kind, match), which sort by start, then rank."""
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["match"].alias("match")))


def described(spans: Column) -> Column:
    """``kind:start:end`` of each labelled span in order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def overwritten(text: Column, spans: Column, label) -> Column:
    """``text`` with every span replaced by ``label(span)``; of spans that overlap, the
    first in order gives the label, and all that any of them covers goes."""
    ordered = F.array_sort(spans)
    cut = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"),
                 F.array().cast("array<struct<start:int,end:int,label:string>>").alias("cuts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["end"] <= acc["at"], acc["cuts"]).otherwise(F.concat(acc["cuts"], F.array(
                F.struct(F.greatest(acc["at"], s["start"]).alias("start"), s["end"].alias("end"),
                         F.when(s["start"] >= acc["at"], label(s)).otherwise(F.lit(""))
                         .alias("label"))))).alias("cuts")),
    )["cuts"]

    def rebuilt(cuts):
        pieces = F.transform(cuts, lambda c, i: F.concat(
            F.substring(text, F.when(i == 0, 1).otherwise(F.get(cuts, i - 1)["end"] + 1),
                        c["start"] - F.when(i == 0, 0).otherwise(F.get(cuts, i - 1)["end"])),
            c["label"]))
        rest = F.substring(text, F.element_at(cuts, -1)["end"] + 1, F.length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    return F.when(F.size(spans) <= 0, text).otherwise(let(cut, rebuilt))
