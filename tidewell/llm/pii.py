"""Personal data: fixed patterns, and terms that reveal what the patterns protect."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import let, text_id, whole_row, written
from tidewell.llm.spans import counted, described, labelled, matches, overwritten
from tidewell.plans.tables import table

# The kinds in their order. The patterns find what the plain ones of the
# contract find, in linear time: runs are not given back, and a run that can't begin a
# match is not tried again from its middle.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"[\p{L}\p{N}]++"
SHORT_NUMBER = r"^\p{N}{1,2}$"  # not a term: it counts or orders things
DOUBT = 0.01  # chance at which a term that gives away less passes for revealing
DISCLOSURE = 0.8  # share of an entity's information that a term may not give away


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _is_ip(match: Column) -> Column:
    def small(part):
        value = F.regexp_replace(part, "^0+", "")
        return (F.length(value) < 3) | ((F.length(value) == 3) & (value <= "255"))

    return F.forall(F.split(match, r"\."), small)


def _is_card(match: Column) -> Column:
    def luhn(digits):
        places = F.sequence(F.lit(0), F.length(digits) - 1)

        def value(i):
            digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
            twice = digit * 2
            return F.when(i % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

        return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0

    return let(_digits(match), lambda d: F.when(
        F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(9, 15)


VALID = {"email": None, "ip": _is_ip, "card": _is_card, "phone": _is_phone}


def _passing(spans: Column, test) -> Column:
    return F.filter(spans, lambda s: test(s["match"]))


def base_spans(text: Column) -> Column:
    """All matches of the four patterns that pass their test, as labelled spans."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        spans = matches(text, pattern)
        if VALID[kind]:
            spans = _passing(spans, VALID[kind])
        found.append(labelled(spans, rank, kind))
    return F.concat(*found)


def _entities(base: Column) -> Column:
    """Distinct entities of labelled spans, as ``kind:value``."""
    def named(s):
        value = F.when(s["kind"] == "email", F.lower(s["match"])).when(
            s["kind"] == "ip", s["match"]).otherwise(_digits(s["match"]))
        return F.concat_ws(":", s["kind"], value)

    return F.array_distinct(F.transform(base, named))


def _terms(text: Column) -> Column:
    """Distinct terms of a text, in lower case."""
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    return F.array_distinct(F.transform(
        F.filter(words, lambda w: ~w.rlike(SHORT_NUMBER)), lambda w: F.lower(w)))


def _places(text: Column, base: Column) -> Column:
    """All places of terms in a text, as spans with the ``term`` in lower case. A word that
    touches protected data is that data."""
    words = F.filter(matches(text, WORD), lambda t: ~t["match"].rlike(SHORT_NUMBER) & ~F.exists(
        base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return F.transform(words, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), t["match"].alias("match"),
        F.lower(t["match"]).alias("term")))


def find_entities(docs: DataFrame) -> DataFrame:
    """One row per document, without its text: ``doc_id, _id, base``, and for those with an
    entity ``copy`` (equal for equal texts), ``entities``, ``places`` and ``hidden``, the
    terms that stand in protected data only. Written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text_id(F.col("doc_id"), F.col("text")).alias("_id"),
                        text.alias("_text"), base_spans(text).alias("base"))

    # Rows without an entity, nearly all, skip the second step.
    def held(value):
        return F.when(F.size("base") > 0, value)

    found = found.withColumn("places", held(_places(F.col("_text"), F.col("base"))))
    return written(found.select(
        "doc_id", "_id", "base", "places", held(F.md5("_text")).alias("copy"),
        held(_entities(F.col("base"))).alias("entities"),
        held(F.array_except(_terms(F.col("_text")), F.col("places.term"))).alias("hidden"),
    ), "pii-entities")


def _proven(copies: Column, share: Column, least: Column) -> Column:
    """Whether ``share`` of some texts, ``copies`` of them counted, shows that more than
    ``least`` of all such texts have the entity, but for a chance of DOUBT (Chernoff's
    bound; where every text has it, the exact chance ``least ** copies``)."""
    rest = F.when(share < 1, (1 / share - 1) * F.log((1 - share) / (1 - least))).otherwise(0.0)
    return (share > least) & (copies * (F.log(share / least) + rest) >= -math.log(DOUBT))


def revealing_terms(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """Pairs (entity, term) of which the term gives the entity away, over the corpus.

    With p as shares of documents, a term t tells log2(p(t, e) / (p(t) p(e))) bits about
    an entity e that holds -log2 p(e) bits. It reveals e if that is DISCLOSURE of them or
    more, which is the case if e is in (n_entity / n) ** (1 - DISCLOSURE) of the documents
    with t. A few documents prove little, so their count must exclude a smaller share
    but for DOUBT. Equal texts are one piece of evidence. Documents are rows, terms are
    those outside protected data, wherever in a text they stand.

    Equal texts make pairs once, weighted, and pairs are counted before they are shuffled.
    An entity in too few texts to prove anything about any term makes no pairs, so a text
    that lists many addresses found nowhere else makes none. Where too few texts have a
    pair for any count of the term, the term's is not looked up.
    """
    held = written(
        entities.where(F.size("base") > 0).groupBy("copy").agg(
            F.count("*").alias("rows"), F.first("entities").alias("entities"),
            F.first(F.array_distinct("places.term")).alias("terms"),
            F.first("hidden").alias("hidden")), "pii-held")
    all_rows = docs.agg(F.count("*").alias("n")).first()["n"]
    n = F.lit(float(all_rows))

    def least(n_entity):
        return F.pow(n_entity / n, F.lit(1 - DISCLOSURE))

    # The best case of an entity is a term in all of its texts and in no others.
    alone = written(
        held.select("rows", F.explode("entities").alias("entity"))
        .groupBy("entity").agg(F.sum("rows").alias("n_entity"), F.count("*").alias("copies"))
        .where(F.col("n_entity") < n)
        .where(_proven(F.col("copies"), F.lit(1.0), least(F.col("n_entity"))))
        .drop("copies"), "pii-frequent")
    pairs = (held.select("copy", F.explode("entities").alias("entity"))
             .join(alone.select("entity"), "entity")
             .join(held.select("copy", "rows", "terms"), "copy"))
    both = (pairs.select("rows", "entity", F.explode("terms").alias("term"))
            .groupBy("entity", "term")
            .agg(F.sum("rows").alias("n_both"), F.count("*").alias("copies")))

    # A term in no other document is the best case, and n_entity is n_both or more.
    suspects = written(
        both.where(_proven(F.col("copies"), F.lit(1.0), least(F.col("n_both"))))
        .join(alone, "entity")
        .where(_proven(F.col("copies"), F.lit(1.0), least(F.col("n_entity")))), "pii-suspects")
    in_docs = (docs.select(F.explode(_terms(F.col("text"))).alias("term"), F.lit(1).alias("one"))
               .union(held.select(F.explode("hidden").alias("term"), -F.col("rows")))
               .groupBy("term").agg(F.sum("one").alias("n_term")))
    return written(
        in_docs.join(suspects, "term")
        .where(_proven(F.col("copies"), F.col("n_both") / F.col("n_term"), least(F.col("n_entity"))))
        .select("entity", "term"), "pii-revealing")


def term_spans(entities: DataFrame, revealing: DataFrame) -> DataFrame:
    """Spans of revealing terms by row: ``_id, terms``. Every place in a text of a term that
    reveals one of the text's entities counts. One entity's rows may be many, so the joins
    are on the pair and on the row's id and term, whose rows AQE can split."""
    rows = entities.where(F.size("base") > 0).dropDuplicates(["_id"])
    known = (
        rows.select("_id", F.explode("entities").alias("entity"),
                    F.array_distinct("places.term").alias("terms"))
        .select("_id", "entity", F.explode("terms").alias("term"))
        .join(revealing, ["entity", "term"]).select("_id", "term").distinct())
    places = rows.select("_id", F.explode("places").alias("t")).withColumn("term", F.col("t.term"))
    return (
        places.join(known, ["_id", "term"])
        .groupBy("_id").agg(F.collect_set(F.struct("t.start", "t.end", "t.match")).alias("terms")))


def find_pii(docs: DataFrame) -> DataFrame:
    """Each row's personal data: ``doc_id, _id, base, spans`` (``spans`` with the terms).

    Null text is empty, a null id is kept, equal rows get equal spans, an empty table gives
    no rows, and further columns are ignored.
    """
    entities = find_entities(docs)
    added = term_spans(entities, revealing_terms(docs, entities))
    return entities.join(added, "_id", "left").select("doc_id", "_id", "base", _all_spans().alias("spans"))


def _all_spans() -> Column:
    """The spans of columns ``base`` and ``terms``, null terms being none."""
    terms = F.coalesce(F.col("terms"), F.array().cast("array<struct<start:int,end:int,match:string>>"))
    return F.concat("base", labelled(terms, len(PATTERNS), "term"))


def _label(span: Column) -> Column:
    """What stands for a span: its kind, and for a term a general word for what it was."""
    term = (F.when(span["match"].rlike("^[0-9]+$"), "<NUMBER>")
            .when(span["match"].rlike(r"^\p{Lu}"), "<NAME>").otherwise(""))
    return F.when(span["kind"] == "term", term).otherwise(
        F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">")))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced: by its kind, or a revealing term by a general
    word (names, numbers) or nothing. Same columns and rows, whatever the columns' names;
    null and empty texts stay, equal rows are changed alike, an empty table stays empty."""
    entities = find_entities(docs)
    added = written(term_spans(entities, revealing_terms(docs, entities)), "pii-terms")
    # The patterns run over the texts again: the spans of all rows with an entity are too
    # many to be sent to each task, and a join with them would move every text.
    rows = docs.select(
        whole_row(docs).alias("_row"), "text",
        text_id(F.col("doc_id"), F.col("text")).alias("_key"),
        base_spans(F.coalesce(F.col("text"), F.lit(""))).alias("base"))
    # Rows without an entity can't have terms. They don't take part in the join's skew:
    # their key stays their own.
    joined = rows.join(added, F.col("_key") == F.col("_id"), "left")
    clean = joined.select("_row", overwritten(F.col("text"), _all_spans(), _label).alias("_clean"))
    return clean.select(*[
        F.col("_clean").alias(c) if c == "text" else F.col("_row").getField(c).alias(c)
        for c in docs.columns])


def op5_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[counted(F.col("base"), kind).alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(described(F.col("base")), 256).alias("base_sha256"),
        described(F.col("spans")).alias("spans"))
