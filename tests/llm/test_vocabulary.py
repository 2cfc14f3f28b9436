"""Spelling variants, phrases and benchmark passages against plain Python."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.llm import overlap, phrases, spelling

DOCS = "doc_id long, text string, lang string, source string, `a.b` int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows, parts=5):
    full = [(i, t, lang, "s", 1) for i, t, lang in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


# Spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_counts(rows):
    counts = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_variants(rows):
    counts = plain_counts(rows)
    out = {}
    for word, n in counts.items():
        close = sorted((-m, o) for o, m in counts.items() if o != word and near(word, o))
        form = close[0] if close and -close[0][0] >= 5 * n else None
        out[word] = [form and form[1], None, n, len(close), form and -form[0]]
    for word, row in out.items():
        row[1] = word
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return out


def vocabulary_rows(seed=3):
    """Words of few letters, so that many are one error apart, in frequencies that chain."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    base += ["interest", "ìnterest", "Interests", "interes", "nterests", "aaaaaa", "aaaaaaa", "aaaaaaaa"]
    base += ["x" * 3000, "x" * 3001, "y" + "x" * 2999, "ß" * 700]
    words = []
    for word in base:
        words += [word] * rng.choice([1, 4, 5, 6, 30, 200] if len(word) < 20 else [5, 30])
    words += ["kettles"] * 400 + ["kettle"] * 50 + ["kettlé"] * 8
    rng.shuffle(words)
    rows = [(i, rng.choice([" ", ", 1", "\n"]).join(words[i::80]), "en") for i in range(80)]
    rows += [(500, None, "en"), (501, "", None), (None, "interest INTERESTS", "en"), (502, "short", "en")]
    return rows + rows[:3]


@pytest.mark.parametrize("tile", [1 << 16, 300])
def test_variants_are_those_of_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE_CHARS", tile)
    rows = vocabulary_rows()
    got = {r.word: [r.form, r.root, r.n, r.n_near, r.form_n]
           for r in spelling.variant_groups(documents(spark, rows)).collect()}
    wanted = plain_variants(rows)
    assert got == wanted
    assert any(r[0] and wanted[r[0]][0] for r in wanted.values())  # a chain of two


def test_slices_find_all_words_one_error_away():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(150)})
    codes, lengths, letters = spelling._letters(words)
    slices = spelling.Slices(codes, lengths, letters)
    everything = slices.packed(np.ones(len(words), bool))[None]
    for i, word in enumerate(words):
        sets = slices.near(codes[i:i + 1, :len(word)], everything)
        found = sorted(words[p] for bits in sets for p in spelling._members(bits)[1])
        assert found == [w for w in words if near(w, word)]


def test_spelling_of_an_empty_table(spark):
    none = spelling.variant_groups(documents(spark, [(1, "x", "en")]).where("false"))
    assert none.columns == ["word", "form", "root", "n", "n_near", "form_n"] and none.count() == 0


# Phrases


def plain_phrases(rows, support, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        own = {p: n for p, n in f.items() if len(p) > 1 and n >= support}
        ranked = []
        for p, a in own.items():
            if any(len(q) > len(p) and 100 * n >= 80 * a
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, n in own.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, rank, p.decode(), -a, l, r, totals[lang], -score)
                for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def phrase_rows(seed=4):
    rng = random.Random(seed)
    words = ["the", "The", "sea", "été", "of", "a", "b", "c-d", "(x)", "日本"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!"])
                       for _ in range(rng.randint(0, 60)))
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    rows += [(200, "one two three four five " * 12, "en"), (201, None, "en"), (202, "", "xx"),
             (203, "only " * 50, "zz"), (205, "red blue green. " * 20 + "blue. green. " * 9, "de"), (204, ".,;\n \t", None)]
    return rows + rows[:2]


@pytest.mark.parametrize(("chunk", "hot"), [(1 << 24, 1024), (700, 40)])
def test_phrases_are_those_of_brute_force(spark, monkeypatch, chunk, hot):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "SAMPLE", 2)
    monkeypatch.setattr(phrases, "SALTS", 4)
    rows = phrase_rows()
    got = phrases.collocations(documents(spark, rows), support=6, top=40)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got.columns == columns
    wanted = plain_phrases(rows, 6, 40)
    assert sorted(map(tuple, got.collect())) == wanted
    assert {len(w[2].split()) for w in wanted} == {2, 3, 4}


def test_frequent_first_words_are_dealt_to_several_slots(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SAMPLE", 1)
    rows = [(i, " ".join(f"the w{j}" for j in range(i, i + 40)), "en") for i in range(40)]
    docs = documents(spark, rows).select("lang", "text")
    slots = phrases._frequent_firsts(docs)
    assert slots[b"the"] == 256 and all(n <= 256 for n in slots.values())
    stripes = phrases._stripes(docs, slots).where("prefix = 'the'")
    dealt = stripes.selectExpr("slot", "explode(next) as next").distinct().groupBy("next").count()
    assert stripes.select("slot").distinct().count() > 30
    assert dealt.where("count > 1").isEmpty()


def test_phrases_of_empty_tables(spark):
    docs = documents(spark, [(1, None, None), (2, " ", "en")])
    for some in (docs, docs.where("false")):
        assert phrases.collocations(some).count() == 0


# Benchmark passages


def plain_overlap(rows, items, window=10):
    def words(text):
        return [w for w in re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))]

    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            windows[tuple(own[i:i + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text, _ in rows:
        own, hit, found = words(text), set(), set()
        for size, i in itertools.product(sizes, range(len(own))):
            if i + size <= len(own) and tuple(own[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found |= windows[tuple(own[i:i + size])]
        out.append((doc_id, len(own), sorted(hit), sorted(found)))
    return sorted(out, key=repr)


def overlap_tables(spark):
    rng = random.Random(9)
    words = ["Sea", "sky", "été", "x1", "THE", "of", "日本", "q"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(8, 45)))) for i in range(40)]
    items += [(100, "solitary"), (101, "Two words!"), (102, ""), (103, None), (None, "no id here"),
              (7, "a second text of item seven with more than ten words in all"), items[3], (200, items[3][1]),
              (201, "again " * 14)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        if i % 3 == 0:
            text += " - " + str(rng.choice(items)[1]).upper() + ". " + text
        rows.append((i, text, "en"))
    rows += [(100, None, "en"), (101, "", "en"), (102, "solitary, TWO   words", "en"), (None, "no id here", "en"),
             (103, "again " * 3000, "en"), (104, items[5][1], "en"), (105, "none of that", "en")]
    rows += rows[:2]
    return rows, items, documents(spark, rows), spark.createDataFrame(
        items, "item_id long, text string").withColumn("spans", F.lit(1))


def found_rows(df):
    return sorted(((r.doc_id, r.n_words, sorted(itertools.chain(*(range(*s) for s in r.spans))), r["items"])
                   for r in df.collect()), key=repr)


@pytest.mark.parametrize(("shard", "block"), [(1 << 24, 1 << 24), (900, 700)])
def test_passages_are_those_of_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(overlap, "SHARD_BYTES", shard)
    monkeypatch.setattr(overlap, "BLOCK_BYTES", block)
    rows, items, docs, benchmark = overlap_tables(spark)
    got = overlap.contamination(docs, benchmark)
    assert got.columns == ["doc_id", "text", "lang", "source", "a.b", "n_words", "items", "spans"]
    wanted = plain_overlap(rows, items)
    assert found_rows(got) == wanted
    clean = overlap.decontaminated(docs.withColumnRenamed("source", "spans"), benchmark)
    assert clean.columns == ["doc_id", "text", "lang", "spans", "a.b"]
    assert sorted((r[0] for r in clean.collect()), key=repr) == [w[0] for w in wanted if not w[2]]


def test_op13_digests(spark, tmp_path):
    rows, items, docs, benchmark = overlap_tables(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = overlap.op13_overlap(spark, str(tmp_path)).collect()
    wanted = [(d, n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit))
              for d, n, hit, found in plain_overlap(rows, items)]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_longest_matches(spark, monkeypatch):
    monkeypatch.setattr(overlap, "SHARD_BYTES", 500)
    items = [(1, "a b c d e f g h"), (2, "x y z"), (3, "nothing")]
    rows = [(5, "zz c d e", "en"), (4, "q b c d e r", "en"), (6, "x y z x y z", "en"), (7, "b c d e", "en"), (8, None, "en")]
    docs = documents(spark, rows)
    got = overlap.longest_matches(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == [("1", 4, 1, 4, 1), ("2", 3, 0, 6, 0)]


def test_suffix_array_orders_by_all_words():
    rng = random.Random(2)
    for _ in range(40):
        ids = [rng.randint(0, 3) for _ in range(rng.randint(1, 80))] + [0]
        depth = rng.randint(1, 40)
        order = overlap.suffix_array(np.array(ids), depth).tolist()

        def key(p):
            own = ids[p:p + depth] + [0]
            return own[:own.index(0)]

        assert sorted(order) == [p for p, i in enumerate(ids) if i]
        assert [key(p) for p in order] == sorted(key(p) for p in order)


def test_overlap_of_empty_tables(spark):
    _, _, docs, benchmark = overlap_tables(spark)
    assert overlap.contamination(docs.where("false"), benchmark).count() == 0
    nothing = overlap.contamination(docs, benchmark.where("false"))
    assert nothing.where("size(spans) > 0 or size(items) > 0").isEmpty() and nothing.count() == docs.count()
    assert overlap.longest_matches(docs, benchmark.where("false")).count() == 0
