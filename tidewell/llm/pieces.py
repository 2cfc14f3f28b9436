"""SentencePiece encoding by Viterbi over an Aho-Corasick automaton, and decoding."""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import ready_for_python
from tidewell.plans.tables import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# How such models write a space, and what an unknown character costs more
# than the worst piece.
SPACE, UNKNOWN_COST = "▁", 10.0
CACHED_BYTES = 64 << 20  # of distinct words and their ids that a worker keeps, about
CACHED_LETTERS = 64  # of a word that is kept; longer ones hardly repeat
ENTRY_BYTES = 200  # of a kept word beside its letters and ids
LOWEST = float("-inf")
YIELD_IDS = 1 << 20  # ids in an output batch, about


class Vocabulary:
    """The pieces of a model file. It is small, fixed by the file, and sent to the tasks,
    so that only the driver reads the file. Only models that leave characters as they are,
    with spaces escaped and one put in front, are taken."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " ﬁ  Å\t"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model changes characters, which is not supported")
        ids = range(model.vocab_size())
        self.surface = [model.id_to_piece(i) for i in ids]
        self.byte_ids = [0] * 256
        self.raw = [p.replace(SPACE, " ").encode() for p in self.surface]
        self.pieces = []
        for i in ids:
            if model.is_byte(i):
                value = int(self.surface[i][3:5], 16)
                self.byte_ids[value], self.raw[i] = i, bytes([value])
            elif model.is_control(i):
                self.raw[i] = b""
            elif model.is_unknown(i):
                self.raw[i] = " ⁇ ".encode()
            elif not model.is_unused(i):
                self.pieces.append((self.surface[i], model.get_score(i), i))
        self.unknown = None if any(self.byte_ids) else model.unk_id()
        self.raw_lengths = np.array([len(r) for r in self.raw], np.int64)
        self.raw_starts = np.cumsum(self.raw_lengths) - self.raw_lengths
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)


class Coder:
    """Encodes and decodes texts with a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score, i in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.unknown_score = min(s for _, s, _ in vocabulary.pieces) - UNKNOWN_COST
        names = [p for p, _, _ in vocabulary.pieces]
        known = set("".join(names))
        # Where no piece reaches from one character to the next, the best path of the whole
        # is that of its parts, which repeat and are kept. That is so before a space unless
        # some piece has one inside, and around line ends unless some piece has one.
        ends = "".join(c for c in "\n\r\t" if c not in known)
        inner = any(SPACE in p.lstrip(SPACE) for p in names)
        words = f"[^{ends}]+" if inner else f"{SPACE}+[^{SPACE}{ends}]*|[^{SPACE}{ends}]+"
        self.cut = re.compile(f"{words}|[{ends}]" if ends else words, re.DOTALL)
        self.single = frozenset(n for n in names if len(n) == 1)
        self.kept: dict[str, bytes] = {}
        self.held = 0

    def best_path(self, text: str) -> list[int]:
        """Ids of the segmentation with the largest sum of scores, in one pass.

        At each position the automaton's state and its output links give every piece that
        ends there, longest first; each relaxes the best score so far. Of equal sums the
        longer last piece stays. A character without a piece of its own is unknown.
        """
        n = len(text)
        best, start, piece = [0.0] + [LOWEST] * n, [0] * (n + 1), [-1] * (n + 1)
        settled = n if self.single.issuperset(text) else 0
        for last, (length, score, i) in self.automaton.iter(text):
            if settled < last:
                self._settle(text, best, start, settled, last)
                settled = last
            end = last + 1
            score += best[end - length]
            if score > best[end]:
                best[end], start[end], piece[end] = score, end - length, i
        self._settle(text, best, start, settled, n)
        path, at = [], n
        while at:
            if piece[at] >= 0:
                path.append(piece[at])
            elif self.vocabulary.unknown is not None:
                path.append(self.vocabulary.unknown)
            else:
                raw = text[start[at]:at].encode("utf-8", "surrogatepass")
                path.extend(self.vocabulary.byte_ids[b] for b in reversed(raw))
            at = start[at]
        path.reverse()
        return path

    def _settle(self, text, best, start, settled, upto):
        """Lets unknown characters up to a position count, where they are the best way."""
        for at in range(settled + 1, upto + 1):
            score = best[at - 1] + self.unknown_score
            if score > best[at] and text[at - 1] not in self.single:
                best[at], start[at] = score, at - 1

    def encoded(self, text: str | None) -> bytes:
        """A text's ids, as int32 one after the other."""
        if not text:
            return b""
        words = self.cut.findall(SPACE + text.replace(" ", SPACE))
        kept = self.kept
        found = list(map(kept.get, words))
        if None in found:
            for at, word in enumerate(words):
                if found[at] is None:
                    ids = kept.get(word)
                    if ids is None:
                        ids = np.array(self.best_path(word), np.int32).tobytes()
                        if len(word) <= CACHED_LETTERS:
                            self._keep(word, ids)
                    found[at] = ids
        return b"".join(found)

    def _keep(self, word: str, ids: bytes) -> None:
        if self.held >= CACHED_BYTES:
            self.kept.clear()
            self.held = 0
        self.kept[word] = ids
        self.held += ENTRY_BYTES + 4 * len(word) + len(ids)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encoded(text), np.int32).tolist()

    def decode_all(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of lists of ids, given one after the other with their sizes: pieces and
        bytes joined, without the space put in front."""
        own = self.vocabulary
        lengths = own.raw_lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(own.raw_starts[ids] - (ends - lengths), lengths) + np.arange(total)
        raw = own.raw_bytes[places].tobytes()
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return [raw[a:b].decode("utf-8", "replace").removeprefix(" ")
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_CODERS: dict[str, Coder] = {}


def _coder(name: str, vocabulary) -> Coder:
    """A worker's coder, made once for all its tasks."""
    if name not in _CODERS:
        _CODERS[name] = Coder(vocabulary.value)
    return _CODERS[name]


def _lists(ids: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _with_column(df: DataFrame, name: str, kind: str, made, model: str) -> DataFrame:
    """``df`` with one more column, made from each batch in parts of bounded size."""
    ready_for_python(df.sparkSession)
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(model))

    names = df.columns

    def run(batches):
        coder = _coder(model, vocabulary)
        for batch in map(lambda b: pa.RecordBatch.from_arrays(b.columns, names=names), batches):
            for start, column in made(coder, batch):
                part = batch.slice(start, len(column))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, column], names=[*names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    # Spark doesn't quote names here, so they go by place.
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, f"{fields}, `{name}` {kind}")


def _encoded(coder, batch):
    texts, ids, start, held = batch.column("text"), [], 0, 0
    for i in range(batch.num_rows):
        ids.append(coder.encoded(texts[i].as_py()))
        held += len(ids[-1]) // 4
        if held >= YIELD_IDS or i + 1 == batch.num_rows:
            yield start, _lists(ids)
            ids, start, held = [], i + 1, 0


def _decoded(coder, batch, ids):
    """Lists are decoded together, up to YIELD_IDS ids and one list more at a time."""
    lists = batch.column(ids)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // YIELD_IDS
    for start in np.flatnonzero(np.r_[True, group[1:] != group[:-1]][:len(group)]):
        end = int(np.searchsorted(group, group[start], side="right"))
        part = lists.slice(int(start), end - int(start))
        texts = coder.decode_all(part.flatten().to_numpy(zero_copy_only=False), sizes[start:end])
        yield int(start), pa.array(texts, pa.string(), mask=part.is_null().to_numpy(zero_copy_only=False))


def encode(rows: DataFrame, model: str = MODEL, name: str = "ids") -> DataFrame:
    """``rows`` with a column ``name``, the pieces of ``text`` by the best sum of the model's
    scores.

    Null and empty texts have no ids. Other columns stay, whatever their names, so give a
    ``name`` that none of them has; an empty table stays empty. The scores of the model are
    used as they are, whatever it was trained as.
    """
    return _with_column(rows, name, "array<int>", _encoded, model)


def decode(rows: DataFrame, model: str = MODEL, name: str = "decoded", ids: str = "ids") -> DataFrame:
    """``rows`` with a column ``name``, the text of ``ids``. It is the text that was encoded,
    byte for byte, but that U+2581 comes back as the space it stands for. Null ids give
    null, bytes that are no UTF-8 the replacement character."""
    return _with_column(rows, name, "string", functools.partial(_decoded, ids=ids), model)


def op3_pieces(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return decode(encode(docs)).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), exact.alias("exact"))
