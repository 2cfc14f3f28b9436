"""Words of many texts at once, by array operations on their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of some closed ranges."""
    inside = np.zeros(256, bool)
    for first, last in ranges:
        inside[first:last + 1] = True
    return inside


class Words(NamedTuple):
    """The words of some texts, one after the other."""

    codes: np.ndarray  # of each word, its place in ``distinct``
    distinct: pa.BinaryArray  # words, and what stands between them
    sizes: np.ndarray  # words of each text
    pieces: np.ndarray  # of each word, how many breaks lie before it


def split(texts: pa.Array, kinds: np.ndarray, breaks: np.ndarray | None = None,
          lower: bool = True) -> Words:
    """Splits texts into maximal runs of bytes of one kind, those of kind 0 (False) left out;
    with ``lower``, A-Z in lower case. Null is empty.

    All bytes beyond ASCII must be of one kind, so that no character is cut. Words and gaps
    between them are neighbouring values of one Arrow array on the texts' own bytes, whose
    dictionary encoding tells them apart exactly, without an object per word.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    buffers, n = texts.buffers(), len(texts)
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + n + 1]
    empty = np.zeros(0, np.int64)
    if not n or offsets[0] == offsets[-1]:
        return Words(empty, pa.array([], pa.binary()), np.zeros(n, np.int64), empty)
    raw = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    raw = LOWER[raw] if lower else raw
    offsets = offsets - offsets[0]
    kind = kinds.astype(np.uint8)[raw]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    changes = np.r_[True, kind[1:] != kind[:-1], True]  # before each byte, and at the end
    changes[cuts] = True
    starts = np.flatnonzero(changes[:-1] & (kind > 0))
    ends = np.flatnonzero(changes[1:] & (kind > 0)) + 1
    sizes = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return Words(empty, pa.array([], pa.binary()), sizes, empty)
    edges = np.empty(2 * len(starts), np.int64)
    edges[0::2], edges[1::2] = starts, ends
    runs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
    encoded = runs.dictionary_encode()
    codes = encoded.indices.to_numpy()[0::2].astype(np.int64)
    pieces = empty
    if breaks is not None:
        pieces = np.cumsum(breaks[raw], dtype=np.int32)[starts]
    return Words(codes, encoded.dictionary, sizes, pieces)


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Batches put together until ``column`` has ``limit`` bytes, and one row more at most.

    A task's memory so follows the limit and its longest row, however rows are batched.
    """
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, base + limit - size)) + 1
            stop = min(max(stop, start + 1), batch.num_rows)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - base
            start = stop
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
