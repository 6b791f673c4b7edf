"""Words, hashes and shingles of whole Arrow batches of text, as numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as a-z where asked.
Every array covers a slice of documents of bounded size, so memory does not follow the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SHINGLE_WORDS = 5

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of splitmix64)."""
    values = values ^ (values >> _U64(30))
    values = values * _U64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> _U64(27))
    values = values * _U64(0x94D049BB133111EB)
    return values ^ (values >> _U64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U64) * _U64(0xD1342543DE82EF95))
_PLACES = mix(np.arange(1, SHINGLE_WORDS + 1, dtype=_U64) * _U64(0xA0761D6478BD642F)) | _U64(1)


def _powers(base: int, n: int) -> np.ndarray:
    table = np.full(n, base, dtype=_U64)
    table[:1] = 1
    return np.multiply.accumulate(table)


class Slice:
    """Some neighbouring documents of a batch: their bytes, and where their words are.

    ``first`` and ``count`` say which documents; ``word_doc`` numbers them from 0 and
    ``doc_words`` holds, for each, the place of its first word, and the end of the last.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int, lower: bool):
        self.first, self.count = first, len(bounds) - 1
        self.raw = data[bounds[0]:bounds[-1]]
        self.bounds = bounds - bounds[0]
        self.data = _LOWER[self.raw] if lower else self.raw
        inside = ~_SEPARATOR[self.raw]
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]
        fresh[edges] = inside[edges]
        inner = edges[edges > 0] - 1
        last[inner] = inside[inner]
        self.starts = np.flatnonzero(fresh)
        self.ends = np.flatnonzero(last) + 1
        self.doc_words = np.searchsorted(self.starts, self.bounds)
        self.word_doc = np.repeat(np.arange(self.count), np.diff(self.doc_words))

    def range_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each range, which depends on nothing outside it."""
        up, down = _powers(_BASE, len(self.data)), _powers(_INVERSE, len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=_U64)
        np.cumsum(_BYTE_VALUES[self.data] * up, out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U64))

    def word_hashes(self) -> np.ndarray:
        return self.range_hashes(self.starts, self.ends)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of five words of one document, or of all its words if there are fewer."""
    n = len(words)
    if not n:
        return words
    if n < SHINGLE_WORDS:
        return mix((words * _PLACES[:n]).sum(dtype=_U64, keepdims=True) + _U64(n))
    total = words[:n - SHINGLE_WORDS + 1] * _PLACES[0]
    for i in range(1, SHINGLE_WORDS):
        total = total + words[i:n - SHINGLE_WORDS + 1 + i] * _PLACES[i]
    return mix(total)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds of a text column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return bytes_, bounds.astype(np.int64)


def slices(column: pa.Array, lower: bool = True, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The documents of a text column in slices of about ``size`` bytes; a longer text is one."""
    data, bounds = text_buffers(column)
    first = 0
    while first < len(column):
        stop = int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1
        stop = max(stop, first + 1)
        yield Slice(data, bounds[first:stop + 1], first, lower)
        first = stop
