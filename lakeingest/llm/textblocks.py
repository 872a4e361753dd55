"""Vectorised words of whole texts inside tasks: Arrow string buffers in, numpy arrays out.

A word is a maximal run of bytes outside ``{space, \\t, \\n, \\v, \\f, \\r}``, which on UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` on code points. A null text has no words. Texts are handled in chunks of about
``CHUNK_BYTES``; one longer text forms a chunk of its own, so no text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240601)
_BYTE_KEYS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_SHINGLE_KEYS = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers_to(n: int) -> np.ndarray:
    """1, k, k^2 ... k^(n-1) modulo 2^64, grown on demand to the longest word seen."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * _ODD)])
    return _powers


@dataclass
class Words:
    """The words of a chunk of texts. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    data: np.ndarray    # the chunk's bytes
    begin: np.ndarray   # where each text begins in ``data``; one more at the end
    start: np.ndarray   # where each word begins in ``data``
    end: np.ndarray
    doc: np.ndarray     # the text of each word
    first: np.ndarray   # the first word of each text; one more at the end

    def hashes(self, lower: bool) -> np.ndarray:
        """A 64-bit hash of each word's bytes (with A-Z as a-z if ``lower``)."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        data = _LOWER[self.data] if lower else self.data
        length = self.end - self.start
        total = int(length.sum())
        heads = np.cumsum(length) - length
        inside = np.arange(total, dtype=np.int64) - np.repeat(heads, length)
        at = inside + np.repeat(self.start, length)
        value = _BYTE_KEYS[data[at]] * _powers_to(int(length.max()))[inside]
        return mix64(np.add.reduceat(value, heads) + length.astype(np.uint64) * _ODD)


def words(data: np.ndarray, begin: np.ndarray, apart: np.ndarray = _WHITE) -> Words:
    """Words of the texts ``data[begin[d]:begin[d + 1]]``; ``apart`` tells which bytes lie between words."""
    n = int(begin[-1])
    inner = ~apart[data[:n]]
    before = np.zeros(n, dtype=bool)
    before[1:] = inner[:-1]
    cuts = begin[:-1][begin[:-1] < n]
    before[cuts] = False
    start = np.flatnonzero(inner & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inner[1:]
    ends = begin[1:][begin[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(inner & ~after) + 1
    first = np.searchsorted(start, begin)
    doc = np.repeat(np.arange(len(begin) - 1), np.diff(first))
    return Words(data, begin, start, end, doc, first)


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of a string column: (first row, end row, bytes, offsets into them), about ``CHUNK_BYTES`` at a time."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``k`` words inside one text, and the index of its first word."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        total += hashes[j:j + m] * _SHINGLE_KEYS[j]
    at = np.flatnonzero(doc[:m] == doc[k - 1:k - 1 + m])
    return mix64(total[at]), at


def sequence_hash(hashes: np.ndarray, w: Words, seed: int) -> np.ndarray:
    """A 64-bit hash of each text's whole word sequence (0 words: 0)."""
    n = len(w.first) - 1
    out = np.zeros(n, dtype=np.uint64)
    if len(hashes):
        place = (np.arange(len(hashes)) - w.first[w.doc]).astype(np.uint64)
        value = mix64(hashes + mix64(place + np.full(1, seed, np.uint64)))
        full = np.flatnonzero(np.diff(w.first))
        out[full] = np.add.reduceat(value, w.first[full])
    return mix64(out + np.full(1, seed, np.uint64) * _ODD)
