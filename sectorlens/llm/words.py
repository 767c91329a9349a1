"""Words of many texts at once: byte positions and 64-bit hashes in numpy.

Words are runs of bytes outside a set of ASCII separators, so that UTF-8 need not be decoded.
Callers hand over Arrow batches; :func:`slices` cuts them so that a task's arrays stay bounded
by ``LIMIT`` bytes of text, or by one text where that is longer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 1_000_000
# The C library of this process; not all have malloc_trim.
_LIBC = ctypes.CDLL(None)
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
# Separators where only digits, letters and bytes beyond ASCII make words.
NOT_LETTERS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_BASE, _MIX1, _MIX2 = (np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64); ``salt`` gives another spread."""
    x = values + np.uint64(int(_BASE) * (salt + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text",
           limit: int = LIMIT) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, one row at least.

    After the last one freed memory goes back to the system: workers live on from stage to stage.
    """
    for batch in batches:
        sizes = np.cumsum(np.asarray(pc.fill_null(
            pc.binary_length(batch[text]), 0), dtype=np.int64))
        begin = 0
        while begin < len(sizes):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """Words of a batch in order: their text's row, byte range in ``data`` and hash."""

    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def first(self) -> np.ndarray:
        """For each row, and one beyond, the number of words before it."""
        return np.searchsorted(self.row, np.arange(len(self.offsets)))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins, and the last ends.  Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    plain = pc.fill_null(texts, "").cast(pa.large_string())
    _, places, data = plain.buffers()
    offsets = np.frombuffer(places, np.int64)[plain.offset:plain.offset + len(plain) + 1]
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, separators: bytes = BLANKS, lower: bool = True) -> Words:
    """All words of all texts; ``lower`` turns A-Z into a-z first."""
    data, offsets = raw(texts)
    if lower:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        data = table[data]
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    inside = inside[data]
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[:1] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[-1:] = False
    start = np.flatnonzero(inside & ~(before & ~edges[:-1]))
    end = np.flatnonzero(inside & ~(after & ~edges[1:])) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, row, start, end, _hashes(data, inside, start, end))


def _hashes(data: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    sizes = end - start
    powers = np.cumprod(np.full(int(sizes.max()), _BASE, np.uint64))
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms = (data[inside].astype(np.uint64) + np.uint64(1)) * powers[place]
    sums = np.add.reduceat(terms, np.cumsum(sizes) - sizes)
    return mixed(sums + sizes.astype(np.uint64))


def runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` consecutive words of one text, and the index of their first word."""
    at = np.arange(max(0, len(words.row) - size + 1))
    at = at[words.row[at] == words.row[at + size - 1]] if len(at) else at
    return whole_runs(words, at, size), at


def whole_runs(words: Words, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words that begin at the given words."""
    total = np.zeros(len(at), np.uint64)
    for step in range(size):
        total = mixed(total * _MIX1 + words.hash[at + step])
    return total
