"""Words and word shingles of Arrow text columns as 64-bit hashes, in whole-array steps.

A batch of texts is one byte buffer with offsets. Words are runs of word bytes inside a text, ASCII capitals count
as small letters, and a word's hash is a polynomial over its bytes taken from running sums: no step loops over words.
Running sums are taken over slices of the buffer, so memory follows the slice and the longest word, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], dtype=bool)


# Words of any signs but ASCII white space, and words of ASCII letters, digits and all other alphabets.
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = _table(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint64) + _U(1)

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (the finalizer of a common 64-bit hash)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of at most ``most`` bytes of text, or of one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(batch):
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
        stop = max(at + 1, stop)
        yield batch.slice(at, stop - at)
        at = stop


def sliced(batches: Iterable[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """All batches in such runs: the arrays made of one follow its bytes."""
    for batch in batches:
        yield from slices(batch, column)


class Words:
    """Hash, start, end and text number of each word of a batch; ``first[i]:first[i + 1]`` are those of text ``i``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED):
        inside = table[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        full = offsets[:-1][offsets[1:] > offsets[:-1]]
        before[full] = False
        after[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.first[-1] = len(self.start)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), dtype=np.uint64)
        i = 0
        while i < len(self.start):
            low = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, low + SLICE_BYTES, side="right")))
            high = self.end[j - 1]
            powers, inverse = _power_tables(int(high - low) + 1)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(_LOWER[self.data[low:high]] * powers[: high - low], out=sums[1:])
            start, end = self.start[i:j] - low, self.end[i:j] - low
            out[i:j] = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
            i = j
        return out

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each word on, and whether they all lie in one text."""
        n = len(self.hash)
        rows = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))
        if n < size:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for k in range(size):
            total = (total + self.hash[k:n - size + 1 + k]) * _U(0xD6E8FEB86659FD93)
        return mix(total), rows[: n - size + 1] == rows[size - 1:]

    def whole(self, row: int) -> np.ndarray:
        """One shingle of all words of a text."""
        total = np.zeros(1, dtype=np.uint64)
        for h in self.hash[self.first[row]:self.first[row + 1]]:
            total = (total + h) * _U(0xD6E8FEB86659FD93)
        return mix(total)

    def text(self, i: int, size: int) -> str:
        """The ``size`` words from word ``i`` on, as they are compared."""
        words = (bytes(self.data[self.start[k]:self.end[k]]).lower() for k in range(i, i + size))
        return b" ".join(words).decode("utf-8", "replace")
