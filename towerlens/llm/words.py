"""Vectorised word splitting and hashing over Arrow text columns.

Texts stay in Arrow's UTF-8 buffer: separators are ASCII, so words are found
bytewise, and every step is a numpy pass over a slice of bounded size.  Word
and word-sequence hashes are 64-bit polynomial hashes computed from prefix
sums, so all n-word windows of a slice cost one subtraction each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000       # below a power of two, to which tables of powers grow
SLICE_ROWS = 2048

#: bytewise class tables: True marks a byte that separates words
SPACE_SEPARATED = np.zeros(256, bool)
SPACE_SEPARATED[[0x20, *range(0x09, 0x0E)]] = True
ALNUM_WORDS = np.zeros(256, bool)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    ALNUM_WORDS[_lo:_hi + 1] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: odd multipliers (units modulo 2**64) of independent polynomial hashes
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_M64 = (1 << 64) - 1


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finaliser; spreads every input bit over the result."""
    h = h.astype(np.uint64, copy=True)
    h ^= np.uint64((seed * 0x9FB21C651E98DF25) & _M64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept until the task's end and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, np.uint64)
            done = 1
            while done < size:
                step = np.uint64(pow(b, done, 1 << 64))
                p[done:2 * done] = p[:done] * step
                done *= 2
            out.append(p)
        have = _powers[base] = tuple(out)
    return have[0][:n], have[1][:n]


def forget_powers() -> None:
    """Drop the tables of powers; the next use makes them again in some milliseconds."""
    _powers.clear()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into ranges of at most ``limit`` text bytes and SLICE_ROWS rows; a longer text is a slice of its own.

    Empty batches are passed over, so an empty partition yields nothing.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(text))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), at + SLICE_ROWS)
            yield batch.slice(at, end - at)
            at = end


@dataclass
class Words:
    """Words of the texts of one slice, in order."""

    data: np.ndarray    # bytes, lower-cased if asked for
    start: np.ndarray   # first byte of each word
    end: np.ndarray     # one past its last byte
    first: np.ndarray   # index of each text's first word; one more entry closes the last text

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A mixed 64-bit hash of each word, from words of at most about SLICE_BYTES at a time."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            low = int(self.start[at])
            stop = max(int(np.searchsorted(self.end, low + SLICE_BYTES, "right")), at + 1)
            out[at:stop] = self._hashes(self.start[at:stop] - low, self.end[at:stop] - low, self.data[low:int(self.end[stop - 1])])
            at = stop
        return out

    @staticmethod
    def _hashes(start: np.ndarray, end: np.ndarray, data: np.ndarray) -> np.ndarray:
        n = len(data)
        up, down = powers(BYTE_BASE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = (total[end] - total[start]) * down[start]
        return mix(h + (end - start).astype(np.uint64))

    def texts(self, index: np.ndarray) -> pa.Array:
        """The chosen words as an Arrow string array."""
        lo, n = self.start[index], (self.end - self.start)[index]
        offsets = np.zeros(len(index) + 1, np.int64)
        np.cumsum(n, out=offsets[1:])
        where = np.repeat(lo - offsets[:-1], n) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.large_string(), len(index),
                                     [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(self.data[where]))])


def split(column: pa.Array, separators: np.ndarray = SPACE_SEPARATED, lower: bool = False) -> Words:
    data, offsets = text_buffer(column)
    if lower:
        data = _LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True          # no word crosses from one text into the next
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def window_hashes(word: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (positions near the end of the slice are left out)."""
    n = len(word)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = powers(base, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(word * up[:n], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n - size + 1])


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Which positions of ``window_hashes`` lie inside one text."""
    n = int(first[-1])
    if n < size:
        return np.zeros(0, bool)
    last = np.repeat(first[1:], np.diff(first))
    return np.arange(n - size + 1) + size <= last[:n - size + 1]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    d = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)




def sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each ``size`` neighbouring values."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out
