"""Word hashes of whole Arrow batches, by numpy alone.

A byte is looked up in a table of random 64-bit numbers, and a run of bytes has the sum of its numbers times powers of an
odd base, mod 2^64, mixed at the end. One cumulative sum over a buffer gives the hash of any word or prefix of a word.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240917))
TABLE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Bytes of text that are hashed together; a longer text is taken alone.
SLICE = 512 * 1024


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    for i, base in enumerate((BASE, BASE_INVERSE)):
        if len(_powers[i]) < n:
            p = np.full(max(n, SLICE + 1), base, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of consecutive texts: `doc` (text of each), `start`, `end` (bytes), and hashes of them or their prefixes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.n = len(offsets) - 1
        low = _LOWER[data]
        word = np.ones(len(data) + 1, bool)
        word[:-1] = ~_BLANK[low]
        word[-1] = False
        first = word[:-1].copy()
        edge = offsets[1:-1]
        edge = edge[edge < len(data)]
        first[1:] &= ~word[:-2]
        first[edge] = word[edge]  # a text begins a new word
        last = word[:-1] & ~word[1:]
        if len(edge):
            inner = edge[edge > 0]
            last[inner - 1] = word[inner - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        p, self.inverse = powers(len(low) + 1)
        self.sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(TABLE[low] * p[: len(low)], out=self.sums[1:])
        self.low = low

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        start = self.start if start is None else start
        end = self.end if end is None else end
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def slices(column):
    """(first row, Words) for runs of rows of an Arrow string column; a null is an empty text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, kind, len(column) + 1 + column.offset)[column.offset :].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + SLICE, side="right")) - 1
        to = min(max(to, at + 1), len(column))
        lo, hi = offsets[at], offsets[to]
        yield at, Words(data[lo:hi], offsets[at : to + 1] - lo)
        at = to
