"""Arrow text columns as numpy arrays: words and their hashes without a loop over rows.

A text is cut into words by a table of separator bytes, which is safe in UTF-8
because every separator is below 128. A word's hash is a polynomial over its
bytes modulo 2**64, taken from prefix sums and then mixed; work runs in blocks
that end at a separator, so memory follows the number of words, not of bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# for comparing texts: everything in ASCII but letters and digits separates
_PUNCT = np.zeros(256, bool)
_PUNCT[:128] = True
_PUNCT[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = False

SEPARATORS = {"space": _SPACE, "punctuation": _PUNCT}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def seeded(h: np.ndarray, seed: int) -> np.ndarray:
    return mix(h + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LOWER_BYTES = _BYTES[LOWER]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if _powers[0].size < n:
        inverse = np.uint64(pow(int(_MULTIPLIER), -1, 2**64))
        for i, base in enumerate((_MULTIPLIER, inverse)):
            steps = np.full(n, base)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def column(values: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets; a null is an empty text."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values.cast(pa.large_string()), "")
    if lower:
        values = pc.utf8_lower(values)
    _, ends, data = values.buffers()
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(ends.size, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def returning(work: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``work`` over Arrow batches, after which its task hands free memory back to the system.

    Python workers live on for later tasks and stages, and what Arrow and the C library keep of
    one task is of no use to the next: without this a long job's memory only grows.
    """

    @wraps(work)
    def run(*args):
        try:
            yield from work(*args)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Hand memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):  # the GNU C library has it
        library.malloc_trim(0)


class Words:
    """The words of some texts: starts, ends, hashes, and the count of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: str = "space", fold: bool = True):
        inside = ~SEPARATORS[separators][data]
        begin, stop = inside.copy(), inside.copy()
        if data.size:
            begin[1:] &= ~inside[:-1]
            stop[:-1] &= ~inside[1:]
            firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
            begin[firsts] = inside[firsts]
            lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
            stop[lasts] = inside[lasts]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(stop) + 1
        self.counts = np.diff(np.searchsorted(self.starts, offsets))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.hashes = self._hash(data, _LOWER_BYTES if fold else _BYTES)

    def _hash(self, data: np.ndarray, table: np.ndarray) -> np.ndarray:
        out = np.empty(self.starts.size, np.uint64)
        at = 0
        while at < out.size:
            origin = self.starts[at]
            # words that start inside the block; the last may end beyond it
            upto = max(at + 1, int(np.searchsorted(self.starts, origin + BLOCK)))
            size = int(self.ends[upto - 1] - origin)
            power, inverse = _power_tables(size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(table[data[origin : origin + size]] * power[:size], out=sums[1:])
            a, b = self.starts[at:upto] - origin, self.ends[at:upto] - origin
            out[at:upto] = (sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * _ODD
            at = upto
        return mix(out)

    def owner(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(self.counts.size), self.counts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every run of ``k`` words of a text, and the count of each text.

        A text of fewer words is one run; a text without words has none.
        """
        return runs(self.hashes, self.counts, k)


def runs(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = hashes.size
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    acc = hashes.copy()
    shorter = {}
    for j in range(1, k):
        few = counts == j
        if few.any():
            shorter[j] = (first[few], acc[first[few]])
        acc[: max(n - j, 0)] = acc[: max(n - j, 0)] * _ODD + hashes[j:]
    left = np.repeat(first + counts, counts) - np.arange(n)
    keep = left >= k
    for at, value in shorter.values():
        acc[at] = value
        keep[at] = True
    return mix(acc[keep]), np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))


def per_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of ``values``; an empty stretch sums to zero."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
