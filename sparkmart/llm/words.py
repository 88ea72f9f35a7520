"""Words of many texts at once: byte positions and 64-bit hashes in numpy.

A word is a maximal run of bytes other than blank and 0x09-0x0D. Texts are UTF-8, in which those
bytes never occur inside a character, so byte runs are character runs. Two words are taken as equal
if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]
_MIX = _rng.integers(1, 2**62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_MIX[0]) | 1
_UNBASE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse; kept for the usual chunk size only."""
    size = CHUNK * 2
    if n <= size and size in _powers:
        up, down = _powers[size]
        return up[:n], down[:n]

    def table(base: int, length: int) -> np.ndarray:
        out = np.full(length, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    if n > size:
        return table(_BASE, n), table(_UNBASE, n)
    _powers[size] = (table(_BASE, size), table(_UNBASE, size))
    return powers(n)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a fresh array in place."""
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    h ^= h >> np.uint64(29)
    h *= _MIX[2]
    h ^= h >> np.uint64(32)
    return h


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string or binary column and the n + 1 offsets; NULL is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    if column.null_count:  # a NULL may cover bytes in the buffer
        full = [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]
        at = np.concatenate([[0], np.cumsum([len(x) for x in full])]).astype(np.int64)
        return np.frombuffer(b"".join(full), np.uint8), at
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


class Words:
    """Words of some texts. ``at``: number of the first word of each text, and the total."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~_SPACE[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1] | first[1:-1]
        end[:-1] &= ~word[1:] | first[1:-1]
        self.starts = np.flatnonzero(start)
        self.ends = np.flatnonzero(end) + 1
        self.at = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def prefix(self, lower: bool) -> np.ndarray:
        up, _ = powers(len(self.data))
        value = (_LOWER if lower else _VALUE)[self.data]
        value *= up
        out = np.empty(len(value) + 1, np.uint64)
        out[0] = 0
        np.cumsum(value, out=out[1:])
        return out

    def hashes(self, lower: bool = True) -> np.ndarray:
        sums = self.prefix(lower)
        _, down = powers(len(self.data) + 1)
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def text_of(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def shingles(self, hashes: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of ``size`` words and the number of the first run of each text.

        A text with fewer words, but one at least, has its whole sequence as its only run.
        """
        n = np.diff(self.at)
        counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        at = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros(at[-1], np.uint64)
        if len(hashes) >= size:
            runs = hashes[: len(hashes) - size + 1] * _MIX[3]
            for k in range(1, size):
                runs += hashes[k : len(hashes) - size + 1 + k] * _MIX[3 + k]
            long = n >= size
            inside = np.zeros(len(hashes) + 1, np.int32)
            inside[self.at[:-1][long]] += 1
            np.subtract.at(inside, (self.at[:-1] + n - size + 1)[long], 1)
            chosen = np.cumsum(inside[:-1])[: len(runs)] > 0
            where = np.repeat(long, counts)
            out[where] = runs[chosen]
        for row in np.flatnonzero((n > 0) & (n < size)):
            total = np.uint64(n[row])
            with np.errstate(over="ignore"):
                for k, h in enumerate(hashes[self.at[row] : self.at[row + 1]]):
                    total += h * _MIX[9 + k]
            out[at[row]] = total
        return mix(out), at
