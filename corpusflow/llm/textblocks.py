"""Words of many texts at once, as numpy arrays over UTF-8 bytes.

A word is a run of bytes other than the ASCII white space 0x20, 0x09-0x0D,
which is the same as a run of such code points.  A block holds whole texts of
about ``BLOCK_BYTES`` together (one longer text makes a block of its own), so
the arrays stay small whatever the size of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1_500_000
_CHUNK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_MASK = (1 << 64) - 1
_R = 0x9E3779B97F4A7C15
_Q = 0xD1342543DE82EF95
_BYTE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & _MASK))
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, at least n of each."""
    have = _TABLES.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, _CHUNK + 64)
        have = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
        _TABLES[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, off, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, raw


class Words:
    """Words of consecutive texts: byte ranges, and the first word of each text."""

    def __init__(self, data: np.ndarray, text_at: np.ndarray, space: np.ndarray = _SPACE):
        """``data``: the texts' bytes, one after another; ``text_at``: n + 1 offsets into it; ``space``: which bytes part words."""
        self.data, self.text_at = data, text_at
        solid = ~space[data]
        starts, ends = solid.copy(), solid.copy()
        starts[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        cut = text_at[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        starts[cut] = solid[cut]
        ends[cut - 1] = solid[cut - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        #: words[first[i]:first[i + 1]] are those of text i
        self.first = np.searchsorted(self.start, text_at, side="left")

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes (of ``data``, if given, at the same places)."""
        data = self.data if data is None else data
        out = np.empty(len(self.start), np.uint64)
        lo, n = 0, len(self.start)
        with np.errstate(over="ignore"):
            while lo < n:
                base = self.start[lo]
                hi = max(lo + 1, int(np.searchsorted(self.end, base + _CHUNK, side="right")))
                if self.end[hi - 1] - base > _CHUNK:
                    out[lo] = _long_hash(data[base:self.end[lo]])
                    lo += 1
                    continue
                part = data[base:self.end[hi - 1]]
                power, inverse = _tables(_R, len(part) + 1)
                total = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(_BYTE[part] * power[:len(part)], out=total[1:])
                s, e = self.start[lo:hi] - base, self.end[lo:hi] - base
                out[lo:hi] = (total[e] - total[s]) * inverse[s] ^ (e - s).astype(np.uint64)
                lo = hi
        return mix(out)


def _long_hash(part: np.ndarray) -> np.uint64:
    """The same polynomial as in Words.hashes, for one word longer than a chunk."""
    acc = 0
    for at in range(0, len(part), _CHUNK):
        piece = part[at:at + _CHUNK]
        power, _ = _tables(_R, len(piece))
        with np.errstate(over="ignore"):
            h = int((_BYTE[piece] * power[:len(piece)]).sum(dtype=np.uint64))
        acc = (acc + h * pow(_R, at, 1 << 64)) & _MASK
    return np.uint64((acc ^ len(part)) & _MASK)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, their words), over all rows of the column."""
    offsets, raw = arrays(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1))
        yield lo, hi, Words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words (also across texts); none if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for i in range(k):
            h = h * np.uint64(_R) + words[i:n + i]
    return mix(h)


class Prefix:
    """Hashes of any run of words in constant time, from prefix sums."""

    def __init__(self, words: np.ndarray):
        power, self._inverse = _tables(_Q, len(words) + 1)
        self._total = np.zeros(len(words) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(words * power[:len(words)], out=self._total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of words[start:end] for arrays of starts and ends."""
        with np.errstate(over="ignore"):
            h = (self._total[end] - self._total[start]) * self._inverse[start]
            return mix(h ^ (end - start).astype(np.uint64))


def row_of(first: np.ndarray) -> np.ndarray:
    """The text number of each word, from Words.first."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
