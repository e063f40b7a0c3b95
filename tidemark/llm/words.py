"""Vectorised words and hashes over Arrow text columns.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text, which is the regular
expression ``[^\\x20\\x09-\\x0D]+`` on its characters. All functions work on one NumPy buffer for many
documents at a time; no Python loop runs over words.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into word arrays at a time; one longer document is taken whole.
CHUNK_BYTES = 2_000_000
#: Rows that are looked at together; at most 2**16, as row numbers share 64 bits with 48-bit hashes.
SLICE_ROWS = 2_000

_NAME = ctypes.util.find_library("c")
_LIBC = ctypes.CDLL(_NAME) if _NAME and hasattr(ctypes.CDLL(_NAME), "malloc_trim") else None
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _table(seed: int) -> np.ndarray:
    t = np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    t[_SPACE] = 0  # white space after a word then adds nothing to its sum
    return t


_TABLES = (_table(20011), _table(20023))
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def mix(z: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums and products of hashes don't show structure."""
    z = z.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


@dataclass
class Words:
    """Words of some documents: byte spans in ``buf``, and for each document its first word."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more entry than there are documents

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes; ``which`` chooses one of two independent functions."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        lo, hi = int(self.start[0]), int(self.end[-1])
        x = _TABLES[which][self.buf[lo:hi]]
        gap = np.diff(np.append(self.start, hi))
        place = np.arange(hi - lo) - np.repeat(self.start - lo, gap)
        x *= powers(_BASES[which], int(gap.max()))[place]
        sums = np.add.reduceat(x, self.start - lo)
        return mix(sums + (self.end - self.start).astype(np.uint64) * _BASES[1 - which])

    def text(self, doc: int, keep: np.ndarray | None = None) -> bytes:
        """The words of a document, or those that ``keep`` marks, joined by one space."""
        a, b = self.first[doc], self.first[doc + 1]
        if a == b:
            return b""
        words = self.buf[self.start[a] : self.end[b - 1]].tobytes().split()
        return b" ".join(words if keep is None else [w for w, k in zip(words, keep.tolist()) if k])


def give_back() -> None:
    """Returns freed memory to the system, which workers that wait for their next task would otherwise keep."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def text_chunks(column: pa.ChunkedArray | pa.Array, lower: bool = False, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, words) for runs of rows of a text column; null texts have no words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    for base in range(0, len(column), SLICE_ROWS):
        # A slice at a time, as its offsets are made wider, which copies the text.
        part = pc.fill_null(column.slice(base, SLICE_ROWS), "").cast(pa.large_string()).cast(pa.large_binary())
        offsets = np.frombuffer(part.buffers()[1], dtype=np.int64)[part.offset : part.offset + len(part) + 1]
        data = part.buffers()[2]
        buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        a = 0
        while a < len(part):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
            text = buf[offsets[a] : offsets[b]]
            yield base + a, base + b, find_words(_LOWER[text] if lower else text, offsets[a : b + 1] - offsets[a])
            a = b
    give_back()


def find_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(buf)
    solid = ~_SPACE[buf]
    before = np.empty(n, dtype=bool)
    before[1:] = solid[:-1]
    before[:1] = False
    after = np.empty(n, dtype=bool)
    after[:-1] = solid[1:]
    after[-1:] = False
    edges = offsets[(offsets < n)]
    before[edges] = False
    edges = offsets[(offsets > 0)]
    after[edges - 1] = False
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    return Words(buf, start, end, np.searchsorted(start, offsets))


def window_hashes(h: np.ndarray, size: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
    """For each place the hash of ``size`` consecutive word hashes from there on (doubling, no loop over places)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out, done, power, part, span, rest = None, 0, base, h, 1, size
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                piece = part[done : done + n]
                out = piece.copy() if out is None else out * power + piece
                done += span
            rest >>= 1
            if rest:
                part = part[: len(part) - span] * power + part[span:]
                power = power * power
                span *= 2
    return mix(out)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Marks the places, of all words, at which a window of ``size`` words stays in its document."""
    ok = np.ones(int(first[-1]), dtype=bool)
    ends = first[1:]
    for back in range(1, size):
        at = ends - back
        ok[at[at >= first[:-1]]] = False
    return ok
