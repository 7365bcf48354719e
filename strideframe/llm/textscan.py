"""Vectorised scanning of text columns inside Arrow batches.

Operators that need word or substring hashes of whole texts work on the UTF-8
bytes of a batch: byte classes by table lookup, words as runs of a class, and
64-bit span hashes from prefix sums, so the cost is a few array passes and no
step runs once per word in Python.  Batches are cut at row ends into chunks of
about ``CHUNK_BYTES``, which bounds the working arrays; only a single longer
text makes a larger chunk.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

U = np.uint64
_MASK = (1 << 64) - 1

#: ASCII upper case to lower case, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in lower-cased text.
WORD = np.zeros(256, dtype=np.uint8)
WORD[48:58] = WORD[97:123] = WORD[128:] = 1

#: Bytes of the words [^\x20\x09-\x0D]+.
NONSPACE = np.ones(256, dtype=np.uint8)
NONSPACE[[9, 10, 11, 12, 13, 32]] = 0


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift-multiply)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class SpanHash:
    """Hashes of byte spans: differences of prefix sums of ``table[byte] *
    base**position``, shifted to position 0.  Equal spans have equal hashes."""

    def __init__(self, seed: int):
        s = mix64(np.array([2 * seed + 1, 2 * seed + 2], dtype=U))
        self.base = int(s[0]) | 1
        self.inv = pow(self.base, -1, 1 << 64)
        self.table = mix64(np.arange(256, dtype=U) + s[1])
        self._pw = self._ipw = np.ones(1, dtype=U)

    def _grow(self, n: int) -> None:
        if len(self._pw) <= n:
            size = max(n + 1, CHUNK_BYTES + 1)
            for name, b in (("_pw", self.base), ("_ipw", self.inv)):
                a = np.full(size, b, dtype=U)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n)
        out = np.zeros(n + 1, dtype=U)
        np.cumsum(self.table[data] * self._pw[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (prefix[ends] - prefix[starts]) * self._ipw[starts]
        return mix64(h + (ends - starts).astype(U) * U(0x9E3779B97F4A7C15))

    def windows(self, prefix: np.ndarray, size: int) -> np.ndarray:
        """Hash of every window of ``size`` bytes, by its start."""
        n = max(0, len(prefix) - size)
        return mix64((prefix[size:size + n] - prefix[:n]) * self._ipw[:n])


FIRST, SECOND = SpanHash(1), SpanHash(2)


def release() -> None:
    """Gives freed memory back to the system: workers are kept between tasks, and a
    batch with a very long text would else leave them large."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


def text_chunks(col, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, data, offsets) for runs of rows lo..hi-1 of a string column
    (null: empty): their bytes and the row starts within them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return
    col = pc.fill_null(col.cast(pa.large_string()), "")
    _, ends, body = col.buffers()
    off = np.frombuffer(ends, dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi
    release()


def runs(cls: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one non-zero byte class; a run
    ends at the end of its row."""
    n = len(cls)
    cut = np.empty(n + 1, dtype=bool)
    np.not_equal(cls[1:], cls[:-1], out=cut[1:n])
    cut[offsets] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    keep = cls[starts] != 0
    return starts[keep], ends[keep]


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, row): spans of row r are first[r]:first[r + 1]; the row of each."""
    first = np.searchsorted(starts, offsets)
    first[-1] = len(starts)
    return first, np.repeat(np.arange(len(offsets) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per row (0 for rows without any)."""
    c = np.concatenate([np.zeros(1, dtype=values.dtype), np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of UTF-8 bytes as an Arrow string array."""
    size = ends - starts
    off = np.concatenate([[0], np.cumsum(size)])
    body = data[np.repeat(starts - off[:-1], size) + np.arange(off[-1])]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body)))


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
