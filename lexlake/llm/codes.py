"""Texts of an Arrow batch as one array of code points.

Everything here works on whole batches: ``codes`` holds the code points of all rows one after
the other, ``starts`` (one longer than the rows) says where each row begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: One more than the last code point; all tables are this long.
TABLE = 0x110000
#: Where code points may map to anything but themselves. The rest are ideographs of the later
#: extensions, private use and unassigned: no case, no decomposition, no punctuation.
MAPPED = (range(0x20000), range(0x2F800, 0x2FA20), range(0xE0000, 0xE1000))
CHUNK_CHARS = 2_000_000


def flatten(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts) of a string column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if not n:
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    count = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=count[1:])
    text = raw.tobytes().decode("utf-8", "surrogatepass")
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), count[at - at[0]]


def strings(codes: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The column of (codes, starts)."""
    data = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    at = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    return pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(at[starts].tobytes()), pa.py_buffer(data)).cast(pa.string())


def chunks(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about CHUNK_CHARS bytes of text, so that memory stays bounded."""
    size = np.zeros(batch.num_rows, np.int64)
    for name in columns:
        size += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    begin = 0
    while begin < batch.num_rows:
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + CHUNK_CHARS, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


class CodeMap:
    """A mapping of each code point to none, one or several others, as lookup tables."""

    def __init__(self, f: Callable[[int], str]):
        self.size = np.ones(TABLE, np.uint8)
        self.first = np.arange(TABLE, dtype=np.uint32)
        self.offset = np.zeros(TABLE, np.int32)
        pool: list[int] = [0]
        for c in chain.from_iterable(MAPPED):
            out = f(c) if not 0xD800 <= c < 0xE000 else ""
            self.size[c] = len(out)
            self.first[c] = ord(out[0]) if out else 0
            if len(out) > 1:
                self.offset[c] = len(pool)
                pool.extend(map(ord, out))
        self.many = self.size > 1
        self.pool = np.array(pool, np.uint32)

    def apply(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[codes].astype(np.int64)
        ends = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        first = self.first[codes]
        long = np.flatnonzero(size > 1)
        if not len(long):
            return (first if ends[-1] == len(codes) else first[size > 0]), ends[starts]
        out = np.zeros(ends[-1], np.uint32)
        one = size == 1
        out[ends[:-1][one]] = first[one]
        n = size[long]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(ends[long], n) + step] = self.pool[np.repeat(self.offset[codes[long]].astype(np.int64), n) + step]
        return out, ends[starts]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mixer of 64-bit integers (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        p = np.full(1 << bits, np.uint64(base))
        p[0] = 1
        return np.cumprod(p)


def powers(seed: int, bits: int) -> np.ndarray:
    """The powers of a base up to 2 ** bits."""
    return _powers(BASES[seed % 2], bits)


BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def segment_hash(values: np.ndarray, starts: np.ndarray, seed: int = 0) -> np.ndarray:
    """For each segment the polynomial hash modulo 2^64 of its (mixed) values, with its length."""
    size = np.diff(starts)
    longest = int(size.max()) if len(size) else 0
    power = _powers(BASES[seed % 2], max(4, longest.bit_length()))
    with np.errstate(over="ignore"):
        at = np.arange(len(values), dtype=np.int64) - np.repeat(starts[:-1] - 0, size)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values, seed) * power[at], out=total[1:])
        return mix((total[starts[1:]] - total[starts[:-1]]) ^ mix(size.astype(np.uint64), seed + 11), seed)
