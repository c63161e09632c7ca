"""Compressed bitmaps over dense ordinals, and the difference of two."""

from __future__ import annotations

import numpy as np

#: A container spans this many ordinals; with more than SPARSE of them it is kept as bits.
SPAN = 1 << 16
SPARSE = 4096


class Bitmap:
    """A set of ordinals: for each span either a sorted array of 16-bit offsets or a bit array."""

    def __init__(self, containers: dict[int, np.ndarray]):
        self.containers = containers

    @classmethod
    def of(cls, ordinals: np.ndarray) -> Bitmap:
        ordinals = np.unique(ordinals)
        high = ordinals // SPAN
        cut = np.flatnonzero(np.diff(high)) + 1
        return cls({int(part[0] // SPAN): cls._pack((part % SPAN).astype(np.uint16)) for part in np.split(ordinals, cut) if len(part)})

    @staticmethod
    def _pack(low: np.ndarray) -> np.ndarray:
        if len(low) <= SPARSE:
            return low
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        return np.packbits(bits)

    @staticmethod
    def _bits(c: np.ndarray) -> np.ndarray:
        if c.dtype == np.uint8:
            return c
        bits = np.zeros(SPAN, np.uint8)
        bits[c] = 1
        return np.packbits(bits)

    @staticmethod
    def _low(c: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(c)).astype(np.uint16) if c.dtype == np.uint8 else c

    def _with(self, other: Bitmap, keep_common: bool) -> Bitmap:
        out = {}
        for key, a in self.containers.items():
            b = other.containers.get(key)
            if b is None:
                low = np.empty(0, np.uint16) if keep_common else self._low(a)
            elif a.dtype == np.uint8:
                mask = self._bits(b)
                low = self._low(a & (mask if keep_common else ~mask))
            elif b.dtype == np.uint8:
                low = a[((b[a >> 3] >> (7 - (a & 7))) & 1).astype(bool) == keep_common]
            else:
                low = a[np.isin(a, b, assume_unique=True, invert=not keep_common)]
            if len(low):
                out[key] = self._pack(low)
        return Bitmap(out)

    def and_not(self, other: Bitmap) -> Bitmap:
        return self._with(other, keep_common=False)

    def and_(self, other: Bitmap) -> Bitmap:
        return self._with(other, keep_common=True)

    def ordinals(self) -> np.ndarray:
        parts = [self._low(c).astype(np.int64) + k * SPAN for k, c in sorted(self.containers.items())]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)

    def __len__(self) -> int:
        return sum(int(np.unpackbits(c).sum()) if c.dtype == np.uint8 else len(c) for c in self.containers.values())
