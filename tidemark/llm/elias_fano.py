"""Elias-Fano lists: non-decreasing whole numbers in near-minimal space, read by position without unpacking.

Of ``n`` numbers up to ``u`` the lowest ``l = log2(u / n)`` bits are packed side by side; the
rest are written in unary: number ``i`` with high part ``h`` sets bit ``h + i``. That is
``2 + l`` bits a number. Reading number ``i`` needs the place of the ``i``-th set bit, found
from the number of set bits before each block of 512 (a select structure of 1/16 of the size).
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQB7x")
_BLOCK = 64  # bytes


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """The lowest ``width`` bits of each number, side by side, lowest bit first."""
    if not width or not len(values):
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def encode(values: np.ndarray) -> bytes:
    """The list as bytes: head, low bits, high bits, select counts."""
    values = np.ascontiguousarray(values, np.uint64)
    n, most = len(values), int(values[-1]) if len(values) else 0
    if n and (values[1:] < values[:-1]).any():
        raise ValueError("Elias-Fano lists do not decrease")
    width = max(0, (most // n).bit_length() - 1) if n else 0
    high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    length = -(-(int(high[-1]) + 1 if n else 0) // (8 * _BLOCK)) * _BLOCK
    marks = np.zeros(length, np.uint8)
    np.bitwise_or.at(marks, high >> 3, (1 << (high & 7)).astype(np.uint8))
    before = np.append(0, np.cumsum(np.bitwise_count(marks).reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64)))[:-1]
    return _HEAD.pack(n, length, width) + pack_bits(values, width) + marks.tobytes() + before.astype("<u4").tobytes()


class EliasFano:
    """Reads an encoded list; ``len``, indexing, slices' ends through :meth:`get`, and all values through :meth:`values`."""

    def __init__(self, data: bytes):
        self._n, length, self._width = _HEAD.unpack_from(data)
        low = -(-self._n * self._width // 8)
        self._low = np.frombuffer(data, np.uint8, low, _HEAD.size)
        self._high = np.frombuffer(data, np.uint8, length, _HEAD.size + low)
        self._before = np.frombuffer(data, "<u4", length // _BLOCK, _HEAD.size + low + length)

    def __len__(self) -> int:
        return self._n

    def select(self, i: int) -> int:
        """The place of the ``i``-th set bit of the high part, counting from 0."""
        block = int(np.searchsorted(self._before, i, "right")) - 1
        bits = np.unpackbits(self._high[block * _BLOCK : (block + 1) * _BLOCK], bitorder="little")
        return block * _BLOCK * 8 + int(np.flatnonzero(bits)[i - int(self._before[block])])

    def get(self, i: int) -> int:
        if not 0 <= i < self._n:
            raise IndexError(i)
        low, start = 0, i * self._width
        if self._width:
            first, last = start >> 3, (start + self._width + 7) >> 3
            low = (int.from_bytes(self._low[first:last].tobytes(), "little") >> (start & 7)) & ((1 << self._width) - 1)
        return ((self.select(i) - i) << self._width) | low

    __getitem__ = get

    def values(self) -> np.ndarray:
        """All numbers at once."""
        if not self._n:
            return np.empty(0, np.uint64)
        places = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))
        out = (places - np.arange(self._n)).astype(np.uint64) << np.uint64(self._width)
        if self._width:
            bits = np.unpackbits(self._low, bitorder="little", count=self._n * self._width).reshape(self._n, self._width)
            out |= (bits.astype(np.uint64) << np.arange(self._width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out
