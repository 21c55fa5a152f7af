"""Elias-Fano code of a non-decreasing sequence, with a select structure.

Each value is split: its low bits are packed side by side, and its high part is coded in unary in
one bit vector, so that a value takes about two bits more than its low bits. Every 256th set bit
has its place kept in 32 bits; ``select`` counts on from there.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

STEP = 256
HEAD = struct.Struct("<QQBQ")


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, lowest bit first."""
    if not width or not len(values):
        return b""
    bits = np.empty((len(values), width), dtype=np.uint8)
    for b in range(width):
        bits[:, b] = (values >> np.uint64(b)) & np.uint64(1)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def _unpack(data: bytes, width: int, first: int, last: int) -> np.ndarray:
    """The packed values from ``first`` up to ``last``, without it."""
    if not width or first >= last:
        return np.zeros(max(0, last - first), dtype=np.uint64)
    low, high = first * width, last * width
    raw = np.frombuffer(data[low // 8 : (high + 7) // 8], dtype=np.uint8)
    bits = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + high - low].reshape(-1, width)
    out = np.zeros(last - first, dtype=np.uint64)
    for b in range(width):
        out |= bits[:, b].astype(np.uint64) << np.uint64(b)
    return out


@dataclass(frozen=True)
class EliasFano:
    size: int
    base: int
    width: int
    low: bytes
    high: bytes
    samples: np.ndarray

    @staticmethod
    def of(values: np.ndarray) -> "EliasFano":
        """The code of non-decreasing 64-bit integers, of which the first may be negative."""
        n = len(values)
        if not n:
            return EliasFano(0, 0, 0, b"", b"", np.zeros(0, "<u4"))
        base = int(values[0])
        # Differences of signed values wrap into the unsigned range they belong to.
        above = values.astype(np.int64).view(np.uint64) - np.uint64(base % (1 << 64))
        width = max(0, (int(above[-1]) // n).bit_length() - 1)
        ones = (above >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        bits[ones.astype(np.int64)] = 1
        return EliasFano(
            n, base, width, _pack(above, width), np.packbits(bits, bitorder="little").tobytes(),
            ones[::STEP].astype("<u4"),
        )

    def _value(self, ones: np.ndarray, first: int) -> np.ndarray:
        at = np.arange(first, first + len(ones), dtype=np.uint64)
        high = (ones.astype(np.uint64) - at) << np.uint64(self.width)
        low = _unpack(self.low, self.width, first, first + len(ones))
        return ((high | low) + np.uint64(self.base % (1 << 64))).view(np.int64)

    def select(self, i: int) -> int:
        """Value ``i`` of the sequence, from the nearest kept place on."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        place = int(self.samples[i // STEP])
        left, at = i % STEP, place // 8
        # Bits of the first byte before the kept place do not count.
        left += (self.high[at] & ((1 << place % 8) - 1)).bit_count()
        while (held := self.high[at].bit_count()) <= left:
            left -= held
            at += 1
        one = np.flatnonzero(np.unpackbits(np.uint8([self.high[at]]), bitorder="little"))[left]
        return int(self._value(np.array([at * 8 + one]), i)[0])

    def values(self) -> np.ndarray:
        """The whole sequence."""
        bits = np.unpackbits(np.frombuffer(self.high, dtype=np.uint8), bitorder="little")
        return self._value(np.flatnonzero(bits), 0) if self.size else np.zeros(0, np.int64)

    def to_bytes(self) -> bytes:
        head = HEAD.pack(self.size, self.base % (1 << 64), self.width, len(self.high))
        return head + self.low + self.high + self.samples.tobytes()

    @staticmethod
    def read(data: bytes, at: int = 0) -> tuple["EliasFano", int]:
        """The code that starts at byte ``at``, and where it ends."""
        n, base, width, length = HEAD.unpack_from(data, at)
        at += HEAD.size
        low, at = data[at : at + (n * width + 7) // 8], at + (n * width + 7) // 8
        high, at = data[at : at + length], at + length
        held = -(-n // STEP)
        samples = np.frombuffer(data, "<u4", held, at)
        base -= (1 << 64) if base >= 1 << 63 else 0
        return EliasFano(n, base, width, low, high, samples), at + 4 * held
