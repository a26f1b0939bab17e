"""Elias-Fano code of a sequence of whole numbers that never fall, with a select structure."""

from __future__ import annotations

import struct

import numpy as np

#: Every so many numbers the place of the upper bit is stored.
STEP = 256


def encode(values: np.ndarray) -> bytes:
    """About 2 + log2(largest / count) bits a number. Values: unsigned 64-bit, ascending, repeats allowed."""
    values = np.asarray(values, np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
    shift = np.uint64(low_bits)
    high = (values >> shift).astype(np.int64) + np.arange(n)
    upper = np.zeros((int(high[-1]) + 8) // 8 if n else 0, np.uint8)
    np.bitwise_or.at(upper, high >> 3, (1 << (high & 7)).astype(np.uint8))
    places = np.arange(low_bits, dtype=np.uint64)
    lower = np.packbits(((values[:, None] >> places) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    samples = high[::STEP].astype("<u8")
    return struct.pack("<QQQ", n, low_bits, len(upper)) + samples.tobytes() + upper.tobytes() + lower.tobytes()


class Select:
    """Random access to the numbers of a code."""

    def __init__(self, code: bytes):
        self.n, self.low_bits, size = struct.unpack_from("<QQQ", code)
        at, count = 24, -(-self.n // STEP)
        self.samples = np.frombuffer(code, "<u8", count, at)
        self.upper = np.frombuffer(code, np.uint8, size, at := at + 8 * count)
        self.lower = np.frombuffer(code, np.uint8, offset=at + size)

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.uint64)
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            out |= ((self.lower[bit >> 3] >> (bit & 7)) & 1).astype(np.uint64) << np.uint64(k)
        return out

    def __getitem__(self, i: int) -> int:
        """The number at place ``i``: from the stored place before it, a short run of upper bits is counted."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // STEP]), i % STEP
        byte = place >> 3
        bits = int(self.upper[byte]) & (0xFF << (place & 7)) & 0xFF
        while left >= (ones := bits.bit_count()):
            left, byte = left - ones, byte + 1
            bits = int(self.upper[byte])
        for _ in range(left):
            bits &= bits - 1
        high = 8 * byte + (bits & -bits).bit_length() - 1 - i
        return (high << self.low_bits) | int(self._low(np.array([i], np.int64))[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        index = np.arange(self.n, dtype=np.int64)
        return ((ones - index).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(index)
