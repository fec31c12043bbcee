"""Elias-Fano coding of sorted integers, with select.

Of each value the low ``width`` bits are stored as they are; the rest is a bit
string with a one at ``high + index``.  Two bits a value plus ``log2(u / n)``
are needed.  Every ``STEP``-th one's place is kept, so select looks at a few
bytes only.
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<4sBQQQ")
MAGIC, STEP = b"EFS1", 256


def pack(values: np.ndarray) -> bytes:
    """Code sorted, non-negative integers."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    low = np.zeros((n, width), np.uint8)
    for bit in range(width):
        low[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
    ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    head = HEADER.pack(MAGIC, width, n, top, len(high))
    return head + ones[::STEP].astype("<u8").tobytes() + np.packbits(low.ravel()).tobytes() + np.packbits(high).tobytes()


class EliasFano:
    """Reader of what :func:`pack` made."""

    def __init__(self, data: bytes):
        magic, self.width, self.n, self.top, bits = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an Elias-Fano block")
        at, samples = HEADER.size, -(-self.n // STEP)
        self.samples = np.frombuffer(data, "<u8", samples, at)
        at += 8 * samples
        low = -(-self.n * self.width // 8)
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, -(-bits // 8), at + low)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The ``i``-th value, from the sampled place of a one near it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // STEP]), i % STEP
        byte, skip = divmod(place, 8)
        while True:  # at most STEP ones away
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + 64])[skip:])
            if left < len(ones):
                high = byte * 8 + skip + int(ones[left]) - i
                break
            left, byte, skip = left - len(ones), byte + 64, 0
        first = i * self.width
        bits = np.unpackbits(self.low[first // 8 : -(-(first + self.width) // 8)])[first % 8 :][: self.width]
        return (high << self.width) | sum(int(bit) << k for k, bit in enumerate(bits))

    def all(self) -> np.ndarray:
        """Every value."""
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n]
        values = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.width)
        low = np.unpackbits(self.low)[: self.n * self.width].reshape(self.n, self.width)
        for bit in range(self.width):
            values |= low[:, bit].astype(np.uint64) << np.uint64(bit)
        return values.astype(np.int64)
