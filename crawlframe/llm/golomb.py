"""Golomb coding of sorted integers by their gaps, the parameter being a power of two.

The quotient of each gap is unary (zeros, then a one), the remainder has a
fixed number of bits; the two streams lie one after the other.
"""

from __future__ import annotations

import struct

import numpy as np

HEADER = struct.Struct("<BQQQ")


def encode(values: np.ndarray) -> bytes:
    """Code sorted unsigned 64-bit integers."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return HEADER.pack(0, 0, 0, 0)
    gaps = np.diff(values)
    mean = int(values[-1] - values[0]) // n
    bits = max(0, (mean * 69 // 100).bit_length())
    quotients = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n > 1 else 0, np.uint8)
    unary[ends] = 1
    rest = np.empty((n - 1, bits), np.uint8)
    for bit in range(bits):
        rest[:, bit] = (gaps >> np.uint64(bit)) & np.uint64(1)
    head = HEADER.pack(bits, n, int(values[0]), len(unary))
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def decode(data: bytes) -> np.ndarray:
    """The integers again."""
    bits, n, first, length = HEADER.unpack_from(data)
    if not n:
        return np.zeros(0, np.uint64)
    middle = HEADER.size + -(-length // 8)
    unary = np.unpackbits(np.frombuffer(data[HEADER.size : middle], np.uint8))[:length]
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(bits)
    rest = np.unpackbits(np.frombuffer(data[middle:], np.uint8))[: (n - 1) * bits].reshape(n - 1, bits)
    for bit in range(bits):
        gaps |= rest[:, bit].astype(np.uint64) << np.uint64(bit)
    return np.cumsum(np.concatenate([np.array([first], np.uint64), gaps]), dtype=np.uint64)
