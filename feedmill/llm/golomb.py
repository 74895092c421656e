"""Golomb-Rice coding of sorted hashes, without loops over values."""

from __future__ import annotations

import struct

import numpy as np

#: Values whose bits are laid out at a time.
BLOCK = 1 << 15


def encode(values: np.ndarray, low: int, span: int) -> bytes:
    """Sorted distinct uint64 `values` in [low, low + span) as gaps.

    A gap is split by the power of two nearest to the mean gap: quotients go to
    a unary stream, remainders to a stream of fixed width.
    """
    n = len(values)
    if n == 0:
        return struct.pack("<QBQQ", 0, 0, low, 0)
    gaps = np.diff(values, prepend=np.uint64(low))
    width = max(0, min(63, int(span // n).bit_length() - 1))
    stops = np.cumsum((gaps >> np.uint64(width)).astype(np.int64) + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, np.uint8)
    unary[stops] = 1
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint64)
    rests = [
        ((gaps[i : i + BLOCK, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel() for i in range(0, n, BLOCK)
    ]
    unary = np.packbits(unary).tobytes()
    return struct.pack("<QBQQ", n, width, low, len(unary)) + unary + np.packbits(np.concatenate(rests)).tobytes()


def decode(data: bytes) -> np.ndarray:
    head = struct.calcsize("<QBQQ")
    n, width, low, n_unary = struct.unpack("<QBQQ", data[:head])
    if n == 0:
        return np.zeros(0, np.uint64)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, n_unary, head))
    stops = np.flatnonzero(unary)[:n]
    gaps = np.diff(stops, prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = np.frombuffer(data, np.uint8, -1, head + n_unary)
    out = np.empty(n, np.uint64)
    weights = np.uint64(1) << np.arange(width - 1, -1, -1, dtype=np.uint64)
    for i in range(0, n, BLOCK):  # BLOCK is a multiple of 8, so blocks start at whole bytes
        k = min(BLOCK, n - i)
        bits = np.unpackbits(rest[i * width // 8 : -(-(i + k) * width // 8)])[: k * width]
        out[i : i + k] = (bits.reshape(k, width).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
    return np.cumsum((gaps << np.uint64(width)) + out, dtype=np.uint64) + np.uint64(low)
