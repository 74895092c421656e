"""The 64-bit xxHash of many spans of an array at once, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of the published algorithm.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)

#: Longer spans are hashed one by one.
LONG = 160
#: Spans of one length that are hashed at a time.
TOGETHER = 1 << 14


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(lane: np.ndarray, octet: np.ndarray) -> np.ndarray:
    return _rotated(lane + octet * P2, 31) * P1


def _of_length(octets: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """The hashes of the spans of one length that start at `at`; `octets[i]` is the word of the bytes i to i + 7."""
    start, done = np.uint64(seed), 0
    with np.errstate(over="ignore"):
        if length >= 32:
            lanes = [np.full(len(at), v, np.uint64) for v in (start + P1 + P2, start + P2, start, start - P1)]
            for _ in range(length // 32):
                lanes = [_round(lane, octets[at + done + 8 * k]) for k, lane in enumerate(lanes)]
                done += 32
            h = sum((_rotated(lane, by) for lane, by in zip(lanes[1:], (7, 12, 18), strict=True)), _rotated(lanes[0], 1))
            for lane in lanes:
                h = (h ^ _round(np.uint64(0), lane)) * P1 + P4
        else:
            h = np.full(len(at), start + P5, np.uint64)
        h = h + np.uint64(length)
        for _ in range((length - done) // 8):
            h = _rotated(h ^ _round(np.uint64(0), octets[at + done]), 27) * P1 + P4
            done += 8
        rest = octets[at + done] if done < length else h
        if length - done >= 4:
            h = _rotated(h ^ (rest & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
            rest = rest >> np.uint64(32)
            done += 4
        for _ in range(length - done):
            h = _rotated(h ^ (rest & np.uint64(0xFF)) * P5, 11) * P1
            rest = rest >> np.uint64(8)
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


def hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 with `seed` of each buf[start:end]."""
    size = ends - starts
    out = np.empty(len(size), np.uint64)
    padded = np.concatenate([buf, np.zeros(16, np.uint8)])
    octets = np.ndarray(len(buf) + 8, np.dtype("<u8"), padded, strides=(1,))
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(padded[starts[i] : ends[i]], seed)
    order = np.argsort(np.minimum(size, LONG + 1).astype(np.uint8), kind="stable")
    edges = np.searchsorted(size[order], np.arange(LONG + 2))
    for length in np.flatnonzero(np.diff(edges)).tolist():
        for a in range(int(edges[length]), int(edges[length + 1]), TOGETHER):
            which = order[a : min(a + TOGETHER, int(edges[length + 1]))]
            out[which] = _of_length(octets, starts[which], length, seed)
    return out
