"""Words of many texts as flat numpy arrays: positions and 64-bit hashes without a loop over words."""

from __future__ import annotations

import numpy as np
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)
#: Longer spans are hashed one by one.
LONG = 64
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: ASCII white space: space and the codes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def spans_hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, twice: bool = False):
    """A 64-bit hash of each buf[start:end], equal for equal bytes wherever they lie.

    Eight bytes a round, all spans at once; every round mixes what came before,
    so no arrangement of letters cancels out as it may in a sum of powers.
    With `twice`, a second hash that is independent of the first.
    """
    size = np.asarray(ends - starts)
    length = size.astype(np.uint64)
    out = mixed(length + np.uint64(0x165667B19E3779F9))
    check = length * np.uint64(0x9E3779B97F4A7C15) if twice else None
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    octets = np.ndarray(len(buf) + 1, np.dtype("<u8"), padded, strides=(1,))
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(padded[starts[i] : ends[i]], 1)
        if twice:
            check[i] = xxhash.xxh3_64_intdigest(padded[starts[i] : ends[i]], 2)
    short = (size > 0) & (size <= LONG)
    open_ = None if short.all() else np.flatnonzero(short)
    at, left = (starts, size) if open_ is None else (starts[open_], size[open_])
    while len(at):
        octet = octets[at] & _LOW[np.minimum(left, 8)]
        own = slice(None) if open_ is None else open_
        out[own] = mixed(out[own] ^ octet)
        if twice:
            h = (check[own] + octet) * np.uint64(0xC2B2AE3D27D4EB4F)
            check[own] = (h ^ (h >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
        more = np.flatnonzero(left > 8)
        open_, at, left = more if open_ is None else open_[more], at[more] + 8, left[more] - 8
    return (out, check) if twice else out


def rolling(buf: np.ndarray, width: int) -> np.ndarray:
    """A cheap hash of each buf[i:i + width], to choose candidates by; texts can be made whose hashes collide."""
    global _powers, _inverse
    if len(_powers) <= len(buf):
        n = max(len(buf) + 1, 1 << 16)
        up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _powers, _inverse = np.cumprod(up), np.cumprod(down)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_TABLE[buf] * _powers[: len(buf)], out=sums[1:])
    n = max(0, len(buf) - width + 1)
    return mixed((sums[width:] - sums[:n]) * _inverse[:n])


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a line feed after each as one array, and where each starts, plus the end."""
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    return buf, np.cumsum([0, *[len(t) + 1 for t in texts]])


def words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of anything but ASCII white space."""
    inside = np.concatenate([[False], ~SPACE[buf], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
