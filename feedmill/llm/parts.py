"""Parts of texts that come again and again are encoded once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from feedmill.llm.flat import ranges, spans_hashed


class Remembered:
    """The ids of the parts that a worker has met, by two independent 64-bit hashes of their bytes.

    `most` parts are kept between batches. Where the hashes contradict each other
    (two parts share one but not both) nothing is looked up and every part of the
    batch is encoded by itself.
    """

    def __init__(self, most: int):
        self._most = most
        self._forget()

    def _forget(self) -> None:
        self._hash, self._check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self._at, self._size, self._flat = (np.zeros(0, np.int64) for _ in range(3))

    def ids(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, encode: Callable) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the spans of `buf`, one after the other, and how many each span has.

        `encode(starts, ends)` gives the same for spans that are met for the first time.
        """
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes, check = spans_hashed(buf, starts, ends, twice=True)
        hashes, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        agree = bool((check[first][back] == check).all())
        check = check[first]
        at = np.minimum(np.searchsorted(self._hash, hashes), max(0, len(self._hash) - 1))
        new = self._hash[at] != hashes if len(self._hash) else np.ones(len(hashes), bool)
        if len(self._hash):
            agree &= bool((self._check[at[~new]] == check[~new]).all())
        if not agree:
            return encode(starts, ends)
        if len(self._hash) > self._most:  # what these texts use stays, the rest is forgotten
            kept = at[~new]
            flat = self._flat[ranges(self._at[kept], self._size[kept])]
            self._hash, self._check, self._size, self._flat = self._hash[kept], self._check[kept], self._size[kept], flat
            self._at = np.cumsum(self._size) - self._size
        if new.any():
            ids, sizes = encode(starts[first[new]], ends[first[new]])
            known = np.concatenate([self._hash, hashes[new]])
            order = np.argsort(known, kind="stable")  # two sorted runs: they are merged
            self._hash = known[order]
            self._check = np.concatenate([self._check, check[new]])[order]
            self._at = np.concatenate([self._at, len(self._flat) + np.cumsum(sizes) - sizes])[order]
            self._size = np.concatenate([self._size, sizes])[order]
            self._flat = np.concatenate([self._flat, ids])
        at = np.searchsorted(self._hash, hashes)[back]
        size = self._size[at]
        return self._flat[ranges(self._at[at], size)], size
