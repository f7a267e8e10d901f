"""Words, lines and their hashes of a run of texts, on the raw UTF-8 bytes.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``; no such byte is part of another
character in UTF-8. A run's hash is a polynomial over the ring of 64-bit integers,
taken from running sums, then mixed.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 1 << 21)
        for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over the whole word; one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class TextBlock:
    """``data``: the bytes of the texts one after the other; ``offsets``: their bounds."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        self.n = len(offsets) - 1
        self.space = _SPACE[self.data]
        solid = ~self.space
        size = len(data)
        opens = np.zeros(size + 1, bool)
        opens[offsets[:-1]] = True
        opens = opens[:size]
        first = solid.copy()
        first[1:] &= self.space[:-1] | opens[1:]
        closes = np.zeros(size, bool)
        closes[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
        last = solid.copy()
        if size:
            last[:-1] &= self.space[1:] | closes[:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.word_at = np.searchsorted(self.starts, offsets)  # first word of each text, and the end
        self.doc_of_word = np.repeat(np.arange(self.n), np.diff(self.word_at))
        self._sums: np.ndarray | None = None

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each run of bytes."""
        powers, inverses = _power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers[: len(self.data)], out=self._sums[1:])
        with np.errstate(over="ignore"):
            return mix((self._sums[ends] - self._sums[starts]) * inverses[starts] + mix((ends - starts).astype(np.uint64)))

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``width`` words inside one text."""
        n = len(hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.doc_of_word[:n] == self.doc_of_word[width - 1 :])
        total = np.zeros(len(first), np.uint64)
        for k in range(width):
            total = mix(total + hashes[first + k] + np.uint64(k + 1))
        return first, total
