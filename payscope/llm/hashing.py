"""Word and window hashes of whole batches of texts by numpy, without a loop over words.

A prefix sum of byte codes times powers of a base gives the polynomial hash of any stretch as a difference of
two sums, moved to a common power; a final mix spreads the bits.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20_240_101)
_CODES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RANDOM.integers(0, 1 << 61)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        found = np.full(max(n, 1 << 16), base % (1 << 64), np.uint64)
        found[0] = 1
        _POWERS[base] = np.cumprod(found, dtype=np.uint64)
    return _POWERS[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rough:
    """Hashes of short stretches of 64-bit symbols, modulo 2^64: to choose places by, never to tell stretches apart
    (long texts over two symbols can be built that share them)."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _powers(_BASE, n), out=self._sums[1:])
        self._back = _powers(_INVERSE, n + 1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of [start, end); equal stretches give equal hashes wherever they stand."""
        return mixed((self._sums[end] - self._sums[start]) * self._back[start])


_PRIME, _SHIFT = (1 << 31) - 1, np.uint64(31)
_LOW = np.uint64(_PRIME)
_BASES = [int(x) for x in _RANDOM.integers(1 << 20, _PRIME - 1, 2)]
_TABLES: dict[int, np.ndarray] = {}


def _folded(x: np.ndarray) -> np.ndarray:
    """Equal modulo 2^31 - 1, and less than 2^31 + 4."""
    for _ in range(2):
        high = x >> _SHIFT
        x = x & _LOW
        x += high
    return x


def _table(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^31 - 1."""
    found = _TABLES.get(base, np.ones(1, np.uint32))
    while len(found) < n:
        more = _folded(found[: n - len(found)].astype(np.uint64) * np.uint64(pow(base, len(found), _PRIME)))
        found = np.append(found, (more % _LOW).astype(np.uint32))
    _TABLES[base] = found
    return found[:n]


class Prefix:
    """Hashes of any stretches of a sequence of 64-bit symbols: two polynomials modulo the prime 2^31 - 1 with
    bases and symbol values of their own, so that no structure of the text, as of periodic or of Thue-Morse words,
    makes different stretches equal more often than chance."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        self._sums, self._back = [], []
        for base, shift in zip(_BASES, (0, 32)):
            values = _folded(symbols >> np.uint64(shift))
            values *= _table(base, n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_folded(values), out=sums[1:])
            self._sums.append(sums)
            self._back.append(_table(pow(base, -1, _PRIME), n + 1))

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of [start, end); equal stretches give equal hashes wherever they stand."""
        found = []
        for sums, back in zip(self._sums, self._back):
            x = _folded(_folded(sums[end] - sums[start]) * back[start])
            found.append(np.where(x >= _LOW, x - _LOW, x))
        return mixed(found[0] << _SHIFT | found[1])


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _CODES[data]


def word_hashes(texts: list[bytes], fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each text's first word and at the end the number of words).

    A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
    return. ``fold`` replaces bytes first.
    """
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    begins = np.cumsum([1, *[len(t) + 1 for t in texts]])
    gap = SPACE[data]
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    codes = byte_codes(data if fold is None else fold[data])
    return Prefix(codes).hashes(start, end), np.searchsorted(start, begins)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; fewer than n words give none."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    start = np.arange(len(words) - n + 1)
    return Prefix(words).hashes(start, start + n)
