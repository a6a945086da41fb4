"""Bidirectional FM-index over integer symbols, for patterns up to a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class _Side:
    """Burrows-Wheeler transform of a circular sequence whose rotations are sorted by their first ``width`` symbols.

    That order is enough to extend a pattern of up to ``width`` symbols by one to the left: rows that begin with
    the same ``width`` symbols may stand in any order.
    """

    def __init__(self, symbols: np.ndarray, size: int, width: int):
        rank = symbols
        for j in range(1, width):
            key = rank * size + np.roll(symbols, -j)
            rank = np.unique(key, return_inverse=True)[1] if j + 1 < width else key
        self.bwt = symbols[np.argsort(rank) - 1]
        self.n = len(symbols)
        #: place of every symbol in the transform, by symbol and then by row; counts before a row by binary search
        self.places = np.sort(self.bwt * self.n + np.arange(self.n))

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row from which ``symbol`` + pattern begins, for patterns that begin at ``row``."""
        return np.searchsorted(self.places, symbol * self.n + row)


class BiIndex:
    """Index of a sequence of symbols 0 to ``size`` - 1, where 0 separates: no pattern holds it.

    A pattern is an interval of ``size`` rows from ``lo`` on among the sorted rotations, and one of the same size
    from ``rlo`` on among those of the reversed sequence. Extending it on one side moves the interval of that
    side by the transform and narrows the other by the number of smaller neighbours.
    """

    def __init__(self, symbols: np.ndarray, size: int, depth: int):
        symbols = np.concatenate(([0], symbols, [0])).astype(np.int64)
        self.size = size
        width = max(1, depth - 1)
        self.left, self.right = _Side(symbols, size, width), _Side(symbols[::-1].copy(), size, width)
        counts = np.bincount(symbols, minlength=size)
        self.starts, self.counts = np.cumsum(counts) - counts, counts

    def singles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``symbol``, ``lo``, ``rlo`` and ``count`` of every symbol that occurs."""
        found = np.flatnonzero(self.counts[1:]) + 1
        return found, self.starts[found], self.starts[found], self.counts[found]

    def extend(self, lo: np.ndarray, rlo: np.ndarray, count: np.ndarray, to_left: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions by one symbol: number of the pattern, symbol, ``lo``, ``rlo``, ``count``."""
        side, own, other = (self.left, lo, rlo) if to_left else (self.right, rlo, lo)
        pattern = np.repeat(np.arange(len(count)), count)
        rows = np.arange(len(pattern)) + np.repeat(own - (np.cumsum(count) - count), count)
        key, times = np.unique(pattern * self.size + side.bwt[rows], return_counts=True)
        pattern, symbol = key // self.size, key % self.size
        before = np.cumsum(times) - times
        first = np.searchsorted(pattern, pattern)  # the pattern's first extension
        narrowed = other[pattern] + before - before[first]
        keep = symbol > 0
        pattern, symbol, narrowed, times = pattern[keep], symbol[keep], narrowed[keep], times[keep]
        moved = side.step(symbol, own[pattern])
        return (pattern, symbol, moved, narrowed, times) if to_left else (pattern, symbol, narrowed, moved, times)

    def grams(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Patterns of 1 to ``depth`` symbols (one row each) with their counts, by length; right and left ends grow in turn."""
        symbol, lo, rlo, count = self.singles()
        words = symbol[:, None]
        yield words, count
        for length in range(2, depth + 1):
            to_left = length % 2 == 1
            pattern, symbol, lo, rlo, count = self.extend(lo, rlo, count, to_left)
            words = np.hstack([symbol[:, None], words[pattern]] if to_left else [words[pattern], symbol[:, None]])
            yield words, count
