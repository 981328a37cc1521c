"""Suffix sorting by mergesort, suffixes compared by hashes of their common extensions.

Prefix polynomial hashes tell in one step whether two stretches of text are equal, so the longest
common extension of two suffixes is found by binary search, and a comparison takes a number of
steps logarithmic in the depth. All comparisons of one step of all merges run as numpy operations.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(161803)
_LETTER = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
BASE = int(_RANDOM.integers(1, 2**61, dtype=np.uint64)) * 8 + 3
_UNBASE = pow(BASE, -1, 2**64)


def powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base % 2**64, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


# Powers for texts of usual length; longer ones make their own.
_TABLE = 1 << 19
_POWER, _UNPOWER = powers(BASE, _TABLE), powers(_UNBASE, _TABLE)


class HashedText:
    """Bytes with prefix hashes: ``hashes(starts, sizes)`` of any stretches in constant time each."""

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        n = len(letters)
        short = n < _TABLE
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[letters] * (_POWER[:n] if short else powers(BASE, n)), out=self.sums[1:])
        self.undo = _UNPOWER[: n + 1] if short else powers(_UNBASE, n + 1)

    def hashes(self, starts: np.ndarray, sizes) -> np.ndarray:
        return (self.sums[starts + sizes] - self.sums[starts]) * self.undo[starts]

    def all_hashes(self, size: int) -> np.ndarray:
        """``hashes`` of the stretches of ``size`` letters from each place that has as many."""
        n = len(self.letters) - size + 1
        return (self.sums[size:] - self.sums[:n]) * self.undo[:n]

    def common(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Length of the common extension of suffixes at ``a`` and ``b``, at most ``depth``."""
        low = np.zeros(len(a), np.int64)
        step = 1 << (depth.bit_length() - 1)
        while step:
            tried = low + step
            fits = tried <= depth
            tried[~fits] = low[~fits]
            same = self.hashes(a, tried) == self.hashes(b, tried)
            low = np.where(fits & same, tried, low)
            step >>= 1
        return low

    def less(self, a: np.ndarray, b: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether a < b, and whether they are equal, over ``depth`` letters."""
        size = self.common(a, b, depth)
        equal = size >= depth
        at = np.where(equal, 0, size)
        return ~equal & (self.letters[a + at] < self.letters[b + at]), equal

    def equal_letters(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Whether the letters themselves are equal, which hashes only make likely."""
        rows = np.lib.stride_tricks.sliding_window_view(self.letters, depth)
        out = np.empty(len(a), bool)
        for i in range(0, len(a), 1 << 13):
            part = slice(i, i + (1 << 13))
            out[part] = (rows[a[part]] == rows[b[part]]).all(axis=1)
        return out


def sort_suffixes(
    text: HashedText, starts: np.ndarray, segments: np.ndarray, depth: int
) -> np.ndarray:
    """The order of suffixes by segment, then by their first ``depth`` letters, stable.

    ``segments`` is sorted. Runs of 1, 2, 4, ... suffixes of a segment are merged: a suffix's place
    is its own in its run plus the number of suffixes of the other run before it, found by binary
    search. Every suffix has ``depth`` letters.
    """
    n = len(starts)
    order = np.arange(n)
    first = np.flatnonzero(np.concatenate(([True], segments[1:] != segments[:-1]))[:n])
    size = np.diff(np.append(first, n))
    begin, length = np.repeat(first, size), np.repeat(size, size)
    within = np.arange(n) - begin
    width = 1
    while n and width < size.max():
        at = np.flatnonzero(length > width)
        run = within[at] // width
        left = run % 2 == 0
        # The other run of the pair, clipped to the segment.
        low = begin[at] + np.where(left, run + 1, run - 1) * width
        end = begin[at] + length[at]
        high = np.minimum(low + width, end)
        low = np.minimum(low, end)
        origin = low.copy()
        mine = starts[order[at]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            other = starts[order[middle]]
            before, equal = text.less(other, mine[open_], depth)
            # Equal suffixes of the left run stay before those of the right run.
            before |= equal & ~left[open_]
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        pair = begin[at] + run // 2 * 2 * width
        own = within[at] - run * width
        merged = order.copy()
        merged[pair + own + (low - origin)] = order[at]
        order = merged
        width *= 2
    return order
