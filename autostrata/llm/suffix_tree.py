"""Suffix trees by Ukkonen's algorithm, and longest common extensions by lowest common ancestors."""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """Suffixes of a sequence of integers from 0 on; an end mark smaller than all is added.

    ``rank`` has the place of each suffix in sorted order (the end mark's own suffix, number ``n``,
    included). ``common`` answers, for arrays of suffix pairs, how long their common beginning is.
    Time is linear but for the table of range minima, which takes n log n numbers.
    """

    def __init__(self, symbols: np.ndarray):
        text = (symbols.astype(np.int64) + 1).tolist()
        text.append(0)
        self.n = len(text) - 1
        children, starts, stops = _ukkonen(text, int(symbols.max(initial=0)) + 2)
        self._tour(children, starts, stops)

    def _tour(self, children: dict[int, list[int]], starts: list[int], stops: list[int]) -> None:
        """Walk the tree in order. Of an Euler tour only the steps down are kept, each with the
        depth it starts from: a step back up repeats a depth that the next step down starts from."""
        size = self.n + 1
        above: list[int] = []
        first = [0] * size
        leaves: list[int] = []
        stack = [(child, 0) for child in children[0]]
        while stack:
            node, depth = stack.pop()
            above.append(depth)
            stop = stops[node]
            if stop < 0:  # a leaf
                suffix = starts[node] - depth
                first[suffix] = len(above) - 1
                leaves.append(suffix)
            else:
                depth += stop - starts[node]
                stack += [(child, depth) for child in children[node]]
        self.rank = np.empty(size, np.int64)
        self.rank[leaves] = np.arange(size)
        self._first = np.array(first)
        level = np.array(above, np.int32)
        self._minima = [level]
        span = 1
        while 2 * span <= len(above):
            level = np.minimum(level[:-span], level[span:])
            self._minima.append(level)
            span *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes ``a`` and ``b``, which differ: the depth
        of their lowest common ancestor, the least depth on the tour between them."""
        a, b = self._first[a], self._first[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            table = self._minima[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out


def _ukkonen(
    text: list[int], alphabet: int
) -> tuple[dict[int, list[int]], list[int], list[int]]:
    """Children of each inner node in falling order of their first symbol, and where the label of
    the edge above each node starts and stops in ``text``; a leaf's stops at -1, the end."""
    edges: dict[int, int] = {}  # node * alphabet + first symbol -> child
    starts, stops, link = [0], [0], [0]
    node = length = waiting = edge = 0
    for i, symbol in enumerate(text):
        waiting += 1
        pending = 0  # inner node made last, whose suffix link is open
        while waiting:
            if not length:
                edge = i
            key = node * alphabet + text[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(starts)
                starts.append(i)
                stops.append(-1)
                link.append(0)
                if pending:
                    link[pending] = node
                    pending = 0
            else:
                start, stop = starts[child], stops[child]
                if stop >= 0 and length >= stop - start:
                    edge += stop - start
                    length -= stop - start
                    node = child
                    continue
                middle = text[start + length]
                if middle == symbol:
                    length += 1
                    if pending:
                        link[pending] = node
                    break
                split = len(starts)
                edges[key] = split
                starts += (start, i)
                stops += (start + length, -1)
                link += (0, 0)
                starts[child] = start + length
                edges[split * alphabet + middle] = child
                edges[split * alphabet + symbol] = split + 1
                if pending:
                    link[pending] = split
                pending = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    children: dict[int, list[int]] = {}
    for key in sorted(edges, reverse=True):
        children.setdefault(key // alphabet, []).append(edges[key])
    return children, starts, stops
