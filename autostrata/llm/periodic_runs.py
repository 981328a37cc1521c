"""Runs of words that repeat with a period, found by suffix trees and Lyndon roots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autostrata.llm.common import whole
from autostrata.llm.suffix_tree import SuffixTree

LEAST_LENGTH = 6
LEAST_EXPONENT = 4

RESULT = (
    "runs array<struct<start: bigint, length: bigint, period: bigint>>, "
    "n_words bigint, collapsed string, collapsed_sha256 string"
)


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """Each row with its ``runs``, ``n_words`` and ``collapsed_sha256``; ``collapsed`` on request.

    Words are what stands between the six ASCII blanks, numbered from 0. A run is a stretch of at
    least ``LEAST_LENGTH`` words and ``LEAST_EXPONENT`` times its smallest period that no
    neighbouring word extends; runs are listed by start, then period. ``collapsed`` has the text's
    words with one space between them, but for those that some run holds after its first period.

    Each text is handled by itself, with no shuffle, in memory that grows with the longest text.
    NULL and empty texts have no words and no runs; rows may repeat. Columns of ``docs`` that are
    named like results are replaced.
    """
    chosen = [F.col("_runs.n_words"), F.col("_runs.runs")]
    if keep_text:
        chosen.append(F.col("_runs.collapsed"))
    chosen.append(F.col("_runs.collapsed_sha256"))
    names = {"n_words", "runs", "collapsed", "collapsed_sha256", "_runs"}
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    found = _runs_of(keep_text)(whole(text)).alias("_runs")
    return docs.select(*others, found).select(*others, *chosen)


def _runs_of(keep_text: bool):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([_result(value, keep_text) for value in texts], columns=[
                "runs", "n_words", "collapsed", "collapsed_sha256"
            ])

    return F.pandas_udf(run, RESULT)


def _result(text: str, keep_text: bool) -> tuple:
    words = text.encode().split()
    runs = find_runs(words)
    if len(runs):
        dropped = np.zeros(len(words) + 1, np.int64)
        np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
        np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(dropped)[:-1] == 0)
        collapsed = b" ".join([words[i] for i in kept.tolist()])
    else:
        collapsed = b" ".join(words)
    listed = [{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()]
    shown = collapsed.decode() if keep_text else None
    return listed, len(words), shown, hashlib.sha256(collapsed).hexdigest()


def find_runs(words: list) -> np.ndarray:
    """Start, length and period of each run of a sequence, one per row, by start and period."""
    none = np.empty((0, 3), np.int64)
    if len(words) < LEAST_LENGTH:
        return none
    number: dict = {}
    symbols = np.array([number.setdefault(w, len(number)) for w in words])
    places = _promising(symbols, len(number))
    if not len(places):
        return none
    # What no run can hold shrinks to one symbol that occurs nowhere else.
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    reduced = np.insert(symbols[places], cuts, len(number) + np.arange(len(cuts)))
    origin = np.insert(places, cuts, -1)
    runs = _runs(np.unique(reduced, return_inverse=True)[1])
    runs[:, 0] = origin[runs[:, 0]]
    return runs


def _promising(symbols: np.ndarray, count: int) -> np.ndarray:
    """The places that may lie in a run, in order.

    In a run of exponent 4 or more and six words or more, each three words in a row occur at least
    three times within the run, so a run lies inside a stretch of such threes. Stretches are cut
    until their own threes occur three times in each of them.
    """
    starts = np.arange(len(symbols) - 2)
    pairs = np.unique(symbols[:-1] * count + symbols[1:], return_inverse=True)[1]
    threes = np.unique(pairs[:-1] * count + symbols[2:], return_inverse=True)[1]
    stretch = np.zeros(len(starts), np.int64)
    while len(starts):
        own = stretch * (int(threes.max()) + 1) + threes
        _, inverse, counts = np.unique(own, return_inverse=True, return_counts=True)
        often = counts[inverse] >= LEAST_EXPONENT - 1
        kept = starts[often]
        begins = np.concatenate(([True], np.diff(kept) > 1))[: len(kept)]
        stretch = np.cumsum(begins) - 1
        long_enough = np.bincount(stretch, minlength=1)[stretch] + 2 >= LEAST_LENGTH
        done = often.all() and long_enough.all()
        starts, threes, stretch = kept[long_enough], threes[often][long_enough], stretch[long_enough]
        if done:
            break
    inside = np.zeros(len(symbols), bool)
    for shift in range(3):
        inside[starts + shift] = True
    return np.flatnonzero(inside)


def _runs(symbols: np.ndarray) -> np.ndarray:
    """Runs of a sequence of small integers.

    A run has a Lyndon root (in the symbols' order or in its inverse) that is the longest Lyndon
    word from where it starts, and that one ends where the next smaller suffix begins. So there are
    two candidates for each place; each is extended to both sides by the trees of the sequence and
    of its reversal.
    """
    n = len(symbols)
    forward = SuffixTree(symbols)
    starts = np.arange(n)
    ends = [_next_smaller(forward.rank)[:n], _next_smaller(-forward.rank)[:n]]
    left = np.concatenate([starts[e < n] for e in ends])
    right = np.concatenate([e[e < n] for e in ends])
    period = right - left
    after = forward.common(left, right)
    # A run has such a root that starts at most one period behind the run's own start.
    wanted = np.maximum(LEAST_LENGTH, LEAST_EXPONENT * period)
    hopeful = 2 * period + after >= wanted
    left, right, period, after, wanted = (
        v[hopeful] for v in (left, right, period, after, wanted)
    )
    if not len(left):
        return np.empty((0, 3), np.int64)
    before = SuffixTree(symbols[::-1]).common(n - left, n - right)
    length = before + period + after
    enough = length >= wanted
    runs = np.stack([left - before, length, period], axis=1)[enough]
    return np.unique(runs[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def _next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value; the length where there is none."""
    values = values.tolist()
    out = [len(values)] * len(values)
    open_: list[int] = []
    for i, value in enumerate(values):
        while open_ and values[open_[-1]] > value:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out)
