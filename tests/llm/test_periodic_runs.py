"""Periodic runs against a plain scan, and the suffix tree against sorted suffixes."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from autostrata.llm.periodic_runs import find_runs, periodic_runs
from autostrata.llm.suffix_tree import SuffixTree


def _scan(words):
    """All runs of exponent 4 and six words, by comparing the words with themselves, shifted."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            shorter = any(part[p:] == part[:-p] for p in range(1, q))
            if length >= max(6, 4 * q) and not shorter:
                found.append((start, length, q))
            i += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repetitive(rng):
    letters = rng.choice([1, 2, 2, 3, 5])
    words = []
    for _ in range(rng.randint(0, 4)):
        words += [rng.randrange(letters) for _ in range(rng.randint(0, 8))]
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 7))]
        words += (root * rng.randint(1, 9))[: rng.randint(1, 50)]
    return words


def test_runs_equal_a_scan():
    rng, found = random.Random(5), 0
    for _ in range(3000):
        words = _repetitive(rng)
        runs = [tuple(run) for run in find_runs(words).tolist()]
        assert runs == _scan(words)
        found += len(runs)
    assert found > 2000


def test_long_sequences():
    rng = random.Random(6)
    root = [rng.randrange(3000) for _ in range(2000)]
    assert find_runs(root * 8).tolist() == [[0, 16000, 2000]]
    assert find_runs(["a"] * 30_000).tolist() == [[0, 30_000, 1]]
    assert find_runs(root * 3).tolist() == []


def test_tree_ranks_and_common_beginnings():
    rng = random.Random(7)
    for _ in range(200):
        text = [rng.randrange(3) for _ in range(rng.randint(1, 40))]
        tree = SuffixTree(np.array(text))
        n = len(text)
        order = sorted(range(n + 1), key=lambda i: text[i:])
        assert [int(tree.rank[i]) for i in order] == list(range(n + 1))
        a, b = map(np.array, zip(*((i, j) for i in range(n + 1) for j in range(n + 1) if i != j)))
        for i, j, got in zip(a, b, tree.common(a, b)):
            want = 0
            while max(i, j) + want < n and text[i + want] == text[j + want]:
                want += 1
            assert got == want


def test_collapsed_text_drops_what_follows_the_first_period(spark):
    loop = "go on " * 5
    docs = spark.createDataFrame(
        [(1, "start " + loop + "end"), (2, "x " * 5), (3, "\t x  y\n"), (1, None), (None, "")],
        "doc_id long, text string",
    ).withColumn("runs", F.lit("old")).withColumn("_runs", F.lit(0))
    rows = periodic_runs(docs).orderBy("doc_id", "n_words").collect()
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows]
    assert got == [
        (None, 0, [], ""),
        (1, 0, [], ""),
        (1, 12, [(1, 10, 2)], "start go on end"),
        (2, 5, [], "x x x x x"),
        (3, 2, [], " x  y"),
    ]
    assert all(r.collapsed_sha256 == hashlib.sha256(r.collapsed.encode()).hexdigest() for r in rows)


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(4, "a b " * 9)] * 3, "doc_id long, text string")
    assert periodic_runs(docs.limit(0)).count() == 0
    rows = periodic_runs(docs, keep_text=False).collect()
    assert [(r.doc_id, [tuple(x) for x in r.runs]) for r in rows] == [(4, [(0, 18, 2)])] * 3


@pytest.mark.parametrize("blank", [" ", "\x1c", "\u0085"])
def test_other_blanks_are_letters(spark, blank):
    docs = spark.createDataFrame([(1, f"a{blank}b " * 6)], "doc_id long, text string")
    assert periodic_runs(docs).first().n_words == 6
