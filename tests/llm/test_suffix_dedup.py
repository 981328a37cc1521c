"""Repeated passages against a scan of all strings, suffix order against plain sorting."""

import hashlib
import random

import numpy as np
import pytest

from autostrata.llm import suffix_dedup
from autostrata.llm.suffix_dedup import remove_repeats
from autostrata.llm.suffix_sort import HashedText, sort_suffixes


def _expected(rows, width=100):
    seen, out = set(), {}
    for id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            string = data[p : p + width]
            if string in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(string)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        left = bytes(c for c, g in zip(data, gone) if not g)
        out[id] = (len(data), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("together,piece", [(20_000, 1 << 22), (3, 300)])
def test_equals_a_scan_of_all_strings(spark, monkeypatch, together, piece):
    monkeypatch.setattr(suffix_dedup, "SORTED_TOGETHER", together)
    monkeypatch.setattr(suffix_dedup, "_PIECE", piece)
    random.seed(together)
    parts = ["".join(random.choice("aé ") for _ in range(random.randint(3, 60))) for _ in range(12)]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 14)))) for i in range(40)]
    rows += [(40 + i, "ab" * random.randint(40, 200)) for i in range(4)]
    rows += [(50, None), (51, ""), (52, rows[3][1]), (None, rows[5][1]), (53, "x" * 99), (54, "x" * 99)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, tie int, key string")
    got = remove_repeats(docs).collect()
    assert {
        r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got
    } == _expected(rows)


def test_repeated_rows_and_empty_table(spark):
    text = "".join(random.choice("abcdefgh") for _ in range(300))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert sorted(r.n_removed for r in remove_repeats(docs).collect()) == [0, 300]
    assert remove_repeats(docs.limit(0)).count() == 0


def test_suffix_order():
    random_ = np.random.default_rng(5)
    for _ in range(30):
        letters = random_.integers(97, 99, random_.integers(30, 300)).astype(np.uint8)
        depth = int(random_.integers(1, 25))
        starts = random_.integers(0, len(letters) - depth + 1, 60)
        segments = np.sort(random_.integers(0, 4, 60))
        order = sort_suffixes(HashedText(letters), starts, segments, depth).tolist()
        data = letters.tobytes()
        assert order == sorted(range(60), key=lambda i: (segments[i], data[starts[i] : starts[i] + depth], i))


def test_common_extension():
    text = HashedText(np.frombuffer(b"banana bandana", np.uint8))
    a, b = np.array([0, 1, 0]), np.array([7, 3, 0])
    assert text.common(a, b, 5).tolist() == [3, 3, 5]


def test_leftmost_minimum_goes_by_the_first_bits():
    near = np.array([5 << 24 | 9, 5 << 24 | 1, 7 << 24], np.uint64)
    assert suffix_dedup._leftmost_minimum(near, 2).tolist() == [0, 1]
    hashes = np.random.default_rng(3).integers(0, 40, 500, np.uint64) << np.uint64(58)
    want = [i + int(np.argmin(hashes[i : i + 61])) for i in range(440)]
    assert suffix_dedup._leftmost_minimum(hashes, 61).tolist() == want


def test_anchors_of_neighbouring_texts():
    random_ = np.random.default_rng(4)
    texts = [random_.integers(97, 99, n).astype(np.uint8).tobytes() for n in (0, 99, 250, 0, 100, 0, 300, 40)]
    texts[6] = b"x" * 300
    found = suffix_dedup._Anchors(texts, 100)
    strings = []
    for at, low, high, text in zip(found.at, found.low, found.high, found.text):
        assert found.begin[text] <= low <= high <= at <= low + 60
        strings += [(text, p - found.begin[text]) for p in range(low, high + 1)]
    assert strings == [(t, p) for t, x in enumerate(texts) for p in range(len(x) - 99)]
