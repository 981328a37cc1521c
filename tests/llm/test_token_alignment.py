"""Token alignment against a plain walk over both tokenizers' tokens, and its search by itself."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from autostrata.llm import token_alignment
from autostrata.llm.token_alignment import (
    BYTE_BPE,
    PIECE_BPE,
    _byte_letters,
    align,
    common_ends,
    gallop,
    link_statistics,
    overlaps,
)

TEXTS = [
    "Plain words, twice: plain words.",
    "Über größere Straßen – 東京 ☃ \U0001f600!",
    "  two  spaces\n\nand\ttabs  ",
    "<|endoftext|> and <s> </s> <unk> as text",
    "with ▁ the piece letter",  # the piece tokenizer gives a space back
    "nul \x00 byte and  ",
    "",
    None,
    " ",
    "x" * 3000,
    "line one\r\nline two " * 300,
    "Plain words, twice: plain words.",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 8 else None, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _walk():
    """Ids, groups and links of every text, token by token."""
    a_model, b_model = Tokenizer.from_file(BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    a_model.encode_special_tokens = True
    letters, out = _byte_letters(), []
    for text in TEXTS:
        a = a_model.encode(f" {text or ''}", add_special_tokens=False).ids
        b = b_model.encode(text or "")
        a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i)
            else b_model.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        raw = f" {text or ''}".encode()
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            out.append(([], [], [], []))
            continue
        ends = {end: i for i, end in enumerate(np.cumsum([len(t) for t in a_bytes]).tolist())}
        groups, links, from_a, from_b, end = [], [], 0, 0, 0
        for j, token in enumerate(b_bytes):
            end += len(token)
            if end in ends:
                i = ends[end]
                links.append((a[i], b[j]))
                groups.append(f"{','.join(map(str, a[from_a:i + 1]))}|{','.join(map(str, b[from_b:j + 1]))}")
                from_a, from_b = i + 1, j + 1
        out.append((a, b, groups, links))
    return out


@pytest.mark.parametrize("frequent", [token_alignment.FREQUENT, 1, 40])
def test_equals_a_walk_over_the_tokens(docs, monkeypatch, frequent):
    monkeypatch.setattr(token_alignment, "FREQUENT", frequent)
    walked = _walk()
    assert [bool(w[0]) for w in walked].count(False) == 3
    counts = Counter(link for *_, links in walked for link in links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    want = sorted(
        (
            -1 if i == 8 else i, len(a), len(b), len(groups), len(links),
            sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, (a, b, groups, links) in enumerate(walked)
    )
    got = link_statistics(docs).select(
        F.coalesce("doc_id", F.lit(-1)), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256",
    )
    assert sorted(map(tuple, got.collect())) == want


def test_groups_and_slices(docs, monkeypatch):
    want = {(i if i != 8 else None, ";".join(w[2])) for i, w in enumerate(_walk())}
    for size in (token_alignment.SLICE, 50):
        monkeypatch.setattr(token_alignment, "SLICE", size)
        assert {(r.doc_id, r.groups) for r in align(docs).collect()} == want


def test_byte_tokenizer_equals_the_files_own_library():
    own = Tokenizer.from_file(BYTE_BPE)
    own.encode_special_tokens = True
    letters = [chr(c) for c in range(0, 0x110000, 5) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}{c} 1{c}2\n{c}'s  {c}" for c in letters] + ["x" * 50_000, " " * 50_000]
    expected = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    assert token_alignment.byte_tokenizer(BYTE_BPE)[0](texts) == expected


def test_search_equals_binary_search():
    rng = np.random.default_rng(4)
    for _ in range(300):
        values = np.unique(rng.integers(0, 1000, rng.integers(0, 200)))
        keys = np.unique(rng.integers(-5, 1005, rng.integers(0, 200)))
        assert gallop(keys, values).tolist() == np.searchsorted(values, keys).tolist()
        at_keys, at_values = common_ends(keys, values)
        both = np.intersect1d(keys, values)
        assert keys[at_keys].tolist() == values[at_values].tolist() == both.tolist()


def test_overlapping_tokens():
    # Bytes 0-2, 2-5, 5-6 against 0-1, 1-4, 4-6.
    first, last = overlaps(np.array([2, 5, 6]), np.array([1, 4, 6]))
    assert (first.tolist(), last.tolist()) == ([0, 1, 2], [1, 2, 2])


def test_empty_table_and_clashing_columns(docs):
    clash = docs.withColumn("n_a", F.lit("old")).withColumn("_text", F.lit(1)).withColumn("pair", F.lit(2))
    found = link_statistics(clash)
    assert found.count() == len(TEXTS) and dict(found.dtypes)["n_a"] == "bigint"
    assert found.where("pair = 2").count() == len(TEXTS)
    assert link_statistics(docs.limit(0)).count() == 0
