"""Alignment of two tokenizers' tokens over the same bytes, and which of their tokens belong together."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autostrata.llm.common import whole
from autostrata.staging import materialize

# Files of the two tokenizers, on every machine that runs tasks.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

# Characters that are tokenized and aligned together.
SLICE = 1 << 18

# At most so many id pairs can hold this share of all links each, so these may be broadcast.
FREQUENT = 1 << 16


# --- tokenizers ----------------------------------------------------------------------------


class Vocabulary(NamedTuple):
    """Bytes of each token, their number, and its id as text before a comma and at an end."""

    token: list[bytes]
    size: np.ndarray
    inner: list[str]
    last: list[str]


def _vocabulary(token: list[bytes], end: str) -> Vocabulary:
    return Vocabulary(
        token,
        np.array([len(t) for t in token], np.int64),
        [f"{i}," for i in range(len(token))],
        [f"{i}{end}" for i in range(len(token))],
    )


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 letters
    stand for themselves, the other bytes, in order, for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


# Fixed value: how byte-level vocabularies of this family split a text before any merge.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@cache
def byte_tokenizer(path: str):
    """Encoder of texts and vocabulary of a byte-level BPE file; special tokens are plain text.

    The file's vocabulary is run by an engine that ranks merges by the id of what they make, so
    the file's merges have to come in that order; others are refused. Spares two thirds of the time
    of the file's own library, with equal tokens.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model, letters = content["model"], _byte_letters()
    added = {t["content"] for t in content.get("added_tokens", [])}
    ids = {
        bytes(letters[c] for c in text): i for text, i in model["vocab"].items() if text not in added
    }
    merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    made = [model["vocab"]["".join(m)] for m in merges]
    if made != sorted(made) or not set(map(bytes, zip(range(256)))) <= ids.keys():
        raise ValueError(f"{path} is no byte-level vocabulary in the order of its merges")
    engine = tiktoken.Encoding(
        path, pat_str=PATTERN, mergeable_ranks=ids, special_tokens={}
    )
    token = [b""] * (max(model["vocab"].values()) + 1)
    for piece, i in ids.items():
        token[i] = piece

    def encode(texts: list[str]) -> list[list[int]]:
        return [engine.encode_ordinary(t) for t in texts]

    return encode, _vocabulary(token, "|")


@cache
def piece_tokenizer(path: str):
    """Encoder of texts, to which it adds a leading space, and vocabulary of a piece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def piece(i: int) -> bytes:
        text = model.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if model.is_byte(i) else text.replace("▁", " ").encode()

    def encode(texts: list[str]) -> list[list[int]]:
        return model.encode(texts, num_threads=1)

    return encode, _vocabulary([piece(i) for i in range(len(model))], ";")


# --- alignment -----------------------------------------------------------------------------


def gallop(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each key the first place in ``values`` that is not smaller; both ascend.

    Every key searches onward from the place of a key before it, in steps that double, and then by
    halving the last step, so its cost grows with the logarithm of the distance. Keys take turns:
    first those at the widest spacing, then those halfway between, all of one spacing at once.
    """
    place = np.zeros(len(keys), np.int64)
    padded = np.append(values, np.iinfo(np.int64).max)
    if len(keys):
        place[:1] = _search(padded, keys[:1], place[:1])
        stride = 1 << max(len(keys) - 1, 0).bit_length()
        while stride := stride // 2:
            turn = np.arange(stride, len(keys), 2 * stride)
            place[turn] = _search(padded, keys[turn], place[turn - stride])
    return place


def _search(values: np.ndarray, keys: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Exponential, then binary search of each key from ``low`` on; the last value is no answer's
    right neighbour, as it is larger than any key."""
    low, end = low.copy(), len(values) - 1
    step = np.ones(len(keys), np.int64)
    open_ = np.arange(len(keys))
    while len(open_):
        reached = np.minimum(low[open_] + step[open_] - 1, end)
        open_ = open_[values[reached] < keys[open_]]
        low[open_] += step[open_]
        step[open_] *= 2
    high = np.minimum(low + step - 1, end)
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        smaller = values[middle] < keys[open_]
        low[open_[smaller]] = middle[smaller] + 1
        high[open_[~smaller]] = middle[~smaller]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in ``a`` and ``b``, two ascending lists, of the values in both; the shorter list
    drives the search in the longer."""
    if len(a) > len(b):
        return common_ends(b, a)[::-1]
    place = gallop(a, b)
    inside = np.flatnonzero(place < len(b))
    hit = inside[b[place[inside]] == a[inside]]
    return hit, place[hit]


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of the tokens that end at ``b`` that share bytes with each that ends at ``a``."""
    last = gallop(a, b)
    before = np.concatenate(([0], a[:-1]))
    first = gallop(before + 1, b)
    return first, last


class _Aligned(NamedTuple):
    """Tokens of some texts in a row, where their ends meet, and where each text's parts end."""

    a: np.ndarray
    b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    stops_a: list[int]
    stops_b: list[int]
    stops: list[int]


def _aligned(texts: list[str], first, second) -> _Aligned:
    (encode_a, vocabulary_a), (encode_b, vocabulary_b) = first, second
    spaced = [" " + t for t in texts]
    a, b = encode_a(spaced), encode_b(texts)
    for i, text in enumerate(spaced):
        raw = text.encode()
        same = (
            len(raw) > 1
            and b"".join(map(vocabulary_a.token.__getitem__, a[i])) == raw
            and b"".join(map(vocabulary_b.token.__getitem__, b[i])) == raw
        )
        if not same:
            a[i], b[i] = [], []
    stops_a, stops_b = list(accumulate(map(len, a))), list(accumulate(map(len, b)))
    a = np.fromiter(chain.from_iterable(a), np.int64, stops_a[-1])
    b = np.fromiter(chain.from_iterable(b), np.int64, stops_b[-1])
    # The texts' bytes follow each other, so all texts are aligned in one go.
    at_a, at_b = common_ends(np.cumsum(vocabulary_a.size[a]), np.cumsum(vocabulary_b.size[b]))
    stops = np.searchsorted(at_a, stops_a).tolist()
    return _Aligned(a, b, at_a, at_b, stops_a, stops_b, stops)


def _spelled(found: _Aligned, first: Vocabulary, second: Vocabulary) -> Iterator[str]:
    """Each text's groups: ids of one tokenizer, a bar, ids of the other, with semicolons between."""
    ends_a, ends_b = np.zeros(len(found.a), bool), np.zeros(len(found.b), bool)
    ends_a[found.at_a], ends_b[found.at_b] = True, True
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    before = np.concatenate(([0], found.at_b + 1))
    order = np.empty(len(found.a) + len(found.b), np.int64)
    size_a, size_b = len(first.token), len(second.token)
    order[np.arange(len(found.a)) + before[group_a]] = found.a + size_a * ends_a
    order[np.arange(len(found.b)) + found.at_a[group_b] + 1] = (
        found.b + size_b * ends_b + 2 * size_a
    )
    words = _words(first, second)
    start = 0
    for stop in map(int.__add__, found.stops_a, found.stops_b):
        yield "".join(map(words.__getitem__, order[start:stop].tolist()))[:-1]
        start = stop


_WORDS: dict[tuple[int, int], list[str]] = {}


def _words(first: Vocabulary, second: Vocabulary) -> list[str]:
    key = id(first.token), id(second.token)
    if key not in _WORDS:
        _WORDS[key] = first.inner + first.last + second.inner + second.last
    return _WORDS[key]


# --- tables --------------------------------------------------------------------------------


def align(
    docs: DataFrame,
    text: str = "text",
    byte_bpe: str = BYTE_BPE,
    piece_bpe: str = PIECE_BPE,
    keep_groups: bool = True,
) -> DataFrame:
    """Each row of ``docs`` without its text, with the alignment of its tokens.

    A is the byte-level tokenizer, which gets the text after a space, and B the piece tokenizer,
    which adds the space itself. The bytes where a token of A and one of B both end cut the tokens
    into groups: ``groups`` (``a1,a2|b1;a3|b2,b3``; on request) and ``groups_sha256``, empty
    without tokens. A link is a pair of tokens that end together; ``links`` has the different pairs
    of ids, ``pair`` being A's id times B's vocabulary size plus B's id, and how often each occurs.

    NULL and empty texts, and texts that one tokenizer does not give back as they are, have no
    tokens. Texts are handled one by one, whole, with no shuffle; a text's tokens are in memory
    together. Columns of ``docs`` that are named like results are replaced.
    """
    fields = [("n_a", T.LongType()), ("n_b", T.LongType()), ("n_groups", T.LongType()),
              ("n_links", T.LongType()), ("groups_sha256", T.StringType()), ("pairs", T.ArrayType(T.LongType())),
              ("times", T.ArrayType(T.LongType()))]
    if keep_groups:
        fields.append(("groups", T.StringType()))
    names = {name for name, _ in fields} | {"links", "groups", "_text"}
    others = [c for c in docs.columns if c != text and c not in names]
    schema = T.StructType([*docs.select(*(F.col(f"`{c}`") for c in others)).schema, *(T.StructField(*f) for f in fields)])

    most = SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_tokenizer(byte_bpe), piece_tokenizer(piece_bpe)
        for batch in batches:
            sizes = np.cumsum(batch.column("_text").to_pandas().str.len().to_numpy(np.int64))
            start = 0
            while start < len(batch):
                passed = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, passed + most, side="right")))
                part = batch.slice(start, stop - start)
                kept = [part.column(c) for c in others]
                columns = _columns(part.column("_text").to_pylist(), first, second, keep_groups)
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=schema.names)
                start = stop

    chosen = docs.select(*(F.col(f"`{c}`") for c in others), whole(text).alias("_text"))
    found = chosen.mapInArrow(run, schema)
    links = F.transform(
        F.arrays_zip("pairs", "times"),
        lambda x: F.struct(x["pairs"].alias("pair"), x["times"].alias("times")),
    )
    return found.withColumn("links", links).drop("pairs", "times")


def _columns(texts: list[str], first, second, keep_groups: bool) -> list[pa.Array]:
    found = _aligned(texts, first, second)
    codes = found.a[found.at_a] * len(second[1].token) + found.b[found.at_b]
    pairs, times, shas, spelled = [], [], [], []
    start = 0
    for stop, groups in zip(found.stops, _spelled(found, first[1], second[1])):
        pair, count = np.unique(codes[start:stop], return_counts=True)
        pairs.append(pair)
        times.append(count)
        shas.append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        spelled.append(groups)
        start = stop
    n_groups = pa.array(np.diff([0, *found.stops]))
    offsets = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
    columns = [
        pa.array(np.diff([0, *found.stops_a])),
        pa.array(np.diff([0, *found.stops_b])),
        n_groups,
        n_groups,  # no token is empty, so one of A and one of B end where a group does
        pa.array(shas, pa.string()),
        pa.ListArray.from_arrays(offsets, np.concatenate(pairs)),
        pa.ListArray.from_arrays(offsets, np.concatenate(times)),
    ]
    return columns + [pa.array(spelled, pa.string())] if keep_groups else columns


def pair_counts(aligned: DataFrame, vocabulary: int) -> tuple[DataFrame, int]:
    """How many links hold each pair (``times``), whether no other pair of the same B id has more
    (``best``), and the number of all links. ``vocabulary`` is the number of B's ids."""
    links = aligned.select(F.explode("links").alias("_link")).select("_link.pair", "_link.times")
    total = Observation()
    counts = links.groupBy("pair").agg(F.sum("times").alias("times"))
    counts = materialize(counts.observe(total, F.sum("times").alias("links")), "pairs")
    b = (F.col("pair") % vocabulary).alias("_b")
    most = counts.groupBy(b).agg(F.max("times").alias("_most"))
    ranked = counts.join(most, F.col("pair") % vocabulary == F.col("_b"))
    ranked = ranked.select("pair", "times", (F.col("times") == F.col("_most")).alias("best"))
    return materialize(ranked, "ranked"), total.get["links"] or 0


def link_statistics(
    docs: DataFrame,
    text: str = "text",
    byte_bpe: str = BYTE_BPE,
    piece_bpe: str = PIECE_BPE,
) -> DataFrame:
    """The rows of ``align`` with ``count_sum``, the sum of their links' counts in all texts, and
    ``n_best``, the number of links whose count no other pair with the same B id exceeds.

    The alignment is written once. Pairs that hold at least one link in ``FREQUENT`` are at most
    ``FREQUENT`` many, so they are broadcast; the others are shuffled, and none of these holds more
    than that share. A text's sums are combined in each task before they meet.
    """
    numbered = align(docs, text, byte_bpe, piece_bpe, keep_groups=False).select(
        "*", F.monotonically_increasing_id().alias("_row_number")
    )
    aligned = materialize(numbered, "aligned")
    counts, total = pair_counts(aligned, len(piece_tokenizer(piece_bpe)[1].token))
    often = F.col("times") * FREQUENT >= total
    links = aligned.select("_row_number", F.explode("links").alias("_link")).select(
        "_row_number", "_link.pair", F.col("_link.times").alias("_own")
    )
    frequent = F.broadcast(counts.where(often))
    known = links.join(frequent, "pair")
    rest = links.join(frequent.select("pair"), "pair", "left_anti").join(
        counts.where(~often), "pair"
    )
    sums = (
        known.unionByName(rest)
        .groupBy("_row_number")
        .agg(
            F.sum(F.when(F.col("best"), F.col("_own")).otherwise(0)).alias("n_best"),
            F.sum(F.col("_own") * F.col("times")).alias("count_sum"),
        )
    )
    kept = [c for c in aligned.columns if c not in ("n_best", "count_sum", "_row_number")]
    return aligned.join(sums, "_row_number", "left").select(
        *(aligned[f"`{c}`"] for c in kept),
        F.coalesce(sums["n_best"], F.lit(0)).alias("n_best"),
        F.coalesce(sums["count_sum"], F.lit(0)).alias("count_sum"),
    )
