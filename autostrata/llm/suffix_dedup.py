"""Removal of long passages that occurred before, by anchors and hash-compared suffix sorting.

Every string of ``width`` bytes has an anchor: of its stretches of ``KEY`` bytes the leftmost with
the smallest hash, as far as its first bits tell. Equal strings have equal anchors at equal places, so they only have to be sought
among the strings with the same anchor; and there is one anchor for about thirty bytes of text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autostrata.llm.common import bitmap_bit, bitmap_of, bitmap_row, whole, with_row_key
from autostrata.llm.shingles import mix
from autostrata.llm.suffix_sort import HashedText, sort_suffixes
from autostrata.staging import materialize

WIDTH = 100
KEY = 40
FILTER_BITS = 27
# Contexts of one anchor that one task sorts; those of a more frequent anchor are dealt by string.
SORTED_TOGETHER = 20_000

_CHUNK = 1 << 18
_SLICE = 1 << 17
_PIECE = 1 << 22
# Bits that number the places of a chunk, which is shorter than _CHUNK + _PIECE + width.
_PLACE_BITS = 24


class _Anchors:
    """Anchors of the strings of some texts laid end to end.

    ``at`` are the anchors' places, ``low`` and ``high`` the first and last start of the strings
    that have it, ``text`` the text's number, and ``key`` the anchor's hash.
    """

    def __init__(self, texts: list[bytes], width: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        self.end = self.begin + sizes
        letters = np.frombuffer(b"".join(texts), np.uint8)
        self.hashed = HashedText(letters)
        spans = width - KEY + 1
        n = len(letters) - width + 1
        if n <= 0 or not (sizes >= width).any():
            self.at = self.low = self.high = self.text = np.empty(0, np.int64)
            self.key = np.empty(0, np.uint64)
            return
        hashes = mix(self.hashed.all_hashes(KEY))
        anchor = _leftmost_minimum(hashes, spans)
        string = np.flatnonzero(np.arange(n) <= np.repeat(self.end - width, sizes)[:n])
        anchor = anchor[string]
        # An anchor lies inside its strings, so strings of different texts never share one.
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        self.at = anchor[first]
        self.low = string[first]
        self.high = string[np.append(first[1:], len(string)) - 1]
        self.text = np.searchsorted(self.end, self.at, "right")
        self.key = hashes[self.at]

    def contexts(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and hash of the bytes that all strings of an anchor lie in; the hash also
        tells the anchor's place in them."""
        begin, end = self.low, self.high + width
        hashes = mix(self.hashed.hashes(begin, end - begin))
        place = ((self.at - begin) * 1024 + (self.high - self.low)).astype(np.uint64)
        return begin, end, mix(hashes ^ mix(place + np.uint64(1)))


def _leftmost_minimum(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each place the place of the leftmost minimum of the next ``span`` hashes, which count
    without their last ``_PLACE_BITS`` bits: the place stands there, so that one minimum finds both."""
    low = np.uint64((1 << _PLACE_BITS) - 1)
    best, size = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
    while size < span:
        shift = min(size, span - size)
        best = np.minimum(best[: len(best) - shift], best[shift:])
        size += shift
    return (best & low).astype(np.int64)


def _chunks(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[list, list, list]]:
    """Texts of about ``_CHUNK`` bytes together: rows, places in their texts, bytes. A long text
    comes in pieces that share ``width`` - 1 bytes, so that each string lies in one piece."""
    rows, places, texts, size = [], [], [], 0
    for row, value in enumerate(batch.column(column).cast(pa.binary())):
        text = value.as_py()
        for at in range(0, max(1, len(text) - width + 1), _PIECE):
            piece = text[at : at + _PIECE + width - 1]
            rows.append(row), places.append(at), texts.append(piece)
            size += len(piece)
            if size >= _CHUNK:
                yield rows, places, texts
                rows, places, texts, size = [], [], [], 0
    if texts:
        yield rows, places, texts


def _keys(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, texts in _chunks(batch, 0, width):
            keys = _Anchors(texts, width).key.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])


def _marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bitmap) * 8 - 1)
    bits = bitmap[(place >> np.uint64(3)).astype(np.int64)]
    return (bits >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _occurrences(
    batches: Iterator[pa.RecordBatch], width: int, bitmap, pair: bool
) -> Iterator[pa.RecordBatch]:
    """Anchors whose bit is set: by their hash, or with ``pair`` by that and the context's, and
    then with the bytes of the context."""
    bits = np.frombuffer(bitmap.value, np.uint8)
    names = ["id", "tie", "key", "context", "low", "high", "at", "bytes"]
    for batch in batches:
        for rows, places, texts in _chunks(batch, 2, width):
            found = _Anchors(texts, width)
            begin, end, context = found.contexts(width)
            wanted = np.flatnonzero(
                _marked(bits, mix(found.key ^ mix(context)) if pair else found.key)
            )
            if not len(wanted):
                continue
            text = found.text[wanted]
            shift = np.array(places)[text] - found.begin[text]
            row = pa.array(np.array(rows)[text])
            whole_bytes = found.hashed.letters.tobytes() if pair else b""
            contents = [
                whole_bytes[b:e] if pair else None
                for b, e in zip(begin[wanted].tolist(), end[wanted].tolist())
            ]
            columns = [
                batch.column(0).take(row),
                batch.column(1).take(row),
                pa.array(found.key[wanted].view(np.int64)),
                pa.array(context[wanted].view(np.int64)),
                pa.array(found.low[wanted] + shift),
                pa.array(found.high[wanted] + shift),
                pa.array(found.at[wanted] + shift),
                pa.array(contents, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def _repeated(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Of contexts that come key by key the strings that an earlier one also has.

    Whole keys are gathered until there is enough to work on, and then sorted as suffixes, those
    of one key and one place relative to the anchor against each other.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < 2 << 20:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column("key").to_numpy()
        cut = len(keys) - int((keys[::-1] != keys[-1]).argmax()) if keys[0] != keys[-1] else 0
        if cut:
            yield from _sorted(table.slice(0, cut), width)
            held = table.slice(cut).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield from _sorted(pa.Table.from_batches(held), width)


def _sorted(table: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    table = table.combine_chunks()
    if not table.num_rows:
        return
    order = pc.sort_indices(
        table,
        sort_keys=[("id", "ascending"), ("tie", "ascending"), ("low", "ascending")],
        null_placement="at_start",
    )
    earlier = np.empty(table.num_rows, np.int64)
    earlier[order.to_numpy()] = np.arange(table.num_rows)
    contexts = table.column("bytes").to_pylist()
    sizes = np.array([len(c) for c in contexts])
    begin = np.cumsum(sizes) - sizes
    text = HashedText(np.frombuffer(b"".join(contexts), np.uint8))
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    count = high - low + 1
    owner = np.repeat(np.arange(len(low)), count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[owner] + step
    place = (low[owner] + step) - table.column("at").to_numpy()[owner]
    key = np.unique(table.column("key").to_numpy(), return_inverse=True)[1]
    segment = key[owner] * 4096 - place  # strings with their anchor at the same place
    by_segment = np.argsort(segment, kind="stable")
    owner, step, start, segment = (x[by_segment] for x in (owner, step, start, segment))
    edges = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1], [True])))
    again = []
    at = 0
    while at < len(edges) - 1:  # whole segments, few enough to hold
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + _SLICE, "right")) - 1)
        part = slice(edges[at], edges[to])
        repeated = _later_ones(text, start[part], segment[part], earlier[owner[part]], width)
        again.append(edges[at] + repeated)
        at = to
    again = np.concatenate(again)
    again = again[np.lexsort((step[again], owner[again]))]
    owner, start = owner[again], low[owner[again]] + step[again]
    if not len(owner):
        return
    cut = np.flatnonzero(
        np.concatenate(([True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)))
    )
    last = np.append(cut[1:], len(owner)) - 1
    row = pa.array(owner[cut])
    yield pa.RecordBatch.from_arrays(
        [
            table.column("id").combine_chunks().take(row),
            table.column("tie").combine_chunks().take(row),
            pa.array(start[cut]),
            pa.array(start[last] + width),
        ],
        ["id", "tie", "start", "end"],
    )


def _later_ones(
    text: HashedText, start: np.ndarray, segment: np.ndarray, age: np.ndarray, width: int
) -> np.ndarray:
    """Which strings equal one of their segment that has a smaller ``age``."""
    ranked = sort_suffixes(text, start, segment, width)
    a, b = ranked[:-1], ranked[1:]
    same = np.flatnonzero(segment[a] == segment[b])
    same = same[text.hashes(start[a[same]], width) == text.hashes(start[b[same]], width)]
    same = same[text.equal_letters(start[a[same]], start[b[same]], width)]
    joined = np.zeros(len(ranked), bool)
    joined[same + 1] = True
    run = np.cumsum(~joined) - 1
    first = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, run, age[ranked])
    return ranked[age[ranked] != first[run]]


def _strings(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row for each string of the contexts, with a 128-bit digest of it."""
    for batch in batches:
        for i in range(batch.num_rows):
            low, high = batch.column("low")[i].as_py(), batch.column("high")[i].as_py()
            data = batch.column("bytes")[i].as_py()
            n = high - low + 1
            digests = [hashlib.blake2b(data[s : s + width], digest_size=16).digest() for s in range(n)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column("id")[i].as_py()] * n, batch.schema.field("id").type),
                    pa.array([batch.column("tie")[i].as_py()] * n, pa.int64()),
                    pa.array(np.arange(low, high + 1)),
                    pa.array(digests, pa.binary()),
                ],
                ["id", "tie", "start", "digest"],
            )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its spans, which may overlap: sizes, number of runs, hash, spans."""
    for batch in batches:
        sizes, removed, hashes, runs = [], [], [], []
        spans = batch.column(2)
        for value, found in zip(batch.column(1).cast(pa.binary()), spans):
            text, merged = value.as_py(), []
            for start, end in sorted((s["start"], s["end"]) for s in found.as_py() or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            digest, at = hashlib.sha256(), 0
            for start, end in merged:
                digest.update(memoryview(text)[at:start])
                at = end
            digest.update(memoryview(text)[at:])
            sizes.append(len(text))
            removed.append(sum(end - start for start, end in merged))
            hashes.append(digest.hexdigest())
            runs.append([{"start": s, "end": e} for s, e in merged])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(hashes, pa.string()), pa.array(runs, kind)],
            ["id", "n_bytes", "n_removed", "kept_sha256", "spans"],
        )


def _shared_bitmap(hashes: DataFrame, bits: int):
    """A bitmap of the hashes for the tasks: 2**bits bits, whatever the number of hashes."""
    out = np.zeros((1 << bits) // 8, np.uint8)
    for number, part in bitmap_of(hashes, "h", bits).toLocalIterator():
        out[number * len(part) : (number + 1) * len(part)] = np.frombuffer(part, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out.tobytes())


def remove_repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """What is left of each text when passages that occurred before are taken out.

    A byte goes if it lies in a string of ``width`` bytes that also starts earlier: in a document
    with a smaller id, or earlier in the same document. Strings are judged on the input; they may
    overlap and never cross documents. Result: ``id``, ``n_bytes``, ``n_removed``, ``kept_sha256``
    of what is left, and ``spans``, the maximal runs taken out (``start``, ``end`` in UTF-8 bytes).

    Anchors that occur once cannot matter; a bitmap of fixed size tells the tasks which occur
    again, and a bit set by chance adds work only. Where an anchor's whole context (all of its
    strings) is known from an earlier place, all its strings go. The first places of different
    contexts of one anchor are compared string by string: they are sorted as suffixes, key by
    key, and equal neighbours of the sorted order are confirmed on their bytes. Contexts of an
    anchor with more than ``SORTED_TOGETHER`` of them are dealt by the strings' own digests.

    NULL and empty texts lose nothing. NULL ids come first; rows that repeat an id count as
    different documents, in an arbitrary but fixed order. Other columns are ignored; an empty
    table gives an empty result.
    """
    keyed, key = with_row_key(docs.select(id, text), id)
    tie = F.xxhash64(F.col(f"{key}.file"), F.col(f"{key}.row"))
    texts = keyed.select(F.col(id).alias("id"), tie.alias("tie"), whole(text).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    columns = (
        f"id {kind}, tie bigint, key bigint, context bigint, low bigint, high bigint, "
        "at bigint, bytes binary"
    )

    keys = texts.select("text").mapInArrow(lambda b: _keys(b, width), "key bigint")
    again = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    again = materialize(again.select(F.col("key").alias("h")), "again")
    known = _shared_bitmap(again, filter_bits)
    places = texts.mapInArrow(lambda b: _occurrences(b, width, known, False), columns)
    places = materialize(places.drop("bytes"), "places")

    here = F.struct("id", "tie", "low")
    firsts = materialize(
        places.groupBy("key", "context").agg(F.min(here).alias("first"), F.count("*").alias("n")),
        "firsts",
    )
    repeats = (
        places.join(firsts.where("n > 1").select("key", "context", "first"), ["key", "context"])
        .where(here != F.col("first"))
        .select("id", "tie", F.col("low").alias("start"), (F.col("high") + width).alias("end"))
    )

    several = firsts.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1")
    rivals = firsts.join(several, "key")
    rivals = materialize(rivals.select("key", "context", "first", "contexts"), "rivals")
    pairs = rivals.select(_pair_hash("key", "context").alias("h"))
    marked = _shared_bitmap(pairs, filter_bits)
    contexts = texts.mapInArrow(lambda b: _occurrences(b, width, marked, True), columns)
    contexts = contexts.withColumn("first", here).join(rivals, ["key", "context", "first"])
    contexts = materialize(contexts.drop("first", "context"), "contexts")
    span = f"id {kind}, tie bigint, start bigint, end bigint"
    sorted_ = (
        contexts.where(F.col("contexts") <= SORTED_TOGETHER)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _repeated(b, width), span)
    )
    strings = contexts.where(F.col("contexts") > SORTED_TOGETHER).mapInArrow(
        lambda b: _strings(b, width), f"id {kind}, tie bigint, start bigint, digest binary"
    )
    strings = materialize(strings, "strings")
    this = F.struct("id", "tie", "start")
    oldest = materialize(
        strings.groupBy("digest").agg(F.min(this).alias("first"), F.count("*").alias("n")).where("n > 1"),
        "oldest",
    )
    dealt = (
        strings.join(oldest, "digest")
        .where(this != F.col("first"))
        .select("id", "tie", "start", (F.col("start") + width).alias("end"))
    )
    spans = repeats.union(sorted_).union(dealt)
    spans = materialize(
        spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans")),
        "spans",
    )
    return _without(texts, spans, kind, filter_bits).withColumnRenamed("id", id)


def _pair_hash(key: str, context: str) -> Column:
    """The hash that ``_occurrences`` tests for a pair: made in Python, so that both agree."""

    @F.pandas_udf("bigint")
    def both(keys, contexts):
        a = keys.to_numpy().view(np.uint64)
        b = contexts.to_numpy().view(np.uint64)
        return type(keys)(mix(a ^ mix(b)).view(np.int64))

    return both(key, context)


def _without(texts: DataFrame, spans: DataFrame, kind: str, bits: int) -> DataFrame:
    """``spans`` cut out of the texts. Only texts that may have one are shuffled to meet them."""
    h = F.xxhash64("id", "tie")
    bitmap = materialize(bitmap_of(spans.select(h.alias("h")), "h", bits), "bitmap")
    tested = texts.withColumn("_bitmap_row", bitmap_row(h, bits)).join(
        F.broadcast(bitmap), "_bitmap_row", "left"
    )
    tested = tested.select("id", "tie", "text", bitmap_bit(h, F.col("_bitmap")).alias("may"))
    span = "array<struct<start:bigint,end:bigint>>"
    same = tested["id"].eqNullSafe(spans["id"]) & (tested["tie"] == spans["tie"])
    met = tested.where("may").join(spans, same, "left")
    met = met.select(tested["id"], "text", "spans")
    rest = tested.where("not may").select("id", "text", F.lit(None).cast(span).alias("spans"))
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, kept_sha256 string, spans {span}"
    return met.mapInArrow(_cut, schema).union(rest.mapInArrow(_cut, schema))
