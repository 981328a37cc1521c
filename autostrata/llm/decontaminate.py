"""Benchmark passages in training texts, found by a distributed positional inverted index.

The index holds, for each test term and document, the positions of the term in the document. The
lists of a window's two rarest terms are intersected first, shifted by the terms' distance; what
is left is checked against the lists of all its terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autostrata.llm.common import bitmap_of, whole, with_row_key, without_rows
from autostrata.staging import materialize

WINDOW = 10
TERM_BITS = 24
SALTS = 64

_CHUNK_WORDS = 1 << 16
_CACHED_WORDS = 1 << 19

# ASCII letters in lower case and digits form words, as do all bytes of non-ASCII letters.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _term(word: bytes) -> int:
    """A term's 64-bit number; 0 is kept for words that are no terms."""
    return (xxhash.xxh3_64_intdigest(word) or 1) - (1 << 63)


class _Terms(dict):
    """Numbers of words whose bit is set, 0 for all others. Forgets when it grows too large."""

    def __init__(self, bitmap: bytes):
        self.bits = np.frombuffer(bitmap, np.uint8)

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED_WORDS:
            self.clear()
        number = _term(word)
        place = number % (len(self.bits) * 8)
        known = number if self.bits[place >> 3] >> (place & 7) & 1 else 0
        self[word] = known
        return known


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [
            [_term(w) for w in split_words(t.as_py())] for t in batch.column(2).cast(pa.binary())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(words, pa.list_(pa.int64()))],
            ["item", "item_id", "words"],
        )


def _postings(batches: Iterator[pa.RecordBatch], bitmap: bytes) -> Iterator[pa.RecordBatch]:
    """For each text its head (number of words) and a posting for each of its terms."""
    terms = _Terms(bitmap)
    for batch in batches:
        texts, at = batch.column(2).cast(pa.binary()), 0
        while at < len(texts):
            counts, numbers, begin, size = [], [], at, 0
            while at < len(texts) and size < _CHUNK_WORDS:
                words = split_words(texts[at].as_py())
                counts.append(len(words))
                numbers.append(np.array([terms[w] for w in words], np.int64))
                size += len(words)
                at += 1
            yield from _chunk(batch.slice(begin, at - begin), counts, numbers)


def _chunk(
    batch: pa.RecordBatch, counts: list[int], numbers: list[np.ndarray]
) -> Iterator[pa.RecordBatch]:
    names = ["row", "id", "n_words", "term", "positions"]
    lists = pa.list_(pa.int32())
    n = len(counts)
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
         pa.nulls(n, pa.int64()), pa.nulls(n, lists)],
        names,
    )
    term = np.concatenate(numbers)
    owner = np.repeat(np.arange(n), counts)
    place = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
    known = np.flatnonzero(term)
    term, owner, place = term[known], owner[known], place[known]
    order = np.lexsort((term, owner))  # stable, so positions stay in order
    term, owner, place = term[order], owner[order], place[order]
    new = np.flatnonzero(
        np.concatenate(([True], (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])))[: len(term)]
    )
    offsets = np.append(new, len(term)).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(pa.array(owner[new])),
            pa.nulls(len(new), batch.column(1).type),
            pa.nulls(len(new), pa.int64()),
            pa.array(term[new]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(place)),
        ],
        names,
    )


class PositionalIndex:
    """Postings of the words of ``docs`` that occur in ``benchmark``.

    Which words are test terms is told to the tasks by a bitmap of fixed size (2**TERM_BITS bits,
    2 MiB), so neither table has to be small; a bit set by chance stores postings nobody asks for.
    Terms are 64-bit hashes. The table is laid out by term, frequent terms in several parts.
    """

    def __init__(
        self,
        docs: DataFrame,
        benchmark: DataFrame,
        id: str = "doc_id",
        text: str = "text",
        item_id: str = "item_id",
        item_text: str = "text",
    ):
        rows = [F.monotonically_increasing_id(), F.col(item_id), whole(item_text)]
        kind = benchmark.schema[item_id].dataType.simpleString()
        self.items = materialize(
            benchmark.select(*rows).mapInArrow(
                _items, f"item bigint, item_id {kind}, words array<bigint>"
            ),
            "items",
        )
        bitmap = self._term_bitmap()
        rows = [F.monotonically_increasing_id(), F.col(id).alias("id"), whole(text)]
        kind = docs.schema[id].dataType.simpleString()
        everything = docs.select(*rows).mapInArrow(
            lambda batches: _postings(batches, bitmap),
            f"row bigint, id {kind}, n_words bigint, term bigint, positions array<int>",
        )
        by_term = everything.repartition("term", F.col("row") % SALTS)
        index = materialize(by_term.sortWithinPartitions("term", "row"), "index")
        self.heads = index.where("term is null").select("row", "id", "n_words")
        self.postings = index.where("term is not null").select("term", "row", "positions")

    def _term_bitmap(self) -> bytes:
        """Bits of the test terms. The rows collected are 4 KiB each, 512 at most."""
        out = np.zeros((1 << TERM_BITS) // 8, np.uint8)
        terms = self.items.select(F.explode("words").alias("term"))
        for number, bits in bitmap_of(terms, "term", TERM_BITS).collect():
            out[number * len(bits) : (number + 1) * len(bits)] = np.frombuffer(bits, np.uint8)
        return out.tobytes()

    def matches(self, window: int = WINDOW, slop: int = 0) -> DataFrame:
        """Runs of item words in documents: ``row``, ``item_id``, ``start``, ``end`` (words).

        A run consists of windows of ``window`` consecutive item words (all words of a shorter
        item) that occur in the document: as a phrase, or with ``slop`` > 0 with each word at most
        that far from its place beside the window's rarest word.
        """
        pairs = materialize(self._rarest_pairs(window), "pairs")
        aligned = materialize(self._aligned(pairs, slop), "aligned")
        places = F.explode(F.expr("sequence(start, start + width - 1)"))
        wanted = (
            aligned.join(pairs, ["t1", "t2", "distance"])
            .select("item", "row", (F.col("p1") - F.col("i1")).alias("shift"), "width",
                    F.explode("starts").alias("start"))
            .select("item", "row", "shift", "width", places.alias("place"))
            .distinct()
        )
        terms = self.items.select("item", "item_id", F.posexplode("words").alias("place", "term"))
        probes = wanted.join(terms, ["item", "place"]).withColumn(
            "position", F.col("place") + F.col("shift")
        )
        # The lists in question, a row for each position that a word at most slop away may have.
        asked = probes.select("row", "term").distinct()
        near = F.flatten(F.transform("positions", lambda p: F.sequence(p - slop, p + slop)))
        listed = self.postings.join(asked, ["row", "term"], "left_semi").select(
            "row", "term", F.explode(F.array_distinct(near) if slop else "positions").alias("position")
        )
        found = probes.join(listed, ["row", "term", "position"])
        order = Window.partitionBy("item", "row", "shift").orderBy("place")
        island = F.col("place") - F.row_number().over(order)
        return (
            found.withColumn("island", island)
            .groupBy("item", "item_id", "row", "shift", "width", "island")
            .agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
            .where("hi - lo + 1 >= width")
            .select(
                "row",
                "item_id",
                (F.col("lo") + F.col("shift")).alias("start"),
                (F.col("hi") + F.col("shift") + 1).alias("end"),
            )
        )

    def _rarest_pairs(self, window: int) -> DataFrame:
        """The two rarest words of each window: places ``i1``, ``i2``, terms ``t1``, ``t2``, their
        ``distance``, and the ``starts`` of the item's windows of which they are the rarest.
        Windows with a word that no document has are left out."""
        counts = self.postings.groupBy("term").agg(F.sum(F.size("positions")).alias("n"))
        size = F.size("words").alias("size")
        words = self.items.select("item", size, F.posexplode("words").alias("place", "term"))
        # The words of each window and no more are together, whatever the length of the item.
        ahead = Window.partitionBy("item").orderBy("place").rowsBetween(0, window - 1)
        word = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "term")
        return (
            words.join(counts, "term", "left")
            .select(
                "item",
                F.least(F.lit(window), "size").alias("width"),
                F.col("place").alias("start"),
                "size",
                F.array_sort(F.collect_list(word).over(ahead)).alias("r"),
            )
            .where("start + width <= size and r[0].n > 0")
            .select(
                "item",
                "width",
                "start",
                F.expr("r[0].place").alias("i1"),
                F.expr("r[0].term").alias("t1"),
                F.expr("r[least(1, width - 1)].place").alias("i2"),
                F.expr("r[least(1, width - 1)].term").alias("t2"),
            )
            .withColumn("distance", F.col("i2") - F.col("i1"))
            .groupBy("item", "width", "i1", "t1", "t2", "distance")
            .agg(F.collect_list("start").alias("starts"))
        )

    def _aligned(self, pairs: DataFrame, slop: int) -> DataFrame:
        """Places ``p1`` of the rarest term that have the second rarest at its distance."""
        wanted = pairs.select("t1", "t2", "distance").distinct()
        lists = self.postings.select(
            F.col("term").alias("t1"), "row", F.col("positions").alias("first")
        )
        others = self.postings.join(
            wanted.select(F.col("t2").alias("term")).distinct(), "term", "left_semi"
        ).select(F.col("term").alias("t2"), "row", F.col("positions").alias("second"))
        moved = F.flatten(
            F.transform(
                "second",
                lambda p: F.sequence(
                    p - F.col("distance") - slop, p - F.col("distance") + slop
                ),
            )
        )
        both = lists.join(wanted, "t1").join(others, ["t2", "row"])
        return both.select(
            "t1", "t2", "distance", "row", F.explode(F.array_intersect("first", moved)).alias("p1")
        )

    def contamination(self, window: int = WINDOW) -> DataFrame:
        """For each document: ``id``, ``n_words``, ``n_hit`` (words inside a match), ``item_ids``
        (as strings, sorted) and ``row``."""
        matches = materialize(self.matches(window), "matches")
        in_order = Window.partitionBy("row").orderBy("start", "end")
        reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
        fresh = F.col("end") - F.greatest("start", F.coalesce(reached, F.lit(0)))
        hits = (
            matches.select("row", "start", "end")
            .distinct()
            .withColumn("fresh", F.greatest(fresh, F.lit(0)))
            .groupBy("row")
            .agg(F.sum("fresh").alias("n_hit"))
        )
        names = matches.select("row", F.col("item_id").cast("string").alias("name")).distinct()
        items = names.groupBy("row").agg(F.array_sort(F.collect_list("name")).alias("item_ids"))
        return (
            self.heads.join(hits, "row", "left")
            .join(items, "row", "left")
            .select(
                "row",
                "id",
                "n_words",
                F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            )
        )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` in which no window of a benchmark item occurs, columns as they were.

    NULL and empty texts have no words and stay; NULL and empty items match nothing; an item that
    is repeated matches as one. An empty benchmark drops nothing.
    """
    keyed, key = with_row_key(docs, id)
    found = PositionalIndex(keyed, benchmark, key, text).contamination()
    return without_rows(
        keyed, found.where("n_hit > 0").select(F.col("id").alias(key)), key
    ).select(*docs.columns)
