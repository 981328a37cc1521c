"""Near duplicates by b-bit MinHash: banded candidates, bit-count estimates, exact confirmation."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autostrata.llm.common import (
    bitmap_bit,
    bitmap_of,
    bitmap_row,
    whole,
    with_row_key,
    without_rows,
)
from autostrata.llm.components import connected_components
from autostrata.llm.shingles import mix, shingle_set
from autostrata.staging import materialize, materialize_counted

WORDS = 5
ROWS_PER_BAND = 6
MISS = 1e-6
KEPT_BITS = 2
STAR_ROUNDS = 3
FILTER_BITS = 26
# Sets of fewer shingles are compared in full, without an estimate: minima of so few shingles do not
# agree independently of each other.
LEAST_ESTIMATED = 64

_CHUNK = 1 << 16
# Places of the parity bits.
_PARITIES = 512
# Ratio of the steps that sizes are cut into.
_STEP = 1.02


def bands_for(similarity: float, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    """Bands after which a pair of just that similarity shares none with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


class Signer:
    """Signatures of shingle sets: band keys, and the low bits of all minima in bit planes."""

    def __init__(self, bands: int, rows: int = ROWS_PER_BAND, kept_bits: int = KEPT_BITS):
        self.bands, self.rows, self.kept_bits = bands, rows, kept_bits
        random = np.random.default_rng(314159)
        self.flips = random.integers(0, 2**32, bands * rows, dtype=np.uint32)
        self.factors = random.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + 1
        self.weights = random.integers(0, 2**63, (bands, rows), dtype=np.uint64) * 2 + 1
        self.salts = random.integers(0, 2**63, bands, dtype=np.uint64)

    def minima(self, sets: list[np.ndarray]) -> np.ndarray:
        """The minimum of each permutation (row) over each set (column); no set may be empty."""
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        shingles = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
        out = np.empty((len(self.flips), len(sets)), np.uint32)
        for k, (flip, factor) in enumerate(zip(self.flips, self.factors)):
            np.minimum.reduceat((shingles ^ flip) * factor, starts, out=out[k])
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key per set (row) and band (column)."""
        parts = minima.reshape(self.bands, self.rows, -1).astype(np.uint64)
        sums = (parts * self.weights[:, :, None]).sum(axis=1, dtype=np.uint64)
        return mix(sums + self.salts[:, None]).T

    def kept(self, minima: np.ndarray) -> np.ndarray:
        """The kept bits of each minimum. It is scrambled before: the low bits of two minima as they
        are agree for all permutations or for none."""
        return _scrambled(minima + self.flips[:, None]) & np.uint32(2**self.kept_bits - 1)

    def planes(self, minima: np.ndarray) -> np.ndarray:
        """For each set (row) the kept bits of its minima, plane after plane, in 64-bit words."""
        count = minima.shape[1]
        minima = self.kept(minima)
        words = -(-len(self.flips) // 64)
        out = np.zeros((count, self.kept_bits, words * 64), np.uint8)
        for bit in range(self.kept_bits):
            out[:, bit, : len(self.flips)] = ((minima >> np.uint32(bit)) & 1).T
        return np.packbits(out, axis=2).reshape(count, -1).view(np.int64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """32-bit values mixed one to one."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set (row), in 64-bit words, whether an odd number of shingles falls on each of
    ``_PARITIES`` places: two sets differ in no fewer shingles than in such bits."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = (np.concatenate(sets) & np.uint64(_PARITIES - 1)).astype(np.int64)
    counts = np.bincount(owner * _PARITIES + place, minlength=len(sets) * _PARITIES)
    bits = (counts & 1).astype(np.uint8).reshape(len(sets), _PARITIES)
    return np.packbits(bits, axis=1).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], signer: Signer, words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        at = 0
        while at < len(texts):  # as many texts as fill a chunk of shingles
            sets, size, begin = [], 0, at
            while at < len(texts) and size < _CHUNK:
                sets.append(shingle_set(texts[at].as_py(), words))
                size += len(sets[-1])
                at += 1
            yield _signed(batch.column(0).slice(begin, at - begin), sets, signer)


def _signed(ids: pa.Array, sets: list[np.ndarray], signer: Signer) -> pa.RecordBatch:
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    keys = np.zeros((len(full), signer.bands), np.int64)
    planes = np.zeros((len(full), 0), np.int64)
    nodes: list[bytes | None] = [None] * len(sets)
    if len(full):
        some = [sets[i] for i in full]
        minima = signer.minima(some)
        keys = signer.band_keys(minima).view(np.int64)
        planes = np.hstack((signer.planes(minima), parities(some)))
        for i, s in zip(full, some):
            nodes[i] = _node(s)
    present = np.zeros(len(sets), np.int64)
    present[full] = 1

    def lists(values: np.ndarray) -> pa.Array:
        width = values.shape[1]
        offsets = np.concatenate(([0], np.cumsum(present * width))).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(values).ravel())

    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes), pa.array(nodes, pa.binary()), lists(keys), lists(planes)],
        ["id", "n_shingles", "node", "keys", "planes"],
    )


def _node(shingles: np.ndarray) -> bytes:
    """The identity of a set: two 64-bit sums over it."""
    sums = [shingles.sum(dtype=np.uint64), mix(shingles).sum(dtype=np.uint64)]
    return np.array(sums, np.uint64).tobytes()


def _node_sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(0).cast(pa.binary())
        for begin in range(0, len(texts), 256):
            sets = [shingle_set(t.as_py(), words) for t in texts.slice(begin, 256)]
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            shingles = pa.array(np.concatenate(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_node(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(offsets, shingles),
                ],
                ["node", "shingles"],
            )


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    similarity: float = 0.8,
    words: int = WORDS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    A document's set is its distinct shingles of ``words`` words (ASCII letters in lower case);
    two documents are linked if the Jaccard similarity of their sets is at least ``similarity``.

    Documents with equal sets are one node, found by a 128-bit sum over the set, so copies cost
    nothing below. Nodes that share a band of six minima are candidates; the number of bands makes
    a link at the threshold fail to become one with probability one in a million. A candidate pair
    goes on if its similarity, estimated from the two bits kept of each minimum and corrected for
    bits that agree by chance, is high enough (``least_estimate``), or if a set is too small for an
    estimate; it is then confirmed on the full sets.

    Only connections count, so a bucket's pairs are not written out: in each of a few rounds every
    node of a bucket meets one hub of that bucket, unless both are in one component already; the
    hub changes from round to round, and buckets that lie in one component drop out. Pairs of the
    buckets left over that lie in different components meet in a last round, all but those whose
    sizes, unshared shingles and parity bits rule a link out (``_Links.possible``), so no link is
    lost.

    NULL texts are empty; a document without words has size 0, is linked with nothing and is its
    own component. Rows with equal texts are linked whatever their ids. NULL ids are
    smaller than all others. Other columns are ignored; an empty table gives an empty result.
    """
    signer = Signer(bands_for(similarity))
    texts = docs.select(F.col(id).alias("id"), whole(text).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    profile = materialize(
        texts.mapInArrow(
            lambda batches: _sign(batches, signer, words),
            f"id {id_type}, n_shingles bigint, node binary, "
            "keys array<bigint>, planes array<bigint>",
        ),
        "profile",
    )
    # Which of equal sets' rows gives keys and planes does not matter: all have the same.
    nodes = materialize(
        profile.where("n_shingles > 0")
        .groupBy("node")
        .agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n_shingles", "keys", "planes"))),
        "nodes",
    )
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = materialize(buckets.join(shared, "key", "left_semi"), "members")
    sets = _candidate_sets(texts, nodes, members, words, filter_bits)
    links = _Links(nodes.select("node", "n_shingles", "planes"), sets, similarity, signer)
    roots = _components(members, links)

    placed = profile.join(roots, "node", "left").select(
        "id", "n_shingles", F.coalesce("root", "node").alias("_root")
    )
    # A document without words is alone; its own id spreads those over the tasks of the join.
    lone = F.when(F.col("n_shingles") == 0, F.unhex(F.hex(F.xxhash64("id"))))
    placed = placed.withColumn("_root", F.coalesce("_root", lone))
    placed = materialize(placed, "placed")
    smallest = placed.where("n_shingles > 0").groupBy("_root").agg(F.min("id").alias("_least"))
    # Written, so that the join below shuffles its two sides by itself and can split a hot one.
    smallest = materialize(smallest, "smallest")
    component = F.when(F.col("n_shingles") > 0, F.col("_least")).otherwise(F.col("id"))
    return placed.join(smallest, "_root", "left").select(
        F.col("id").alias(id),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _candidate_sets(
    texts: DataFrame, nodes: DataFrame, members: DataFrame, words: int, bits: int
) -> DataFrame:
    """The shingles of each node in ``members`` (and of some others), from a second look at the
    texts. One document of each node is found by a bitmap of those documents' ids, so no text is
    shuffled. Copies that come along, by a foreign bit or a repeated id, are taken out again."""
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    hashes = wanted.select(F.xxhash64("id").alias("h"))
    bitmap = materialize(bitmap_of(hashes, "h", bits), "bitmap")
    hashed = texts.select("text", F.xxhash64("id").alias("h"))
    chosen = (
        hashed.withColumn("_bitmap_row", bitmap_row(F.col("h"), bits))
        .join(F.broadcast(bitmap), "_bitmap_row")
        .where(bitmap_bit(F.col("h"), F.col("_bitmap")))
        .select("text")
    )
    sets = chosen.mapInArrow(
        lambda batches: _node_sets(batches, words), "node binary, shingles array<bigint>"
    )
    return materialize(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


class _Links:
    """Confirms pairs of nodes: by bit counts first, then on the full sets."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, similarity: float, signer: Signer):
        self.nodes, self.sets, self.signer = nodes, sets, signer
        self.least = Fraction(similarity).limit_denominator(10_000)
        self.floor = least_estimate(similarity, len(signer.flips), signer.kept_bits)

    def possible(self, rest: DataFrame) -> DataFrame:
        """Pairs (``node``, ``other``) of one bucket, in different components, that their sizes
        allow, from the members of undecided buckets (``key``, ``node``, ``root``).

        A shingle that no other of these nodes has cannot be shared. With c others among its n, a
        node is linked only with nodes of c (1 + 1/t) - n shingles at most (t the similarity) and
        t n at least; and parity bits tell in how many shingles two sets differ at least. Sizes are cut into steps, and the larger node of a pair looks into the steps
        that its own numbers allow, so pairs that the numbers rule out are never formed.
        """
        top, bottom = self.least.numerator, self.least.denominator
        wanted = rest.select("node").distinct()
        shingles = self.sets.join(wanted, "node", "left_semi").select(
            "node", F.explode("shingles").alias("shingle")
        )
        own = (
            shingles.groupBy("shingle")
            .agg(F.count("*").alias("n"), F.min("node").alias("node"))
            .where("n = 1")
            .groupBy("node")
            .agg(F.count("*").alias("own"))
        )
        n = F.col("n_shingles")
        common = n - F.coalesce("own", F.lit(0))
        sizes = (
            self.nodes.join(wanted, "node", "left_semi")
            .join(own, "node", "left")
            .select(
                "node",
                n.alias("n"),
                F.ceil(n * top / bottom - 1e-6).alias("least"),
                (F.floor(common * (top + bottom) / top + 1e-6) - n).alias("most"),
                "planes",
            )
            .where("least <= most")
        )
        sizes = materialize(sizes, "sizes")
        keys = rest.groupBy("node").agg(F.collect_set("key").alias("keys"))
        sized = rest.join(sizes.join(keys, "node"), "node")

        def step(size: Column) -> Column:
            return F.floor(F.log(size.cast("double")) / math.log(_STEP))

        reach = F.sequence(step(F.col("least")), step(F.least("n", "most")))
        large = sized.withColumn("step", F.explode(reach))
        small = sized.select(
            "key",
            step(F.col("n")).alias("step"),
            *(F.col(c).alias(f"other{_}") for c, _ in
              (("node", ""), ("root", "_root"), ("n", "_n"), ("most", "_most"), ("keys", "_keys"),
               ("planes", "_planes"))),
        )
        return large.join(small, ["key", "step"]).where(
            "root <> other_root and other_n <= n and other_n between least and most "
            "and n <= other_most and (other_n < n or other < node) "
            # A pair meets in one of the buckets that it shares.
            "and key = array_min(array_intersect(keys, other_keys))"
        ).where(self._may_share(F.col("n") + F.col("other_n"), "planes", "other_planes"))

    def _may_share(self, total: Column, a: str, b: str) -> Column:
        """Whether sets of ``total`` shingles together may be linked by their parity bits: they
        share at most half of what is left of the total without the bits that differ."""
        top, bottom = self.least.numerator, self.least.denominator
        first = -(-len(self.signer.flips) // 64) * self.signer.kept_bits
        differing = F.lit(0)
        for w in range(first, first + _PARITIES // 64):
            differing = differing + F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w]))
        return (total - differing) * (top + bottom) >= total * (2 * top)

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (``a``, ``b``, and other columns) whose similarity is high enough."""
        top, bottom = self.least.numerator, self.least.denominator
        kept = pairs.columns
        for side in "ab":
            columns = [F.col(c).alias(f"{c}_{side}") for c in ("n_shingles", "planes")]
            pairs = pairs.join(self.nodes.select(F.col("node").alias(side), *columns), side)
        small = F.least("n_shingles_a", "n_shingles_b")
        large = F.greatest("n_shingles_a", "n_shingles_b")
        likely = pairs.where(small * bottom >= large * top)
        likely = likely.where(self._may_share(small + large, "planes_a", "planes_b"))
        estimate = estimated_similarity(
            _agreements("planes_a", "planes_b", self.signer),
            len(self.signer.flips),
            self.signer.kept_bits,
        )
        likely = likely.where((small < LEAST_ESTIMATED) | (estimate >= self.floor))
        likely = likely.select(*kept, (small + large).alias("total"))
        for side in "ab":
            one = self.sets.select(
                F.col("node").alias(side), F.col("shingles").alias(f"shingles_{side}")
            )
            # Sizes of the lists escape the estimates of the optimizer: never broadcast them.
            likely = likely.join(one.hint("merge"), side)
        common = F.size(F.array_intersect("shingles_a", "shingles_b"))
        return (
            likely.withColumn("common", common)
            .where(F.col("common") * bottom >= (F.col("total") - F.col("common")) * top)
            .select(*kept)
        )


def _agreements(a: str, b: str, signer: Signer):
    """In how many minima the kept bits agree: bit counts over the bit planes."""
    words = -(-len(signer.flips) // 64)
    differing = F.lit(0)
    for w in range(words):
        differs = F.lit(0).cast("bigint")
        for bit in range(signer.kept_bits):
            at = bit * words + w
            differs = differs.bitwiseOR(F.col(a)[at].bitwiseXOR(F.col(b)[at]))
        differing = differing + F.bit_count(differs)
    return F.lit(len(signer.flips)) - differing


def least_estimate(similarity: float, minima: int, kept_bits: int) -> float:
    """The estimate below which a pair is given up: five standard deviations of the estimate below
    ``similarity``."""
    chance = 0.5**kept_bits
    agree = similarity + (1 - similarity) * chance
    return similarity - 5 * math.sqrt(agree * (1 - agree) / minima) / (1 - chance)


def estimated_similarity(agreements, minima: int, kept_bits: int):
    """Similarity by agreeing minima, corrected for agreement by chance."""
    chance = 0.5**kept_bits
    return (agreements / minima - chance) / (1 - chance)


def _components(members: DataFrame, links: _Links) -> DataFrame:
    """``node`` and ``root`` of all linked nodes, from the buckets' members (``key``, ``node``).

    A round's links join components, not nodes: their roots are connected, and the result replaces
    the roots in the buckets that go on and in what was found before.
    """
    empty = members.sparkSession.createDataFrame([], "node binary, root binary")
    roots = empty
    going = members.select("key", "node", F.col("node").alias("root"))
    for turn in range(STAR_ROUNDS + 1):
        hubs = (
            going.groupBy("key")
            .agg(
                F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "root")).alias("hub"),
                F.min("root").alias("lo"),
                F.max("root").alias("hi"),
            )
            .where("lo <> hi")
            .select("key", F.col("hub.node").alias("other"), F.col("hub.root").alias("other_root"))
        )
        hubs, undecided = materialize_counted(hubs, "hubs")
        if not undecided:
            break
        going = materialize(going.join(hubs, "key"), "undecided")
        rest = going.select("key", "node", "root")
        met = going.where("root <> other_root") if turn < STAR_ROUNDS else links.possible(rest)
        one, other = F.struct("node", "root"), F.struct(
            F.col("other").alias("node"), F.col("other_root").alias("root")
        )
        pairs = met.select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y"))
        pairs = pairs.distinct().select(
            F.col("x.node").alias("a"), F.col("y.node").alias("b"),
            F.col("x.root").alias("root_a"), F.col("y.root").alias("root_b"),
        )
        found, count = materialize_counted(links.confirmed(pairs), "links")
        going = rest
        if count:
            joined = found.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            merged = connected_components(joined.distinct())
            roots = materialize(_replaced(roots, merged).union(
                merged.join(roots.select("node"), "node", "left_anti")
            ), "merged")
            going = _replaced(rest, merged)
    return roots


def _replaced(rooted: DataFrame, merged: DataFrame) -> DataFrame:
    """``rooted`` with its roots replaced by those that ``merged`` gives them."""
    new = merged.select(F.col("node").alias("root"), F.col("root").alias("_new"))
    columns = [F.coalesce("_new", "root").alias("root") if c == "root" else c for c in rooted.columns]
    return rooted.join(new, "root", "left").select(*columns)


def keep_one(
    docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = 0.8, **options
) -> DataFrame:
    """The rows of ``docs`` without all but one of linked documents, columns as they were."""
    keyed, key = with_row_key(docs, id)
    decided = near_duplicates(keyed, key, text, similarity, **options)
    return without_rows(keyed, decided.where("not kept").select(key), key).select(*docs.columns)
