"""Best-fit packing of token lists into training sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autostrata.llm.common import whole, with_row_key
from autostrata.staging import materialize_counted

LENGTHS = (512, 1024, 2048, 4096)
# Cost of one sequence beside its tokens, in tokens.
OVERHEAD = 64
# Pieces that are packed together, on average.
POOL = 20_000


@dataclass
class Packer:
    """Variable-capacity best fit for one pool of pieces, which come longest first.

    A piece goes to the open bin with the least room that still holds it, whatever that bin's size.
    If there is none, a bin is opened; in the end each bin shrinks to the smallest permitted length
    that holds its contents. A bin costs its final length and ``overhead``.

    Which length is opened is planned for the whole pool: one for each class of piece sizes (the
    permitted lengths, their halves and thirds bound the classes). The plan of least cost that opens
    a single length is improved class by class, as long as that lowers the cost of the filled
    pool, so a pool never costs more than with its best single length. Where each length is twice
    the one before, that is the largest length: any two bins fit into one of the next length.
    """

    lengths: tuple[int, ...] = LENGTHS
    overhead: int = OVERHEAD
    used: list[int] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    plan: tuple[int, ...] = ()

    def pack(self, pieces: list[int]) -> list[tuple[int, int]]:
        """Bin and offset of each piece. ``pieces`` is sorted, longest first."""
        self.plan = self._planned(pieces)
        places, self.used = self.filled(pieces, self.plan)
        self.size = [self.smallest(n) for n in self.used]
        return places

    def bounds(self) -> list[int]:
        """The largest piece of each class."""
        return sorted({-(-n // part) for n in self.lengths for part in (1, 2, 3)})

    def smallest(self, n: int) -> int:
        return self.lengths[bisect_left(self.lengths, n)]

    def cost(self, pieces: list[int], plan: tuple[int, ...]) -> int:
        used = self.filled(pieces, plan)[1]
        return sum(map(self.smallest, used)) + self.overhead * len(used)

    def _planned(self, pieces: list[int]) -> tuple[int, ...]:
        bounds = self.bounds()
        costs: dict[tuple[int, ...], int] = {}

        def cost(plan: tuple[int, ...]) -> int:
            if plan not in costs:
                costs[plan] = self.cost(pieces, plan)
            return costs[plan]

        single = [tuple(max(n, self.smallest(b)) for b in bounds) for n in self.lengths]
        best = min(single, key=cost)
        present = sorted({bisect_left(bounds, n) for n in pieces}, reverse=True)
        while True:
            before = best
            for i in present:
                own = [n for n in self.lengths if n >= bounds[i]]
                best = min((best, *((*best[:i], n, *best[i + 1 :]) for n in own)), key=cost)
            if best == before:
                return best

    def filled(
        self, pieces: list[int], plan: tuple[int, ...]
    ) -> tuple[list[tuple[int, int]], list[int]]:
        """Bin and offset of each piece, and what each bin holds, if bins are opened by ``plan``."""
        opened: dict[int, int] = {}
        bounds = self.bounds()
        rooms: dict[int, list[int]] = {}
        mask = 0  # the rooms there are, as bits
        places, used, size = [], [], []
        for piece in pieces:
            fitting = mask >> piece << piece
            if fitting:
                room = (fitting & -fitting).bit_length() - 1
                bins = rooms[room]
                bin = bins.pop()
                if not bins:
                    mask &= ~(1 << room)
            else:
                bin = len(used)
                if piece not in opened:
                    opened[piece] = plan[bisect_left(bounds, piece)]
                used.append(0)
                size.append(opened[piece])
            places.append((bin, used[bin]))
            used[bin] += piece
            room = size[bin] - used[bin]
            if room in rooms:
                rooms[room].append(bin)
            else:
                rooms[room] = [bin]
            mask |= 1 << room
        return places, used


def words(text: str) -> Column:
    """The number of words of a text; stands for a tokenizer's count."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+"))


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    tokens: Column | None = None,
    text: str = "text",
    lengths: tuple[int, ...] = LENGTHS,
    overhead: int = OVERHEAD,
    pool: int = POOL,
) -> DataFrame:
    """A row per piece of a document: where it lies in which training sequence.

    ``tokens`` counts a document's tokens (words of ``text`` by default). A document longer than
    the largest length is cut into pieces of that length and a rest; one without tokens (NULL,
    empty) has one piece of length 0 in no bin. Nothing is dropped.

    Pieces are dealt by hash into pools of about ``pool`` pieces, as many as the input asks for,
    and each pool is packed by itself, so no task holds more than its pool. The hash is over id,
    file and position of the row, which stay the same on retries (between runs where the files do), so rows that repeat an id (or
    have none) spread as others do. Within a pool equal lengths go in the order of the id, then of
    file and position.

    Result: ``id``, ``piece`` (from 0), ``first_token``, ``n_tokens``, ``pool``, ``bin`` (from 0
    in its pool), ``bin_offset`` and ``bin_length``. Rows that repeat an id are packed each; other
    columns are ignored; an empty table gives an empty result.
    """
    lengths = tuple(sorted(set(lengths)))
    largest = lengths[-1]
    count = words(text) if tokens is None else tokens
    sized = docs.select(F.col(id).alias("id"), F.coalesce(count, F.lit(0)).cast("bigint").alias("n"))
    keyed, key = with_row_key(sized, "id")
    tie = F.xxhash64(F.col(f"{key}.file"), F.col(f"{key}.row"))
    sized = keyed.select("id", "n", tie.alias("tie"))
    last = F.greatest(F.ceil(F.col("n") / largest) - 1, F.lit(0))
    pieces = sized.select("id", "n", "tie", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        "id",
        F.col("piece").cast("int").alias("piece"),
        (F.col("piece") * largest).alias("first_token"),
        F.least(F.lit(largest), F.col("n") - F.col("piece") * largest).alias("n_tokens"),
        "tie",
    )
    pieces, count = materialize_counted(pieces, "pieces")
    full = pieces.where("n_tokens > 0")
    pools = max(1, -(-count // pool))
    dealt = full.withColumn("pool", F.pmod(F.xxhash64("id", "piece", "tie"), F.lit(pools)))
    kind = T.StructType(
        [
            *full.drop("tie").schema.fields,
            T.StructField("pool", T.LongType()),
            T.StructField("bin", T.IntegerType()),
            T.StructField("bin_offset", T.IntegerType()),
            T.StructField("bin_length", T.IntegerType()),
        ]
    )

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("n_tokens", "descending"), ("id", "ascending"), ("piece", "ascending"), ("tie", "ascending")]
        )
        packer = Packer(lengths, overhead)
        places = packer.pack(table.column("n_tokens").to_pylist())
        found = {
            "bin": [b for b, _ in places],
            "bin_offset": [o for _, o in places],
            "bin_length": [packer.size[b] for b, _ in places],
        }
        for name, values in found.items():
            table = table.append_column(name, pa.array(values, pa.int32()))
        return table.select([f.name for f in kind])

    empty = pieces.where("n_tokens = 0").select(
        *full.drop("tie").columns,
        *(F.lit(None).cast(t).alias(c) for c, t in
          (("pool", "bigint"), ("bin", "int"), ("bin_offset", "int"), ("bin_length", "int"))),
    )
    return dealt.groupBy("pool").applyInArrow(packed, kind).union(empty).withColumnRenamed("id", id)
