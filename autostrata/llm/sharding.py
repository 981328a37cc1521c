"""Shards by balanced label propagation: linked documents move to where their neighbours are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autostrata.llm.common import whole
from autostrata.staging import materialize, materialize_counted

ROUNDS = 10
# Movers of one pair of shards and one class of gain are admitted by whole slices.
SLICES = 64
# Rows that one task numbers, on average.
STRETCH = 200_000


def propagate(
    nodes: DataFrame, edges: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS
) -> DataFrame:
    """``node`` and ``shard`` for each of ``nodes`` (``node``), few of ``edges`` (``a``, ``b``) cut.

    Nodes start spread by hash. In each round every node learns, by a join over its edges, how
    many neighbours each shard has, and asks to move to the shard with most of them if that is
    more than its own has. Requests are granted under quotas: between two shards as many may move
    one way as the other, and a shard takes more only up to ``capacity`` nodes. Of the requests
    for one move those with the most to gain go first, slice by slice of their hash. Half of the
    nodes, another half each round, keep still, lest two neighbours trade places for ever.

    Propagation fills no shard beyond ``capacity``. Only sums of requests are planned in one
    place, at most shards² rows; a node with any number of edges is counted in each task before
    the shuffle.
    """
    start = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    placed = materialize(nodes.select("node", start.alias("shard")), "placed")
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")), "edges")
    for turn in range(rounds):
        asks = materialize(_requests(placed, both, turn), "asks")
        granted = materialize(_granted(asks, _quotas(placed, asks, shards, capacity)), "granted")
        moves = asks.join(granted, ["shard", "target", "worth", "slice"], "left_semi")
        moved = placed.join(moves.select("node", "target"), "node", "left")
        placed = materialize(
            moved.select("node", F.coalesce("target", "shard").alias("shard")), "placed"
        )
    return placed


def _requests(placed: DataFrame, both: DataFrame, turn: int) -> DataFrame:
    """Who wants to move where. ``worth`` is the class of gain, by powers of two."""
    at = placed.select(F.col("node").alias("b"), F.col("shard").alias("there"))
    votes = both.join(at, "b").groupBy("a", "there").agg(F.count("*").alias("votes"))
    votes = votes.select(F.col("a").alias("node"), "there", "votes").join(placed, "node")
    here = F.max(F.when(F.col("there") == F.col("shard"), F.col("votes")))
    best = F.max(F.struct("votes", (-F.col("there")).alias("there")))  # ties: the smaller shard
    summed = votes.groupBy("node", "shard").agg(
        best.alias("best"), F.coalesce(here, F.lit(0)).alias("own")
    )
    gain = F.col("best.votes") - F.col("own")
    stirring = F.pmod(F.xxhash64("node", F.lit("turn"), F.lit(turn)), F.lit(2)) == 0
    return summed.where((gain > 0) & stirring).select(
        "node",
        "shard",
        (-F.col("best.there")).alias("target"),
        F.floor(F.log2(gain)).alias("worth"),
        F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(SLICES)).alias("slice"),
    )


def _quotas(placed: DataFrame, asks: DataFrame, shards: int, capacity: int) -> DataFrame:
    """How many may move from ``shard`` to ``target``."""
    size = dict(placed.groupBy("shard").count().collect())
    demand = {(i, j): n for i, j, n in asks.groupBy("shard", "target").count().collect()}
    swapped = {(i, j): min(n, demand.get((j, i), 0)) for (i, j), n in demand.items()}
    more = {pair: n - swapped[pair] for pair, n in demand.items()}
    rows = []
    for (i, j), n in swapped.items():
        wanted = sum(m for (_, to), m in more.items() if to == j)
        free = max(0, capacity - size.get(j, 0))
        rows.append((i, j, n + (min(more[i, j], free * more[i, j] // wanted) if wanted else 0)))
    return placed.sparkSession.createDataFrame(rows, "shard int, target int, quota bigint")


def _granted(asks: DataFrame, quotas: DataFrame) -> DataFrame:
    """The slices of requests that go through, those of most worth first."""
    sums = asks.groupBy("shard", "target", "worth", "slice").agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard", "target").orderBy(F.desc("worth"), "slice")
    return (
        sums.withColumn("moving", F.sum("n").over(order))
        .join(quotas, ["shard", "target"])
        .where("moving <= quota")
        .select("shard", "target", "worth", "slice")
    )


def _numbered(df: DataFrame, rows: int, row: str, group: str) -> DataFrame:
    """Add ``number``, gapless from 0 in each ``group``, without a group being in one task.

    Rows are dealt into stretches by hash of the unique ``row``; the sizes of the stretches before
    it are added to a row's number in its own.
    """
    stretches = max(1, rows // STRETCH)
    df = df.withColumn("_stretch", F.pmod(F.xxhash64(row), F.lit(stretches)))
    before = Window.partitionBy(group).orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        df.groupBy(group, "_stretch")
        .agg(F.count("*").alias("_n"))
        .select(group, "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy(group, "_stretch").orderBy(row)) - 1
    return (
        df.withColumn("_within", within)
        .join(offsets, [group, "_stretch"])
        .withColumn("number", F.col("_offset") + F.col("_within"))
        .drop("_stretch", "_within", "_offset")
    )


def shard_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = 24
) -> DataFrame:
    """All documents in shards 0 to ``shards`` - 1 whose counts are at most one apart.

    Documents with equal texts are linked, each to the first of its group, and placed by
    ``propagate`` with room for as many rows as a shard may hold; documents without links then
    fill the shards up. A group larger than a shard spreads over several.

    Result: ``id``, ``size`` (UTF-8 bytes of the text and 8), ``text_crc32``, ``shard`` and
    ``slot``, which is gapless from 0 in its shard. NULL texts are empty; rows that repeat an id
    are placed each; other columns are ignored; an empty table gives an empty result.
    """
    content = whole(text)
    rows, total = materialize_counted(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id).alias("id"),
            (F.octet_length(content) + 8).cast("bigint").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.sha2(content, 256).alias("digest"),
        ),
        "rows",
    )
    groups = rows.groupBy("digest").agg(F.min("row").alias("hub"), F.count("*").alias("n"))
    groups = materialize(groups.where("n > 1").select("digest", "hub"), "groups")
    linked = materialize(rows.join(groups, "digest").select("row", "hub"), "linked")
    edges = linked.where("row <> hub").select(F.col("row").alias("a"), F.col("hub").alias("b"))
    placed = propagate(
        linked.select(F.col("row").alias("node")), edges, shards, total // shards
    ).withColumnRenamed("node", "row")

    room = [total // shards + (s < total % shards) for s in range(shards)]
    rooms = F.array(*(F.lit(n).cast("bigint") for n in room))
    settled = _numbered(placed, total, "row", "shard").where(
        F.col("number") < F.element_at(rooms, F.col("shard") + 1)
    )
    settled = materialize(settled.select("row", "shard", F.col("number").alias("slot")), "settled")
    taken = dict(settled.groupBy("shard").count().collect())
    starts, at = [], 0
    for s in range(shards):
        starts.append(at)
        at += room[s] - taken.get(s, 0)

    others = rows.join(settled, "row", "left_anti").select("row", F.lit(0).alias("all"))
    number = F.col("number")
    first = F.array(*(F.lit(n).cast("bigint") for n in starts))
    used = F.array(*(F.lit(taken.get(s, 0)).cast("bigint") for s in range(shards)))
    # The last shard whose first number is not beyond this one; full shards share the next's.
    shard = F.size(F.filter(first, lambda n: n <= number)) - 1
    filled = (
        _numbered(others, total, "row", "all")
        .withColumn("shard", shard)
        .select(
            "row",
            "shard",
            (number - F.element_at(first, F.col("shard") + 1)
             + F.element_at(used, F.col("shard") + 1)).alias("slot"),
        )
    )
    return rows.join(settled.union(filled), "row").select(
        F.col("id").alias(id), "size", "text_crc32", "shard", "slot"
    )
