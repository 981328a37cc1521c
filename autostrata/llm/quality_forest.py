"""Quality rules on documents: rule statistics, fixed rules, and an isolation forest on the statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autostrata.llm.common import whole
from autostrata.operators.keys import range_key
from autostrata.staging import materialize

# Fixed rules: fewer words, or a larger percentage of words in repeated windows, fails.
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8

# Isolation trees, and the rows that the splits of one are drawn from: random ones of all.
TREES = 200
TREE_ROWS = 256
SEED = 13

# Share of the labelled good rows that the threshold may reject.
MOST_LOST = 0.01

SYMBOLS = "#*$%&|<>"

STATISTICS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_upper bigint, n_marks bigint, n_distinct bigint"
)
_COUNTS = [field.split()[0] for field in STATISTICS.split(", ")]


# --- statistics ----------------------------------------------------------------------------


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text and with counts of the whole text, NULL counting as empty.

    Words stand between the six ASCII blanks. ``word_chars`` are their characters, ``n_symbols``
    those of ``SYMBOLS``; ``n_dup_lines`` are lines with a word that equal an earlier one;
    ``n_repeat_words`` are words in stretches of ``WINDOW`` words that occur twice or more, the
    first time included. Further: upper-case letters and marks (neither letter nor digit), both of
    ASCII, and different words. Columns named like results are replaced.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in {*_COUNTS, text, "_counts"}]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([_counted(value) for value in texts], columns=_COUNTS)

    counts = F.pandas_udf(run, STATISTICS)(whole(text)).alias("_counts")
    return docs.select(*others, counts).select(*others, "_counts.*")


_SYMBOL_TABLE = dict.fromkeys(map(ord, SYMBOLS))


def _counted(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.encode().split()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    joined = b"".join(words).decode()
    letters = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ascii_letter = ((letters | 32) >= 97) & ((letters | 32) <= 122)
    digit = (letters >= 48) & (letters <= 57)
    return (
        len(words),
        len(joined),
        len(text) - len(text.translate(_SYMBOL_TABLE)),
        len(lines) - len(set(lines)),
        _repeated(ids, WINDOW),
        int(np.count_nonzero(ascii_letter & (letters < 97))),
        int(np.count_nonzero(~ascii_letter & ~digit & (letters < 128))),
        len(number),
    )


def _repeated(ids: np.ndarray, size: int) -> int:
    """Places in windows of ``size`` (a power of two) ids that occur twice or more.

    Windows are numbered by doubling: two windows are equal if both their halves are.
    """
    n = len(ids)
    if n <= size:
        return 0
    span = 1
    while span < size:
        halves = ids[:-span] * (int(ids.max()) + 1) + ids[span:]
        ids = np.unique(halves, return_inverse=True)[1]
        span *= 2
    places = np.flatnonzero(np.bincount(ids)[ids] > 1)
    edges = np.zeros(n + 1, np.int64)
    edges[places] += 1
    edges[places + size] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def base_failed() -> Column:
    """Whether the fixed rules reject a row of ``statistics``."""
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeated


# --- forest --------------------------------------------------------------------------------


def _features(counts: pd.DataFrame) -> np.ndarray:
    """Rates per word or character, which don't grow with the length of a text. Equal lines are
    left out: they occur in good texts too, and their words count among the repeated ones."""
    words, chars = (np.maximum(counts[c].to_numpy(float), 1) for c in ("n_words", "word_chars"))
    return np.stack(
        [
            counts["word_chars"] / words,
            counts["n_symbols"] / words,
            counts["n_repeat_words"] / words,
            counts["n_upper"] / chars,
            counts["n_marks"] / chars,
            np.log1p(counts["n_distinct"]) / np.log1p(words),
        ],
        axis=1,
    )


class Forest(NamedTuple):
    """Isolation trees in arrays (tree by node), and the score above which a row is anomalous.

    Inner nodes send smaller values of ``feature`` to the child ``2 * node + 1``. A leaf has
    feature -1 and the length of paths that end there, which counts for those that its rows would
    have gone on.
    """

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    threshold: float

    def leaves(self, features: np.ndarray) -> Iterator[np.ndarray]:
        """Tree by tree the leaf of each row."""
        rows = np.arange(len(features))
        for feature, split in zip(self.feature, self.split):
            node = np.zeros(len(features), np.int64)
            inner = rows[feature[node] >= 0]
            while len(inner):
                at = node[inner]
                higher = features[inner, feature[at]] >= split[at]
                node[inner] = 2 * at + 1 + higher
                inner = inner[feature[node[inner]] >= 0]
            yield node

    def scores(self, features: np.ndarray) -> np.ndarray:
        """From 0 to 1; short paths, that is high scores, are those of rows unlike the others."""
        total = np.zeros(len(features))
        for path, node in zip(self.path, self.leaves(features)):
            total += path[node]
        return 2.0 ** (-total / max(len(self.feature), 1) / _mean_path(TREE_ROWS))


def _mean_path(rows: float) -> float:
    """Mean length of an unsuccessful search in a random binary tree of so many rows."""
    if rows < 2:
        return 0.0
    return 2 * (math.log(rows - 1) + 0.5772156649015329 if rows > 2 else 0.5) - 2 * (rows - 1) / rows


def grow(features: np.ndarray, trees: int = TREES, seed: int | list[int] = SEED) -> Forest:
    """Isolation trees, each over random rows, split at random values of random features."""
    random = np.random.default_rng(seed)
    height = (TREE_ROWS - 1).bit_length()
    nodes = 2 ** (height + 1) - 1
    feature = np.full((trees, nodes), -1)
    split, path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for tree in range(trees if len(features) else 0):
        chosen = random.choice(len(features), min(TREE_ROWS, len(features)), replace=False)
        open_ = [(0, 0, features[chosen])]
        while open_:
            node, depth, rows = open_.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            varied = np.flatnonzero(low < high)
            if depth == height or not len(varied):
                path[tree, node] = depth + _mean_path(len(rows))
                continue
            by = random.choice(varied)
            at = random.uniform(low[by], high[by])
            at = at if at > low[by] else high[by]  # the interval is closed where it should not be
            feature[tree, node], split[tree, node] = by, at
            higher = rows[:, by] >= at
            open_ += [(2 * node + 1, depth + 1, rows[~higher]), (2 * node + 2, depth + 1, rows[higher])]
    return Forest(feature, split, path, math.inf)


def calibrated(forest: Forest, features: np.ndarray, good: np.ndarray) -> Forest:
    """The forest with the threshold that tells bad rows from good ones best, by the sum of the
    shares judged right, among those that reject at most ``MOST_LOST`` of the good rows. Without
    rows of both kinds nothing is anomalous. ``cutoff`` is the same for a table."""
    if not good.any() or good.all():
        return forest
    scores = forest.scores(features)
    marks = np.unique(scores)
    lost = 1 - np.searchsorted(np.sort(scores[good]), marks, side="right") / good.sum()
    caught = 1 - np.searchsorted(np.sort(scores[~good]), marks, side="right") / (~good).sum()
    worth = np.where(lost <= MOST_LOST, caught - lost, -1.0)
    best = int(np.argmax(worth))
    # Halfway to the next score seen, so that the threshold lies between rows.
    after = marks[min(best + 1, len(marks) - 1)]
    return forest._replace(threshold=float((marks[best] + after) / 2))


def fit(
    counts: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    quality: str = "quality",
    rows: int | None = None,
) -> Forest:
    """A forest and its threshold from all labelled rows of ``statistics``, or from ``rows`` of them.

    Labels (1: good) are looked up by id; rows without one, or whose id or label is NULL, teach
    nothing. The forest is grown without the labels, on rows that pass the fixed rules; these also
    set the threshold. The splits of each tree come from ``TREE_ROWS`` random rows, as the method
    has it, drawn from all; all rows count in the sizes of its leaves and in the threshold. Only
    the trees, those sizes and the threshold reach the driver.
    """
    known = labels.select(F.col(id).alias("_id"), F.col(quality).cast("int").alias("_good")).dropna()
    once = known.groupBy("_id").agg(F.min("_good").alias("_good"))
    taught = (
        counts.where(~base_failed())
        .select(F.col(id).alias("_id"), *_COUNTS)
        .join(once, "_id")
        .select("_good", *_COUNTS, F.xxhash64("_id").alias("_order"))
    )
    if rows is not None:
        taught = taught.orderBy("_order", *_COUNTS).limit(rows)
    taught = range_key(taught, "_number", ["_order", *_COUNTS])
    forest = _sized(_grown(taught), taught)
    scored = taught.select((F.col("_good") == 1).alias("good"), _anomaly(taught, forest).alias("anomaly"))
    return forest._replace(threshold=cutoff(scored))


def _grown(taught: DataFrame) -> Forest:
    """Isolation trees, each grown by a task over random rows of those numbered 1, 2, ..."""
    forest = grow(np.empty((0, 0)))
    n = taught.count()
    if not n:
        return forest
    random = np.random.default_rng(SEED)
    size = min(TREE_ROWS, n)
    chosen = [random.choice(n, size, replace=False) + 1 for _ in range(TREES)]
    draws = pa.table(
        {"tree": np.repeat(np.arange(TREES), size), "_number": np.concatenate(chosen)}
    )

    def run(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        one = grow(_features(part.sort_values("_number")), 1, [SEED, tree])
        return pd.DataFrame({"tree": [tree], "feature": [one.feature[0]], "split": [one.split[0]]})

    # As many draws as the trees take rows, whatever the table's size, hence the broadcast.
    draws = F.broadcast(taught.sparkSession.createDataFrame(draws))
    trees = taught.join(draws, "_number").groupBy("tree")
    for row in trees.applyInPandas(run, "tree int, feature array<int>, split array<double>").collect():
        forest.feature[row.tree], forest.split[row.tree] = row.feature, row.split
    return forest


def _sized(forest: Forest, taught: DataFrame) -> Forest:
    """The forest with path lengths that go by the share of all rows that end at each leaf."""
    shared = taught.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ended = np.zeros(shared.value.feature.shape, np.int64)
        for batch in batches:
            for tree, node in enumerate(shared.value.leaves(_features(batch))):
                ended[tree] += np.bincount(node, minlength=ended.shape[1])
        tree, node = np.nonzero(ended)
        yield pd.DataFrame({"tree": tree, "node": node, "n": ended[tree, node]})

    ended = taught.select(*_COUNTS).mapInPandas(run, "tree int, node int, n bigint")
    sizes = ended.groupBy("tree", "node").agg(F.sum("n").alias("n")).toPandas()
    path = np.zeros(forest.feature.shape)
    rows = sizes.loc[sizes["tree"] == 0, "n"].sum()
    for tree, node, n in sizes.itertuples(index=False):
        depth = (node + 1).bit_length() - 1
        path[tree, node] = depth + _mean_path(n / rows * min(TREE_ROWS, rows))
    return forest._replace(path=path)


def cutoff(scored: DataFrame) -> float:
    """The threshold of ``calibrated`` from a table of ``anomaly`` and ``good`` of any size.

    The different scores are dealt to ranges and sorted there; one row per range tells the others
    how many rows of either kind lie above it, and the least score of the next range.
    """
    good, bad = (F.sum(c.cast("bigint")) for c in (F.col("good"), ~F.col("good")))
    marks = scored.groupBy("anomaly").agg(good.alias("good"), bad.alias("bad"))
    ranges = materialize(marks, "marks").repartitionByRange("anomaly")
    ranges = materialize(ranges.withColumn("range", F.spark_partition_id()), "ranges")
    per_range = ranges.groupBy("range").agg(
        F.sum("good").alias("good_in"), F.sum("bad").alias("bad_in"), F.min("anomaly").alias("least")
    )
    down = Window.orderBy(F.desc("range"))
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    above = per_range.select(
        "range",
        F.coalesce(F.sum("good_in").over(before), F.lit(0)).alias("good_above"),
        F.coalesce(F.sum("bad_in").over(before), F.lit(0)).alias("bad_above"),
        F.lag("least").over(down).alias("after"),
    )
    total = per_range.agg(F.sum("good_in"), F.sum("bad_in")).first()
    if not total[0] or not total[1]:
        return math.inf
    down = Window.partitionBy("range").orderBy(F.desc("anomaly"))
    upto = down.rowsBetween(Window.unboundedPreceding, 0)
    # One row per range, hence the broadcast. Rows at a score itself are not above it.
    lost, caught = (
        1 - (n - (F.col(f"{kind}_above") + F.sum(kind).over(upto) - F.col(kind))) / F.lit(n)
        for kind, n in zip(("good", "bad"), total)
    )
    after = F.coalesce(F.lag("anomaly").over(down), "after", "anomaly")
    judged = ranges.join(F.broadcast(above), "range").select(
        "anomaly", after.alias("after"), lost.alias("lost"), (caught - lost).alias("worth")
    )
    # Halfway to the next score seen, so that the threshold lies between rows.
    best = judged.where(F.col("lost") <= MOST_LOST).orderBy(F.desc("worth"), "anomaly").first()
    return (best["anomaly"] + best["after"]) / 2


def _anomaly(counts: DataFrame, forest: Forest) -> Column:
    """The forest's score of rows of ``statistics``."""
    shared = counts.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            frame = pd.DataFrame(dict(zip(_COUNTS, columns)))
            yield pd.Series(shared.value.scores(_features(frame)))

    return F.pandas_udf(run, "double")(*_COUNTS)


def judge(counts: DataFrame, forest: Forest) -> DataFrame:
    """Rows of ``statistics`` with ``base_failed``, the ``anomaly`` score and ``kept``: not failed
    by the fixed rules and not above the forest's threshold."""
    score = _anomaly(counts, forest)
    others = [F.col(f"`{c}`") for c in counts.columns if c not in ("base_failed", "anomaly", "kept")]
    return counts.select(*others, base_failed().alias("base_failed"), score.alias("anomaly")).select(
        "*", (~F.col("base_failed") & (F.col("anomaly") <= forest.threshold)).alias("kept")
    )


def judge_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id"
) -> DataFrame:
    """``judge`` on whole documents by a forest fitted to all their labelled rows. Texts are read once;
    the counts are written. Empty tables give no rows; without labels only the fixed rules count."""
    counts = materialize(statistics(docs, text), "counts")
    return judge(counts, fit(counts, labels, id))
