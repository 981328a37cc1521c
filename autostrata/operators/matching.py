"""Approximate matching of names within a block, by edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_EDITS = 3


def _one_letter_less(word: Column) -> Column:
    """All strings that arise from ``word`` by leaving out one letter."""
    size = F.length(word)
    shorter = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, size)),
    )
    return F.when(size > 0, shorter).otherwise(F.array().cast("array<string>"))


def _deletions(word: Column, count: int) -> Column:
    """``word`` and every string that arises from it by leaving out up to ``count`` letters."""
    level = F.array(word)
    found = level
    for _ in range(count):
        level = F.array_distinct(F.flatten(F.transform(level, _one_letter_less)))
        found = F.concat(found, level)
    return F.array_distinct(found)


def _signatures(df: DataFrame, block: str, name: str, max_distance: int) -> DataFrame:
    variant = F.explode(_deletions(F.col(name), max_distance)).alias("_variant")
    return df.select("*", variant).withColumn("_key", F.xxhash64(block, "_variant")).drop("_variant")


def closest_names(
    names: DataFrame,
    candidates: DataFrame,
    block: str,
    name: str,
    value: str,
    max_distance: int = 2,
) -> DataFrame:
    """The closest candidate of the same block for each name, within ``max_distance`` edits.

    Two names within k edits share a string that arises from each by leaving out at most k
    letters, so an equi-join on those strings finds every such pair. Only names that are close
    anyway meet in the join, however many there are in a block; the exact distance is checked
    afterwards. Ties go to the smaller name, then to the smaller value; ``NULL`` values sort first.
    Names without a candidate in reach are absent from the result. A name has about
    length^``max_distance`` such strings, so distances above ``MOST_EDITS`` are refused.

    ``names`` needs the columns ``block`` and ``name``; ``candidates`` also needs ``value``. The
    result has ``block``, ``name``, ``nm_candidato``, ``value`` and ``nr_distancia``.
    """
    if not 0 <= max_distance <= MOST_EDITS:
        raise ValueError(f"max_distance must be 0 to {MOST_EDITS}")
    wanted = names.select(block, name).distinct()
    offered = candidates.groupBy(block, name).agg(F.min(F.struct(value)).alias("_v"))
    left = _signatures(wanted, block, name, max_distance)
    right = _signatures(offered, block, name, max_distance).select(
        F.col(block).alias("_block"), F.col(name).alias("nm_candidato"), "_v", "_key"
    )
    distance = F.levenshtein(F.col(name), F.col("nm_candidato"), max_distance)
    # Each name has many strings, which size estimates ignore: never broadcast them.
    pairs = (
        left.hint("merge")
        .join(right, "_key")
        .where(F.col(block) == F.col("_block"))
        .withColumn("nr_distancia", distance)
        .where(F.col("nr_distancia") >= 0)
    )
    best = F.min(F.struct("nr_distancia", "nm_candidato", "_v")).alias("_best")
    return (
        pairs.groupBy(block, name)
        .agg(best)
        .select(
            block,
            name,
            "_best.nm_candidato",
            F.col(f"_best._v.{value}").alias(value),
            "_best.nr_distancia",
        )
    )
