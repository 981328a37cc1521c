"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

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
from autostrata.staging import materialize

PREFIX_LETTERS = 256
FILTER_BITS = 26


def exact_groups(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    carry: dict[str, Column] | None = None,
    prefix_letters: int = PREFIX_LETTERS,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The group of equal texts of each row: ``id``, ``keep_id``, ``group_size``, ``kept``.

    Rows are grouped by length in bytes; those whose length is not alone by the hash of their
    first ``prefix_letters`` letters; and only rows that still share both are hashed in full
    (SHA-256, taken as equality). No text is shuffled: the surviving pairs of length and prefix
    hash set bits of a bitmap of fixed size (2**filter_bits bits, 8 MiB by default), which goes to
    every task; a bit set by chance costs one hash and changes nothing. Copies are counted in each
    task before they meet, so the largest group may be any share of the rows.

    The row with the largest id stays. Ids may be of any orderable type. NULL texts equal the
    empty text; NULL ids are smaller than all others; rows that repeat an id and its text have the
    same ``kept`` (give ids made by ``with_row_key`` to keep just one of them). An empty table
    gives an empty result. Other columns of ``docs`` are ignored; ``carry`` adds columns, given as
    expressions over ``docs``, to each row.
    """
    carry = carry or {}
    content = whole(text)
    length = F.octet_length(content).alias("_length")
    prefix = F.xxhash64(F.substring(content, 1, prefix_letters)).alias("_prefix")

    profile = materialize(docs.select(length, prefix), "profile")
    lengths = profile.groupBy("_length").agg(F.count("*").alias("_n")).where("_n > 1")
    # Written, so that the semi join shuffles its two sides by itself and can split a hot length.
    lengths = materialize(lengths.select("_length"), "lengths")
    suspects = (
        profile.join(lengths, "_length", "left_semi")
        .groupBy("_length", "_prefix")
        .agg(F.count("*").alias("_n"))
        .where("_n > 1")
        .select(F.xxhash64("_length", "_prefix").alias("_hash"))
    )
    bitmap = materialize(bitmap_of(suspects, "_hash", filter_bits), "bitmap")

    rows = docs.select(
        F.col(id).alias("_id"),
        length,
        prefix,
        content.alias("_content"),
        *(value.alias(f"_carry_{name}") for name, value in carry.items()),
    ).withColumn("_hash", F.xxhash64("_length", "_prefix"))
    rows = rows.withColumn("_bitmap_row", bitmap_row(F.col("_hash"), filter_bits))
    refined = materialize(
        rows.join(F.broadcast(bitmap), "_bitmap_row", "left").select(
            "_id",
            # A row that is alone by now has a key of its own, which also spreads the join below.
            F.when(bitmap_bit(F.col("_hash"), F.col("_bitmap")), F.sha2("_content", 256))
            .otherwise(F.concat_ws("/", "_length", "_prefix"))
            .alias("_key"),
            *(f"_carry_{name}" for name in carry),
        ),
        "refined",
    )
    groups = (
        refined.groupBy("_key")
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_n"))
        .where("_n > 1")
    )
    # Written, so that the join below shuffles its two sides by itself and can split a hot one.
    groups = materialize(groups, "groups")
    keep = F.when(F.col("_n").isNotNull(), F.col("_keep")).otherwise(F.col("_id"))
    return refined.join(groups, "_key", "left").select(
        F.col("_id").alias(id),
        keep.alias("keep_id"),
        F.coalesce("_n", F.lit(1)).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        *(F.col(f"_carry_{name}").alias(name) for name in carry),
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without all but one of equal texts, columns as they were."""
    keyed, key = with_row_key(docs, id)
    dropped = exact_groups(keyed, key, text, **options).where("not kept").select(key)
    return without_rows(keyed, dropped, key).select(*docs.columns)
