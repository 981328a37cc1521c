"""Surrogate keys: dense numbers 1..n in the order of given columns (NULLs first)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autostrata.staging import materialize

# monotonically_increasing_id: partition number above this bit, row number in the partition below.
_ROW_BITS = 33


def dense_key(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Add ``name`` (int) to a dimension, numbered as by ``range_key``."""
    return range_key(df, name, order).withColumn(name, F.col(name).cast("int"))


def range_key(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Add ``name`` (bigint) to a frame of any size; no task sees more than its own range.

    The rows are range-partitioned, sorted and written once, each with its place in its range. The
    number of rows before each range comes from the row counts in the footers of that copy and is
    joined in: one short row per range. Columns outside ``order`` break ties, so the numbering does
    not depend on how the rows were distributed.

    Copies of one row may be any share of all rows, so they must not have to share a range: the
    last part of the range key is the partition a row comes from, which, unlike its place there,
    stays the same when a lost task is repeated. There are as many ranges as the session has
    shuffle partitions, fewer where adaptive execution merges small ones. The ranges are found by
    sampling ``df``, which is evaluated twice; write it first if that is costly.
    """
    columns = df.columns
    sort = order + [c for c in columns if c not in order] + ["_origin"]
    placed = (
        df.withColumn("_origin", F.spark_partition_id())
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select(*columns, F.monotonically_increasing_id().alias("_place"))
    )
    staged = materialize(placed, "ranges")
    # A file is named by the number of the task that wrote it, which is that of its range.
    files = staged.groupBy("_metadata.file_name").agg(F.count("*").alias("_rows"))
    task = F.regexp_extract("file_name", r"^part-(\d+)", 1).cast("long").alias("_range")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        files.groupBy(task)
        .agg(F.sum("_rows").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    in_range = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    numbered = staged.withColumn("_range", F.shiftright("_place", _ROW_BITS))
    # One row per range, hence the broadcast.
    return numbered.join(F.broadcast(offsets), "_range").select(
        *columns, (F.col("_offset") + in_range + 1).alias(name)
    )
