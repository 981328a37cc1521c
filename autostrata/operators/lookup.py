"""Lookup sides for left joins that must not multiply rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct combinations of ``columns``, as a base for costly expressions on them.

    A filter on an expression over plain ``distinct()`` columns is moved below the aggregation by
    the optimizer, even one it infers from a later join, and then the expression runs for every
    row. Here the columns depend on the group's count, so such filters stay above it and the
    expression runs once per value.
    """
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return counted.select(*(F.when(F.col("_n") > 0, F.col(c)).alias(c) for c in columns))


def unique_lookup(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key with its values; the query fails if a key occurs twice.

    A left join with the result keeps the row count of its left side. Rows with a NULL key are
    left out, since they can never match. The check runs inside the plan, on the lookup side only,
    and belongs to the key, so it runs whichever values are asked for.
    """
    single = (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("_n"), *(F.min(v).alias(v) for v in values))
    )
    message = F.concat(
        F.lit(f"lookup key ({', '.join(keys)}) is not unique: "), F.to_json(F.struct(*keys))
    )
    first = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(keys[0]))
    return single.select(first.alias(keys[0]), *keys[1:], *values)
