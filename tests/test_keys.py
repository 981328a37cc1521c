"""Surrogate keys: equal to a global row number, balanced under copies and NULLs."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from autostrata.operators import dense_key, keys, range_key
from autostrata.staging import materialize, stored_bytes


def _global_numbers(df, name, order):
    ties = [c for c in df.columns if c not in order]
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order, *ties)))


def _rows(df):
    return sorted((tuple((v is not None, str(v)) for v in r) for r in df.collect()))


def test_range_key_equals_global_row_number(spark):
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 17).alias("a"),
        F.hash("id").alias("b"),
        F.concat(F.lit("x"), F.col("id")).alias("c"),
    )
    got = range_key(df, "n", ["a", "b"])
    assert dict(got.dtypes)["n"] == "bigint"
    assert _rows(got) == _rows(_global_numbers(df, "n", ["a", "b"]))


def test_copies_of_one_row_are_spread_over_ranges(spark, monkeypatch):
    """Half of all rows are copies of one row; no range may hold them all."""
    staged = []
    monkeypatch.setattr(
        keys, "materialize", lambda df, label: staged.append(materialize(df, label)) or staged[-1]
    )
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("a")
    )
    # Small test ranges would be merged into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = range_key(df, "n", ["a"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert _rows(got) == _rows(_global_numbers(df, "n", ["a"]))
    sizes = staged[-1].groupBy(F.shiftright("_place", 33).alias("r")).count().collect()
    assert max(r["count"] for r in sizes) < 15_000


def test_dense_key_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([(1, 4), (1, 2), (1, 3), (1, 5), (None, 9)], "a int, b int")
    numbered = dense_key(df, "n", ["a"])
    assert dict(numbered.dtypes)["n"] == "int"
    assert {r.b: r.n for r in numbered.collect()} == {9: 1, 2: 2, 3: 3, 4: 4, 5: 5}


def test_rows_are_written_once_and_counted_from_footers(spark, monkeypatch):
    df = spark.range(5_000).select(F.hash("id").alias("a"), F.lit("x" * 100).alias("b"))
    written = []
    monkeypatch.setattr(
        keys, "materialize", lambda df, label: written.append(materialize(df, label)) or written[-1]
    )
    numbered = range_key(df, "n", ["a"])
    assert len(written) == 1
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    counting = plan.split("BroadcastExchange")[1]
    assert "ReadSchema: struct<>" in counting
    assert numbered.count() == 5_000 and numbered.agg(F.max("n")).first()[0] == 5_000


def test_stored_bytes_of_a_copy(spark):
    copy = materialize(spark.range(10_000), "sized")
    files = copy.select("_metadata.file_path", "_metadata.file_size").distinct()
    assert stored_bytes(copy) == files.agg(F.sum("file_size")).first()[0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.none() | st.integers(0, 3), st.none() | st.sampled_from(["", "a", "É", "Z"])),
        max_size=40,
    )
)
def test_range_key_property(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string").repartition(3)
    assert _rows(range_key(df, "n", ["b"])) == _rows(_global_numbers(df, "n", ["b"]))
