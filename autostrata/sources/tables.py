"""Managed tables: layers, full loads and overwrites."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from autostrata.config import TABLE_FORMAT
from autostrata.staging import materialize


def use_layer(spark: SparkSession, layer: str, catalog: str | None = None) -> None:
    """Create the layer's schema if needed and make it current, optionally in another catalog."""
    if catalog is not None:
        spark.catalog.setCurrentCatalog(catalog)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    spark.catalog.setCurrentDatabase(layer)


def save_table(
    df: DataFrame,
    table: str,
    table_format: str = TABLE_FORMAT,
    path: str | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Overwrite a table, schema included. ``path`` puts an external table there.

    A frame that reads the table it is about to replace is written to the staging folder first.
    """
    try:
        _overwrite(df, table, table_format, path, partition_by)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNSUPPORTED_OVERWRITE"):
            raise
        _overwrite(materialize(df, "overwrite"), table, table_format, path, partition_by)


def _overwrite(
    df: DataFrame,
    table: str,
    table_format: str,
    path: str | None,
    partition_by: list[str] | None,
) -> None:
    writer = df.write.format(table_format).mode("overwrite").option("overwriteSchema", "true")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


# Suffixes of a table that is being loaded and of the one it replaces, while a load runs.
_FRESH, _ASIDE = "__carga", "__anterior"


def full_load(
    df: DataFrame, table: str, table_format: str = TABLE_FORMAT, path: str | None = None
) -> DataFrame:
    """Create the table anew from ``df``, whatever it was before, and return a scan of it.

    The rows are written once, to a table beside the old one, and the two swap names when all is
    written. So ``df`` may read the table itself, a load that fails leaves the old table as it is,
    and one that fails between the two renamings puts it back. If the driver dies there, the next
    load (or ``recover_load``) does. ``path`` makes the table an external one, in a new folder
    below it; the folders of earlier loads are deleted after the swap.
    """
    spark = df.sparkSession
    recover_load(spark, table)
    fresh, aside = table + _FRESH, table + _ASIDE
    folder = None if path is None else f"{path.rstrip('/')}/carga-{uuid.uuid4().hex}"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    try:
        _overwrite(df, fresh, table_format, folder, None)
        replaced = spark.catalog.tableExists(table)
        if replaced:
            _rename(spark, table, aside)
        _rename(spark, fresh, table)
    except BaseException:
        recover_load(spark, table)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    if path is not None:
        _delete_other_loads(spark, path, folder)
    return spark.table(table)


def recover_load(spark: SparkSession, table: str) -> None:
    """Undo what a load of the table left unfinished: the old table gets its name back, a half
    written one goes."""
    aside = table + _ASIDE
    if spark.catalog.tableExists(aside):
        if spark.catalog.tableExists(table):
            spark.sql(f"DROP TABLE {aside}")
        else:
            _rename(spark, aside, table)
    spark.sql(f"DROP TABLE IF EXISTS {table + _FRESH}")


def _rename(spark: SparkSession, table: str, name: str) -> None:
    # A new name is given within the table's catalog.
    spark.sql(f"ALTER TABLE {table} RENAME TO {'.'.join(name.split('.')[-2:])}")


def _delete_other_loads(spark: SparkSession, path: str, current: str) -> None:
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(context._jsc.hadoopConfiguration())
    for status in fs.globStatus(hadoop.Path(path, "carga-*")):
        if status.getPath().getName() != current.rsplit("/", 1)[-1]:
            fs.delete(status.getPath(), True)
