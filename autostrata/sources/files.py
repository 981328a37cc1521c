"""Delimited source files: declared schemas, provenance, yearly layout."""

from __future__ import annotations

import re
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata.functions.filenames import percent_decoded

# Column names and types of the two raw tables.
FLEET_SCHEMA = (
    "nm_uf string, nm_municipio string, nm_combustivel string, qtd_veiculos int, nm_file string"
)
MUNICIPALITY_SCHEMA = (
    "id_municipio int, cd_municipio string, nm_municipio_upper string, "
    "nm_municipio_formatted string, sigla_uf string"
)

FLEET_COLUMNS = [field.split()[0] for field in FLEET_SCHEMA.split(", ")]

Paths = str | list[str]


def _delimited(
    spark: SparkSession,
    paths: Paths,
    schema: str,
    malformed: str | None = None,
    check_header: bool = False,
    **options: str,
) -> DataFrame:
    reader = spark.read.options(
        header="true", enforceSchema="false" if check_header else "true", **options
    )
    if malformed:
        schema = f"{schema}, {malformed} string"
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    return reader.schema(schema).csv(paths)


def read_fleet(
    spark: SparkSession, paths: Paths, malformed: str | None = None, check_header: bool = False
) -> DataFrame:
    """Fleet CSV files: comma, UTF-8, header line, five declared columns taken by position.

    A field that is no integer becomes NULL, as does an empty one; short lines are padded with
    NULL. Name a column in ``malformed`` to get the text of every line that does not fit the
    schema (wrong number of fields, unreadable number), so that it can be checked before a load.
    ``check_header=True`` fails on a file whose header is not the declared names in their order.
    """
    return _delimited(
        spark, paths, FLEET_SCHEMA, malformed, check_header, sep=",", encoding="UTF-8"
    )


def read_municipalities(
    spark: SparkSession, paths: Paths, malformed: str | None = None, check_header: bool = False
) -> DataFrame:
    """Municipality CSV of the revenue office: semicolon, ISO-8859-1, header line.

    Fields and options are treated as in ``read_fleet``.
    """
    return _delimited(
        spark, paths, MUNICIPALITY_SCHEMA, malformed, check_header, sep=";", encoding="ISO-8859-1"
    )


def rejected_lines(lines: DataFrame, malformed: str) -> DataFrame:
    """Lines that do not fit the schema, of a frame read with a ``malformed`` column: the file they
    are in as ``nm_arquivo``, what could be read of them, and their text."""
    file = percent_decoded(F.col("_metadata.file_name")).alias("nm_arquivo")
    return lines.where(F.col(malformed).isNotNull()).select(file, "*")


def consolidate(
    spark: SparkSession,
    layouts: list[Paths],
    provenance: str = "nm_file",
    year: str | None = None,
) -> DataFrame:
    """One frame from CSV files with differing headers, columns aligned by name.

    Each entry of ``layouts`` (a path, glob or list of paths) holds the files that share a header
    and is read in one scan, however many files it matches; a file with another header than the
    first of its layout fails the query instead of shifting columns. Columns missing in a layout
    are NULL. All columns are strings. ``provenance`` is the plain name of the file a row comes
    from, and ``year``, on request, the number its folder is named by.
    """
    origin = [percent_decoded(F.col("_metadata.file_name")).alias(provenance)]
    if year is not None:
        folder = F.regexp_extract("_metadata.file_path", r"/(\d+)/[^/]*$", 1)
        origin.append(F.nullif(folder, F.lit("")).cast("int").alias(year))
    scans = [
        spark.read.options(header="true", enforceSchema="false").csv(paths).select("*", *origin)
        for paths in layouts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def file_headers(
    spark: SparkSession, root: str, years: list[int] | None = None, suffix: str = ".csv"
) -> DataFrame:
    """``path``, ``nr_ano`` and ``header`` (first line) of the files below ``root`` that end in
    ``suffix`` and lie in folders whose whole name is a number, of the listed years if given.

    One pass over the files, however many there are: the task that reads the beginning of a file
    keeps its first line. Files of other years and other names are not opened. Files without a
    line are absent.
    """
    path = percent_decoded(F.col("_metadata.file_path"))
    year = F.regexp_extract("_metadata.file_path", r"/(\d+)/[^/]*$", 1)
    lines = (
        spark.read.options(recursiveFileLookup="true", pathGlobFilter=f"*{suffix}")
        .text(root)
        .where((year != "") & (F.col("_metadata.file_block_start") == 0))
    )
    if years is not None:
        # A folder's name may have leading zeros.
        lines = lines.where(F.regexp_replace(year, "^0+", "").isin([str(y) for y in years]))
    placed = lines.select(
        path.alias("path"),
        year.try_cast("int").alias("nr_ano"),
        "value",
        F.monotonically_increasing_id().alias("_place"),
    )
    return placed.groupBy("path", "nr_ano").agg(F.min_by("value", "_place").alias("header"))


def yearly_layouts(
    spark: SparkSession, root: str, years: list[int] | None = None, suffix: str = ".csv"
) -> list[list[str]]:
    """The files of ``file_headers`` in groups that share a header, for ``consolidate``.

    Years without a folder or without files are left out. The driver sees paths and one line of
    each file, no data.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for path, _, header in sorted(file_headers(spark, root, years, suffix).collect()):
        groups[header].append(re.sub(r"([\[\]{}*?\\])", r"\\\1", path))
    return list(groups.values())


def select_years(df: DataFrame, years: list[int] | None = None, year: str = "nr_ano") -> DataFrame:
    """Rows of the listed years, or all rows. On a frame laid out by year only those are read."""
    return df if years is None else df.where(F.col(year).isin(years))


def write_yearly(
    df: DataFrame, path: str, year: str = "nr_ano", columns: list[str] | None = FLEET_COLUMNS
) -> None:
    """CSV output with one folder per year; by default the fleet columns in the declared order.

    The years in ``df`` replace what the output has of them; other years stay. Rows are rebalanced
    by year first: small years share tasks and a large year is split over many, so there are
    neither tiny files nor one task writing a whole year.
    """
    chosen = df if columns is None else df.select(*columns, year)
    (
        chosen.hint("rebalance", year)
        .write.mode("overwrite")
        .partitionBy(year)
        .options(header="true", encoding="UTF-8", partitionOverwriteMode="dynamic")
        .csv(path)
    )


def read_yearly(
    spark: SparkSession, path: str, years: list[int] | None = None, year: str = "nr_ano"
) -> DataFrame:
    """Fleet rows of a yearly CSV layout; folders outside ``years`` are not listed for reading."""
    frame = _delimited(spark, path, f"{FLEET_SCHEMA}, {year} int", sep=",", encoding="UTF-8")
    return select_years(frame, years, year)
