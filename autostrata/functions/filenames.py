"""Facts carried by file names: reference month, and the local name of a linked file."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from autostrata.functions.text import strip_accents

# A monthly file's name without accents ends in the month's name, the year and the suffix.
FILE_DATE_PATTERN = r"_([A-Za-z]+)_(\d{4})\.xlsx$"


def percent_decoded(name: Column) -> Column:
    """The name with percent signs decoded and nothing else; as it is if that fails."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def file_date_parts(name: Column | str) -> tuple[Column, Column]:
    """Month word (upper case, no accents) and year (int) in a file name, NULL where absent.

    The name is percent-decoded and stripped of accents first, so an encoded, decomposed or
    upper-case ``Março`` is recognized as well. A name that cannot be decoded is taken as it is.
    """
    raw = F.col(name) if isinstance(name, str) else name
    clean = strip_accents(percent_decoded(raw))
    word = F.nullif(F.regexp_extract(clean, FILE_DATE_PATTERN, 1), F.lit(""))
    year = F.nullif(F.regexp_extract(clean, FILE_DATE_PATTERN, 2), F.lit(""))
    return F.upper(word), year.cast("int")


def link_file_name(href: Column, position: Column) -> Column:
    """Last path segment of a link, or ``combustivel_<position>.xlsx`` if it is no spreadsheet."""
    segment = F.element_at(F.split(href, "/"), -1)
    fallback = F.concat(F.lit("combustivel_"), position.cast("string"), F.lit(".xlsx"))
    return F.when(F.endswith(segment, F.lit(".xlsx")), segment).otherwise(fallback)
