"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata.staging import materialize

# A bitmap row of bitmap_construct_agg holds this many bits.
BITMAP_ROW_BITS = 15


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str) -> Column:
    """The text, NULL counting as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def with_row_key(df: DataFrame, id: str) -> tuple[DataFrame, str]:
    """``df`` with a key column that no two rows share, and the column's name.

    The key is the id with the file and position of the row, which stay the same however often
    the files are read. A frame that is no plain scan of files is written first. Keys order as
    their ids do, NULL ids first.
    """
    name = "_row_key"
    while name in df.columns:
        name += "_"
    try:
        return _keyed(df, id, name), name
    except AnalysisException:
        return _keyed(materialize(df, "keyed"), id, name), name


def _keyed(scan: DataFrame, id: str, name: str) -> DataFrame:
    source = scan.metadataColumn("_metadata")
    key = F.struct(
        F.col(id).alias("id"), source["file_path"].alias("file"), source["row_index"].alias("row")
    )
    return scan.select("*", key.alias(name))


def without_rows(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is in ``dropped``, which is written first."""
    return df.join(materialize(dropped, "dropped"), key, "left_anti")


def bitmap_of(keys: DataFrame, hash: str, bits: int) -> DataFrame:
    """A bitmap of 2**bits bits, in rows of 4 KiB: the bits that the 64-bit ``hash`` values set.

    Its size depends on ``bits`` alone, so it may be broadcast. Use ``bitmap_bit`` to test it.
    """
    place = F.pmod(F.col(hash), F.lit(1 << bits))
    return (
        keys.select(place.alias("_place"))
        .groupBy(F.shiftright("_place", BITMAP_ROW_BITS).alias("_bitmap_row"))
        .agg(
            F.bitmap_construct_agg(
                F.col("_place").bitwiseAND((1 << BITMAP_ROW_BITS) - 1)
            ).alias("_bitmap")
        )
    )


def bitmap_row(hash: Column, bits: int) -> Column:
    return F.shiftright(F.pmod(hash, F.lit(1 << bits)), BITMAP_ROW_BITS)


def bitmap_bit(hash: Column, bitmap: Column) -> Column:
    """Whether ``hash`` has its bit set in its bitmap row; false where the row is missing."""
    place = hash.bitwiseAND((1 << BITMAP_ROW_BITS) - 1).cast("int")
    byte = F.conv(
        F.hex(F.substring(bitmap, F.shiftright(place, 3) + 1, F.lit(1))), 16, 10
    ).cast("int")
    bit = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), place.bitwiseAND(7) + 1)
    return F.coalesce(byte.bitwiseAND(bit) > 0, F.lit(False))
