"""The raw layer in terms of the test tables.

A supplier plays a municipality, its nation key one of the states, brand and size of a part its
fuel type, and a month of shipments one monthly file; the quantity shipped is the vehicle count.
Account balances decide where the municipality list is flawed: a negative one means no code, the
highest ones mean a misspelled or absent entry.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata import seeds
from autostrata.staging import staging_path

FILE_PREFIX = "D_Frota_por_UF_Municipio_COMBUSTIVEL_"

# A fuel that the mapping does not know, beside those that it knows.
UNKNOWN_FUEL = "COMBUSTIVEL NOVO"
FUELS = [*(fuel for fuels in seeds.FUELS_BY_GROUP.values() for fuel in fuels), UNKNOWN_FUEL]

# Balance above which a supplier is absent from the municipality list, and misspelled in it.
ABSENT_ABOVE = 9000
MISSPELLED_ABOVE = 9500


# The test tables' columns. Declaring them saves the job that reads file footers for a schema.
SCHEMAS = {
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _of_state(values: list[str], nation_key: str) -> Column:
    return F.array(*map(F.lit, values))[F.col(nation_key)]


def _state_code(nation_key: str) -> Column:
    return _of_state([code for code, _, _ in seeds.STATES], nation_key)


def _plain_state_name(nation_key: str) -> Column:
    names = (unicodedata.normalize("NFD", name) for _, name, _ in seeds.STATES)
    return _of_state(["".join(c for c in n if not unicodedata.combining(c)) for n in names], nation_key)


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State lookup: code, accented name, region."""
    return seeds.states(spark)


def _fuel() -> Column:
    """The fuel type of a part."""
    number = F.substring_index("p_brand", "#", -1).cast("int") * 7 + F.col("p_size")
    return F.array(*map(F.lit, FUELS))[number % len(FUELS)]


def fuels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel mapping, of the fuel types that occur among the parts."""
    used = table(spark, sf_dir, "part").select(_fuel().alias("nm_combustivel")).distinct()
    return used.join(seeds.fuels(spark), "nm_combustivel")


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality list in the raw shape: padded, accented names, lower-case state codes."""
    spelled = F.when(
        F.col("s_acctbal") > MISSPELLED_ABOVE, F.concat("s_name", F.right("s_name", F.lit(1)))
    ).otherwise(F.col("s_name"))
    abroad = F.col("s_suppkey") == 0
    code = (
        F.when(abroad, "0")
        .when(F.col("s_acctbal") < 0, None)
        .otherwise((F.col("s_suppkey") + 1_000_000).cast("string"))
    )
    state = F.when(abroad, "EX").otherwise(F.concat(F.lit(" "), F.lower(_state_code("s_nationkey"))))
    listed = (F.col("s_acctbal") <= ABSENT_ABOVE) | (F.col("s_acctbal") > MISSPELLED_ABOVE)
    return (
        table(spark, sf_dir, "supplier")
        .where(listed)
        .select(
            F.col("s_suppkey").cast("int").alias("id_municipio"),
            code.alias("cd_municipio"),
            F.concat(
                F.lit(" "), F.translate(F.upper(spelled), "UEI", "ÚÉÍ"), F.lit(" ")
            ).alias("nm_municipio_upper"),
            F.col("s_name").alias("nm_municipio_formatted"),
            state.alias("sigla_uf"),
        )
    )


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet rows in the raw shape, one per supplier, fuel type and month.

    The shipments are summed before the supplier is joined; no size is assumed for supplier and
    part, so Spark picks those joins by the size of the tables.
    """
    shipped = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_partkey",
        "l_quantity",
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("_month"),
    )
    part = table(spark, sf_dir, "part").select("p_partkey", _fuel().alias("_fuel"))
    counts = (
        shipped.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "_fuel", "_month")
        .agg(F.sum("l_quantity").cast("int").alias("qtd_veiculos"))
    )
    month_names = F.array(*map(F.lit, seeds.MONTHS))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (
        counts.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            _plain_state_name("s_nationkey").alias("nm_uf"),
            F.upper("s_name").alias("nm_municipio"),
            F.col("_fuel").alias("nm_combustivel"),
            "qtd_veiculos",
            F.concat(
                F.lit(FILE_PREFIX),
                month_names[F.month("_month") - 1],
                F.lit("_"),
                F.year("_month").cast("string"),
                F.lit(".xlsx"),
            ).alias("nm_file"),
        )
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inhabitants by municipality code; an unknown number is NULL."""
    inhabitants = F.floor(F.abs("s_acctbal")).cast("int")
    return table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000).cast("string").alias("cd_ibge_municipio"),
        F.nullif(inhabitants, F.lit(0)).alias("populacao_estimada"),
    )


def coarse_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The municipality list with names that several entries of a state share."""
    name = F.trim("nm_municipio_upper")
    shorter = F.substr(name, F.lit(1), F.lit(len("SUPPLIER#0000000")))
    return municipalities(spark, sf_dir).withColumn("nm_municipio_upper", shorter)


def republished(fleet: DataFrame) -> DataFrame:
    """The fleet with every April in a second file, whose name differs in its letters' case."""
    april = f"_{seeds.MONTHS[3]}_"
    again = F.replace("nm_file", F.lit(april), F.lit(april.upper()))
    return fleet.union(
        fleet.where(F.contains("nm_file", F.lit(april))).withColumn("nm_file", again)
    )


def write_named(df: DataFrame, folder: str, name: str) -> None:
    """CSV files called ``name`` with a running number, as a publisher might call them."""
    spark = df.sparkSession
    path = staging_path(spark, "layout")
    df.write.option("header", "true").csv(path)
    jvm, context = spark._jvm, spark.sparkContext
    source = jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    parts = fs.globStatus(jvm.org.apache.hadoop.fs.Path(source, "part-*.csv"))
    for number, part in enumerate(parts):
        target = jvm.org.apache.hadoop.fs.Path(folder, f"{name}_{number}.csv")
        fs.rename(part.getPath(), target)
