"""Audits of the bronze and silver tables. Each returns a frame; none stops a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autostrata.functions import normalize_name
from autostrata.operators import closest_names
from autostrata.plans.silver import file_dates, registered_keys, registered_municipalities


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL for an empty whole."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def unmapped_fuels(fleet: DataFrame, fuels: DataFrame) -> DataFrame:
    """Fuel types of the fleet that the fuel mapping lacks; a missing fuel name is one of them."""
    return (
        fleet.select("nm_combustivel")
        .distinct()
        .join(fuels.select("nm_combustivel"), "nm_combustivel", "left_anti")
    )


def null_code_audit(municipalities: DataFrame) -> DataFrame:
    """Number of municipalities, of those without a code, and their share in percent."""
    missing = F.count_if(F.col("cd_ibge_municipio").isNull())
    total = F.count("*")
    return municipalities.agg(
        total.alias("qt_total"),
        missing.alias("qt_sem_codigo"),
        percent(missing, total).alias("pc_sem_codigo"),
    )


def null_codes(municipalities: DataFrame, rows: int | None = None) -> DataFrame:
    """The municipalities without a code, by state and name; the first ``rows`` on request."""
    listed = municipalities.where(F.col("cd_ibge_municipio").isNull()).orderBy(
        "nm_uf", "nm_municipio_norm", "nm_municipio_formatted"
    )
    return listed if rows is None else listed.limit(rows)


def unmatched(matches: DataFrame) -> DataFrame:
    """Fleet municipalities that are not on the registered list."""
    return matches.where(~F.col("fl_encontrado")).select(
        "nm_uf", "nm_municipio", "nm_municipio_norm", "sigla_uf"
    )


def match_audit(matches: DataFrame) -> DataFrame:
    """Number of fleet municipalities, of those not on the registered list, their share, and the
    number of those whose name several entries of the list share."""
    missing = F.count_if(~F.col("fl_encontrado"))
    total = F.count("*")
    return matches.agg(
        total.alias("qt_total"),
        missing.alias("qt_sem_match"),
        percent(missing, total).alias("pc_sem_match"),
        F.count_if(F.col("qt_candidatos") > 1).alias("qt_ambiguos"),
    )


def ambiguous(rfb: DataFrame) -> DataFrame:
    """Names of the registered list that several of its entries share within a state, with all of
    these entries: no fleet row can be told to belong to one of them."""
    shared = registered_keys(rfb).where(F.col("qt_candidatos") > 1)
    return registered_municipalities(rfb).join(
        shared.select("nm_chave", "sigla_uf", "qt_candidatos"), ["nm_chave", "sigla_uf"]
    )


def duplicated_grain(fact: DataFrame) -> DataFrame:
    """Municipality, fuel and month that more than one fact row has, with rows and vehicles: a
    month published in two files is counted twice in every sum. Missing keys count as a key."""
    grain = ["id_municipio", "id_combustivel", "id_data"]
    return (
        fact.groupBy(*grain)
        .agg(F.count("*").alias("qt_registros"), F.sum("qt_veiculos").alias("qt_veiculos"))
        .where(F.col("qt_registros") > 1)
    )


def closest_registered(matches: DataFrame, rfb: DataFrame, max_distance: int = 2) -> DataFrame:
    """Each unmatched fleet municipality with the closest registered name of its state.

    Names without one in reach, and names whose state is unknown, have NULL for it.
    """
    listed = registered_municipalities(rfb).select("sigla_uf", "nm_chave", "cd_ibge_municipio")
    missing = (
        unmatched(matches)
        .select("sigla_uf", normalize_name("nm_municipio").alias("nm_chave"))
        .distinct()
    )
    closest = closest_names(
        missing.dropna(), listed.dropna(subset=["sigla_uf", "nm_chave"]),
        block="sigla_uf", name="nm_chave", value="cd_ibge_municipio", max_distance=max_distance,
    )
    return missing.join(closest, ["sigla_uf", "nm_chave"], "left")


def undated_files(files: DataFrame) -> DataFrame:
    """File names that give no reference month."""
    return file_dates(files).where(F.col("id_data").isNull()).select("nm_file")


def missing_keys(fact: DataFrame) -> DataFrame:
    """Fact rows in all and rows without a municipality, fuel or month."""
    return fact.agg(
        F.count("*").alias("qt_registros"),
        F.count_if(F.col("id_municipio").isNull()).alias("qt_sem_municipio"),
        F.count_if(F.col("id_combustivel").isNull()).alias("qt_sem_combustivel"),
        F.count_if(F.col("id_data").isNull()).alias("qt_sem_data"),
    )


def homonyms(places: DataFrame, name: str = "nm_municipio", group: str = "nm_uf") -> DataFrame:
    """Names that occur in more than one group, with the number of groups."""
    return (
        places.groupBy(name)
        .agg(F.count_distinct(group).alias("qt_grupos"))
        .where(F.col("qt_grupos") > 1)
    )


def quality_alert(
    quality: DataFrame, threshold: float, measure: str = "pc_registros_nao_identificados"
) -> DataFrame:
    """Rows of the data-quality table whose share exceeds the threshold."""
    return quality.where(F.col(measure) > threshold)
