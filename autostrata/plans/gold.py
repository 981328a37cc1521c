"""Gold layer: analytical tables over the fact and its dimensions.

Each monthly file is a snapshot of the registered fleet, so counts of different months must not be
added up: every table is keyed by month, and the ranking looks at one month. The plan the tables
come from leaves some of them at a name; their definitions here are the plain reading of it.

Seven of the tables are sums of ``monthly_totals``, which has one row per state, fuel group and
month. It takes one pass over the fact, whatever the number of tables made from it: the dimensions
are saved tables, so Spark broadcasts them if they are small enough, and the sums are combined in
the scan stage, so a shuffle carries one row per key and task, however uneven the keys are. Rows
without a dimension key stay, under a NULL name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autostrata import seeds
from autostrata.operators import unique_lookup
from autostrata.plans.quality import percent

STATE = ["sigla_uf", "nm_uf"]


def _vehicles() -> Column:
    return F.sum("qt_veiculos").alias("qt_veiculos")


def _with_place(fact: DataFrame, municipalities: DataFrame, *columns: str) -> DataFrame:
    return fact.join(municipalities.select("id_municipio", *columns), "id_municipio", "left")


def _with_fuel(fact: DataFrame, fuels: DataFrame) -> DataFrame:
    names = fuels.select("id_combustivel", "nm_grupo", "fl_identificado")
    return fact.join(names, "id_combustivel", "left")


def monthly_totals(fact: DataFrame, municipalities: DataFrame, fuels: DataFrame) -> DataFrame:
    """Fact rows and vehicles by state, region, fuel group and month."""
    named = _with_place(_with_fuel(fact, fuels), municipalities, *STATE, "nm_regiao")
    return named.groupBy(*STATE, "nm_regiao", "nm_grupo", "fl_identificado", "id_data").agg(
        F.count("*").alias("qt_registros"), _vehicles()
    )


def _by_state(totals: DataFrame, groups: list[str]) -> DataFrame:
    chosen = totals.where(F.col("nm_grupo").isin(groups))
    return chosen.groupBy(*STATE, "id_data").agg(_vehicles())


def frota_eletrica_e_hibrida_evolucao(totals: DataFrame) -> DataFrame:
    """Electric and hybrid vehicles by state and month."""
    return _by_state(totals, [seeds.ELECTRIC, seeds.HYBRID])


def frota_eletrica_evolucao(totals: DataFrame) -> DataFrame:
    """Purely electric vehicles by state and month."""
    return _by_state(totals, [seeds.ELECTRIC])


def frota_por_grupo_combustivel_regiao(
    totals: DataFrame, only_identified: bool = False
) -> DataFrame:
    """Vehicles by fuel group, region and month, on request without unidentified fuels."""
    chosen = totals.where("fl_identificado") if only_identified else totals
    return chosen.groupBy("nm_grupo", "nm_regiao", "id_data").agg(_vehicles())


def frota_qualidade_dados(totals: DataFrame) -> DataFrame:
    """Share of unidentified fuels by state and month, in records and in vehicles."""
    unidentified = F.col("nm_grupo") == seeds.UNIDENTIFIED

    def of_unidentified(measure: str) -> Column:
        return F.coalesce(F.sum(F.when(unidentified, F.col(measure))), F.lit(0))

    records, bad_records = F.sum("qt_registros"), of_unidentified("qt_registros")
    vehicles, bad_vehicles = F.sum("qt_veiculos"), of_unidentified("qt_veiculos")
    return totals.groupBy(*STATE, "id_data").agg(
        records.alias("qt_registros"),
        bad_records.alias("qt_registros_nao_identificados"),
        percent(bad_records, records).alias("pc_registros_nao_identificados"),
        vehicles.alias("qt_veiculos"),
        bad_vehicles.alias("qt_veiculos_nao_identificados"),
        percent(bad_vehicles, vehicles).alias("pc_veiculos_nao_identificados"),
    )


def frota_por_regiao(totals: DataFrame) -> DataFrame:
    """Vehicles by region and month."""
    return totals.groupBy("nm_regiao", "id_data").agg(_vehicles())


def frota_por_estado_mes(totals: DataFrame) -> DataFrame:
    """Vehicles by state and month."""
    return totals.groupBy(*STATE, "id_data").agg(_vehicles())


def frota_flex_vs_combustao(totals: DataFrame) -> DataFrame:
    """Flex and combustion (fossil and renewable) vehicles side by side, by region and month."""

    def vehicles_of(*groups: str) -> Column:
        return F.sum(F.when(F.col("nm_grupo").isin(*groups), F.col("qt_veiculos")))

    return totals.groupBy("nm_regiao", "id_data").agg(
        vehicles_of(seeds.FLEX).alias("qt_flex"),
        vehicles_of(seeds.FOSSIL, seeds.RENEWABLE).alias("qt_combustao"),
    )


def latest_month(fact: DataFrame) -> Column:
    """The last month of the fact, as a scalar subquery."""
    return fact.agg(F.max("id_data")).scalar()


def frota_municipio_ranking(
    fact: DataFrame,
    municipalities: DataFrame,
    fuels: DataFrame,
    top: int = 10,
    month: int | None = None,
) -> DataFrame:
    """The municipalities with the most vehicles of each fuel group, in one month.

    The month is the latest one by default, which is looked up in the fact; give it where it is
    known. Rows without a municipality do not take part. Equal
    totals are ranked by id.
    """
    wanted = latest_month(fact) if month is None else F.lit(month)
    of_month = fact.where((F.col("id_data") == wanted) & F.col("id_municipio").isNotNull())
    totals = _with_fuel(of_month, fuels).groupBy("nm_grupo", "id_municipio", "id_data").agg(_vehicles())
    best_first = Window.partitionBy("nm_grupo").orderBy(F.desc("qt_veiculos"), "id_municipio")
    ranked = totals.withColumn("nr_posicao", F.row_number().over(best_first)).where(
        F.col("nr_posicao") <= top
    )
    return _with_place(ranked, municipalities, "nm_municipio_formatted", "sigla_uf").select(
        "nm_grupo",
        "nr_posicao",
        "id_municipio",
        "nm_municipio_formatted",
        "sigla_uf",
        "id_data",
        "qt_veiculos",
    )


def frota_per_capita(
    fact: DataFrame, municipalities: DataFrame, population: DataFrame
) -> DataFrame:
    """Vehicles per inhabitant by municipality and month.

    ``population`` has one row per ``cd_ibge_municipio`` with ``populacao_estimada``; without a
    population, or with none, the ratio is NULL. Rows without a municipality do not take part.
    """
    totals = (
        fact.where(F.col("id_municipio").isNotNull())
        .groupBy("id_municipio", "id_data")
        .agg(_vehicles())
    )
    place = ["cd_ibge_municipio", "nm_municipio_formatted", "sigla_uf"]
    return (
        _with_place(totals, municipalities, *place)
        .join(
            unique_lookup(population, ["cd_ibge_municipio"], ["populacao_estimada"]),
            "cd_ibge_municipio",
            "left",
        )
        .select(
            *place,
            "id_data",
            "qt_veiculos",
            "populacao_estimada",
            F.try_divide("qt_veiculos", "populacao_estimada").alias("veiculos_por_habitante"),
        )
    )
