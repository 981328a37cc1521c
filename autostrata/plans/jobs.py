"""Jobs that build the layers as saved tables, in the order bronze, silver, gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from autostrata import seeds
from autostrata.config import (
    BRONZE,
    FLEET_TABLE,
    GOLD,
    MUNICIPALITY_TABLE,
    REJECTED_SUFFIX,
    SILVER,
    TABLE_FORMAT,
)
from autostrata.plans import gold, quality, silver
from autostrata.sources import (
    consolidate,
    full_load,
    read_fleet,
    read_municipalities,
    rejected_lines,
    save_table,
    use_layer,
    write_yearly,
    yearly_layouts,
)
from autostrata.sources.files import Paths
from autostrata.staging import materialize, temporary_area

# Share of unidentified fuels, in percent of the records, above which a state and month is listed.
ALERT_PERCENT = 30.0

# Column with the text of a line that does not fit the schema.
REJECTED_LINE = "tx_linha"


def consolidate_years(
    spark: SparkSession, root: str, output: str, years: list[int] | None = None
) -> None:
    """Monthly CSV files in one folder per year into one output per year, with file names.

    Without ``years``, every folder named by a number is taken. Columns are aligned by name, file
    by file. Years that are read replace those of the output and leave all others as they are; a
    year without files is left out, and nothing is written if no year has any.
    """
    layouts = yearly_layouts(spark, root, years)
    if layouts:
        write_yearly(consolidate(spark, layouts, year="nr_ano"), output, columns=None)


def build_bronze(
    spark: SparkSession,
    fleet_paths: Paths,
    municipality_paths: Paths,
    table_format: str = TABLE_FORMAT,
) -> None:
    """Full loads of the fleet files and the municipality list.

    Lines that do not fit the schema are loaded as far as they can be read, like all others, and
    kept as they are in a table beside the raw one. They are found by a second read of the files,
    which writes nothing else.
    """
    use_layer(spark, BRONZE)
    loads = [
        (FLEET_TABLE, read_fleet, fleet_paths),
        (MUNICIPALITY_TABLE, read_municipalities, municipality_paths),
    ]
    for table, read, paths in loads:
        full_load(read(spark, paths), table, table_format)
        rejected = rejected_lines(read(spark, paths, malformed=REJECTED_LINE), REJECTED_LINE)
        full_load(rejected, table + REJECTED_SUFFIX, table_format)


def build_silver(spark: SparkSession, table_format: str = TABLE_FORMAT) -> None:
    """The three dimensions, then the fact over the saved dimensions, partitioned by month.

    The audits are saved first, so that they are there if the fact cannot be built.
    """
    use_layer(spark, SILVER)
    fleet, states = spark.table(FLEET_TABLE), seeds.states(spark)
    with temporary_area(spark):
        for name, frame in bronze_audits(spark).items():
            save_table(frame, f"{SILVER}.{name}", table_format)
        dated_files = materialize(silver.file_dates(fleet), "files")
        dimensions = {
            "dim_municipio": silver.dim_municipio(spark.table(MUNICIPALITY_TABLE), states),
            "dim_combustivel": silver.dim_combustivel(seeds.fuels(spark)),
            "dim_data": silver.dim_data(dated_files),
        }
        for name, frame in dimensions.items():
            save_table(frame, f"{SILVER}.{name}", table_format)
        saved = [spark.table(f"{SILVER}.{name}") for name in dimensions]
        fact = silver.fato_frota(fleet, states, *saved, dated_files)
        save_table(fact, f"{SILVER}.fato_frota", table_format, partition_by=["id_data"])
        for name, frame in fact_audits(spark).items():
            save_table(frame, f"{SILVER}.{name}", table_format)


def bronze_audits(spark: SparkSession) -> dict[str, DataFrame]:
    """Audits of the loaded files by table name."""
    fleet, rfb = spark.table(FLEET_TABLE), spark.table(MUNICIPALITY_TABLE)
    states = seeds.states(spark)
    seen = silver.spellings(fleet)
    listed = silver.with_state(rfb, states)
    matches = materialize(
        silver.match_registered(silver.fleet_municipalities(seen.places, states), rfb), "matches"
    )
    return {
        "auditoria_combustivel_sem_mapeamento": quality.unmapped_fuels(fleet, seeds.fuels(spark)),
        "auditoria_codigo_nulo": quality.null_code_audit(listed),
        "auditoria_codigo_nulo_lista": quality.null_codes(listed),
        "auditoria_municipio": quality.match_audit(matches),
        "auditoria_municipio_sem_match": quality.unmatched(matches),
        "auditoria_municipio_mais_proximo": quality.closest_registered(matches, rfb),
        "auditoria_municipio_ambiguo": quality.ambiguous(rfb),
        "auditoria_arquivo_sem_data": quality.undated_files(seen.files),
    }


def fact_audits(spark: SparkSession) -> dict[str, DataFrame]:
    """Audits of the saved fact by table name."""
    fact = spark.table(f"{SILVER}.fato_frota")
    return {
        "auditoria_chave_ausente": quality.missing_keys(fact),
        "auditoria_grao_repetido": quality.duplicated_grain(fact),
    }


def gold_tables(
    spark: SparkSession, population: DataFrame | None = None, threshold: float = ALERT_PERCENT
) -> dict[str, DataFrame]:
    """The gold tables by name, over the saved silver layer, and the data-quality alert.

    The monthly totals are written once, so the fact is read for them, for the ranking and the
    ratio per inhabitant, which needs a ``population`` (see ``gold.frota_per_capita``).
    """
    fact = spark.table(f"{SILVER}.fato_frota")
    places = spark.table(f"{SILVER}.dim_municipio")
    fuels = spark.table(f"{SILVER}.dim_combustivel")
    totals = materialize(gold.monthly_totals(fact, places, fuels), "totals")
    audited = gold.frota_qualidade_dados(totals)
    per_capita = {}
    if population is not None:
        per_capita["frota_por_habitante"] = gold.frota_per_capita(fact, places, population)
    return {
        **per_capita,
        "alerta_qualidade_dados": quality.quality_alert(audited, threshold),
        "frota_eletrica_e_hibrida_evolucao": gold.frota_eletrica_e_hibrida_evolucao(totals),
        "frota_eletrica_evolucao": gold.frota_eletrica_evolucao(totals),
        "frota_por_grupo_combustivel_regiao": gold.frota_por_grupo_combustivel_regiao(totals),
        "frota_qualidade_dados": audited,
        "frota_municipio_ranking": gold.frota_municipio_ranking(fact, places, fuels),
        "frota_por_regiao": gold.frota_por_regiao(totals),
        "frota_por_estado_mes": gold.frota_por_estado_mes(totals),
        "frota_flex_vs_combustao": gold.frota_flex_vs_combustao(totals),
    }


def build_gold(
    spark: SparkSession, table_format: str = TABLE_FORMAT, population: DataFrame | None = None
) -> None:
    """Overwrite all gold tables."""
    use_layer(spark, GOLD)
    with temporary_area(spark):
        for name, frame in gold_tables(spark, population).items():
            save_table(frame, f"{GOLD}.{name}", table_format)
