"""Named queries: each takes a session and a folder of test tables and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata.functions import normalize_name, strip_accents
from autostrata.plans import gold, quality, silver
from autostrata.sources import (
    consolidate,
    container_links,
    full_load,
    linked_files,
    read_fleet,
    read_municipalities,
    read_yearly,
    rejected_lines,
    save_table,
    use_layer,
    write_yearly,
    yearly_layouts,
)
from autostrata.sources.files import FLEET_COLUMNS
from autostrata.staging import materialize, staging_path
from autostrata.workload import adapter

Query = Callable[[SparkSession, str], DataFrame]


class Keyed(NamedTuple):
    """Fleet rows with keys, and the dimensions that have them."""

    rows: DataFrame
    municipalities: DataFrame
    fuels: DataFrame


def _dim_municipio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_municipio(adapter.municipalities(spark, sf_dir), adapter.states(spark, sf_dir))


def _dim_combustivel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_combustivel(adapter.fuels(spark, sf_dir))


def _keyed(spark: SparkSession, sf_dir: str) -> Keyed:
    """Rows and dimensions with names for keys, which need no numbering beforehand. Only lists of
    spellings are written, nothing of the size of the fleet."""
    states = adapter.states(spark, sf_dir)
    listed = silver.without_abroad(
        silver.with_state(adapter.municipalities(spark, sf_dir), states)
    )
    name = F.concat_ws("/", "sigla_uf", "nm_municipio_norm", "cd_ibge_municipio")
    municipalities = listed.withColumn("id_municipio", name)
    fuels = adapter.fuels(spark, sf_dir).withColumn("id_combustivel", F.col("nm_combustivel"))
    rows = silver.fleet_keys(adapter.fleet(spark, sf_dir), states, municipalities, fuels)
    return Keyed(rows, municipalities, fuels)


def _with_year(fleet: DataFrame) -> DataFrame:
    """Fleet rows with the year of their file, which names the folder they are written to."""
    dates = silver.file_dates(fleet).select("nm_file", "nr_ano")
    return fleet.join(dates, "nm_file")


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = silver.fleet_municipalities(adapter.fleet(spark, sf_dir), adapter.states(spark, sf_dir))
    return silver.match_registered(names, adapter.municipalities(spark, sf_dir))


# --- bronze --------------------------------------------------------------------------------


def bronze_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.fleet(spark, sf_dir)


def years_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A yearly output written year range by year range, one of them twice: all years stay."""
    path = staging_path(spark, "yearly")
    rows = _with_year(materialize(adapter.fleet(spark, sf_dir), "fleet"))
    for years in ("nr_ano < 1996", "nr_ano >= 1996", "nr_ano = 1995"):
        write_yearly(rows.where(years), path)
    return read_yearly(spark, path)


def fleet_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly CSV output, then the glob scan with the declared schema."""
    path = staging_path(spark, "yearly")
    write_yearly(_with_year(adapter.fleet(spark, sf_dir)), path)
    return read_fleet(spark, f"{path}/*/*.csv").select(FLEET_COLUMNS)


def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years out of a yearly layout; the other folders are not read."""
    path = staging_path(spark, "yearly")
    write_yearly(_with_year(adapter.fleet(spark, sf_dir)), path)
    return read_yearly(spark, path, [1996, 1997])


def municipality_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The municipality list through its semicolon-separated ISO-8859-1 file format."""
    path = staging_path(spark, "municipalities")
    options = {
        "header": "true", "sep": ";", "encoding": "ISO-8859-1",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    adapter.municipalities(spark, sf_dir).write.options(**options).csv(path)
    return read_municipalities(spark, path)


def rejected_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a load of the fleet could not read in full: odd counts have a decimal point, some
    lines lack their last field or have one too many."""
    path = staging_path(spark, "damaged")
    quantity = F.col("qtd_veiculos")
    count = quantity.cast("string")
    fields = ["nm_uf", "nm_municipio", "nm_combustivel"]
    damaged = F.concat_ws(
        ",",
        *fields,
        F.when(quantity % 7 == 1, F.concat(count, F.lit(".0"))).otherwise(count),
        F.when(quantity % 11 != 1, F.col("nm_file")),
        F.when(quantity % 13 == 1, F.lit("extra")),
    )
    lines = adapter.fleet(spark, sf_dir).select(damaged.alias("value"))
    # Each file begins with a header.
    lines.write.option("header", "true").option("quote", "\u0000").option("sep", "\t").csv(path)
    read = read_fleet(spark, path, malformed="tx_linha")
    return rejected_lines(read, "tx_linha").drop("nm_arquivo")


def full_load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created by a full load, loaded again from itself, then overwritten with one more
    column. Schema and table are gone in the end; what is returned is a scan of the files."""
    before, layer = spark.catalog.currentDatabase(), f"carga_{uuid.uuid4().hex}"
    use_layer(spark, layer)
    try:
        table, path = f"{layer}.frota", staging_path(spark, "load")
        loaded = full_load(adapter.fleet(spark, sf_dir), table, path=staging_path(spark, "load"))
        again = full_load(loaded, table, path=staging_path(spark, "load"))
        longer = again.withColumn("nm_uf_norm", strip_accents("nm_uf"))
        save_table(longer, table, path=path)
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {layer} CASCADE")
    return spark.read.parquet(path)


def consolidated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with two headers in one year's folder as one frame, with the rows' file names; other
    folders and other files are not looked at."""
    root = staging_path(spark, "root")
    supplier = adapter.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("nome"), F.col("s_nationkey").alias("uf"), "s_acctbal"
    )
    customer = adapter.table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.col("c_nationkey").alias("uf"), F.col("c_name").alias("nome")
    )
    adapter.write_named(supplier, f"{root}/2024", "fornecedor+uf")
    adapter.write_named(customer, f"{root}/2024", "cliente")
    adapter.write_named(customer, f"{root}/2024_old", "cliente")
    both = consolidate(spark, yearly_layouts(spark, root, [2024, 2099]), year="nr_ano")
    return both.select(
        "nome",
        F.col("uf").cast("int").alias("uf"),
        F.col("s_acctbal").cast("double").alias("s_acctbal"),
        "c_mktsegment",
        F.regexp_replace("nm_file", "_[0-9]+[.]", ".").alias("nm_file"),
        "nr_ano",
    )


# --- silver --------------------------------------------------------------------------------


def uf_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fleet_municipalities(adapter.fleet(spark, sf_dir), adapter.states(spark, sf_dir))


def registered_with_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.with_state(adapter.municipalities(spark, sf_dir), adapter.states(spark, sf_dir))


def dim_municipio_gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_municipio(
        adapter.municipalities(spark, sf_dir), adapter.states(spark, sf_dir),
        number_before_filter=True,
    )


def dim_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dim_data(adapter.fleet(spark, sf_dir))


def fato_frota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As the job builds it: from a saved fleet and saved dimensions."""
    return silver.fato_frota(
        materialize(adapter.fleet(spark, sf_dir), "fleet"),
        adapter.states(spark, sf_dir),
        _dim_municipio(spark, sf_dir),
        _dim_combustivel(spark, sf_dir),
    )


# --- audits --------------------------------------------------------------------------------


def unmapped_fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unmapped_fuels(adapter.fleet(spark, sf_dir), adapter.fuels(spark, sf_dir))


def unmapped_fuel_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmapped_fuel(spark, sf_dir).agg(F.count("*").alias("qt_sem_mapeamento"))


def null_code_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_code_audit(registered_with_state(spark, sf_dir))


def null_code_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_codes(registered_with_state(spark, sf_dir))


def exterior_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.without_abroad(registered_with_state(spark, sf_dir))


def topn_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dim_municipio(spark, sf_dir).orderBy("sigla_uf", "nm_municipio_norm").limit(10)


def unmatched_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unmatched(_matches(spark, sf_dir))


def match_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.match_audit(_matches(spark, sf_dir))


def fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = materialize(_matches(spark, sf_dir), "matches")
    return quality.closest_registered(matches, adapter.municipalities(spark, sf_dir))


def bad_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names without a month among those of the fleet and those of the pages' links."""
    linked = link_file_names(spark, sf_dir).select("nm_file")
    return quality.undated_files(adapter.fleet(spark, sf_dir).select("nm_file").union(linked))


def fato_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_keys(_keyed(spark, sf_dir).rows)


def duplicated_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipalities, fuels and months counted twice, since each April is published twice."""
    fleet = adapter.republished(materialize(adapter.fleet(spark, sf_dir), "fleet"))
    states = adapter.states(spark, sf_dir)
    rows = silver.fleet_keys(
        fleet, states, _dim_municipio(spark, sf_dir), _dim_combustivel(spark, sf_dir)
    )
    return quality.duplicated_grain(rows)


def ambiguous_municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a list with shortened names that share their name within a state."""
    return quality.ambiguous(adapter.coarse_municipalities(spark, sf_dir))


def homonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.homonyms(adapter.table(spark, sf_dir, "part"), "p_name", "p_brand")


def quality_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_alert(gold_qualidade(spark, sf_dir), 30.0)


# --- gold ----------------------------------------------------------------------------------


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly_totals(*_keyed(spark, sf_dir))


def gold_eletrica_hibrida(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_eletrica_e_hibrida_evolucao(_totals(spark, sf_dir))


def gold_eletrica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_eletrica_evolucao(_totals(spark, sf_dir))


def gold_grupo_regiao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_por_grupo_combustivel_regiao(_totals(spark, sf_dir))


def gold_grupo_regiao_identificados(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_por_grupo_combustivel_regiao(_totals(spark, sf_dir), only_identified=True)


def gold_qualidade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_qualidade_dados(_totals(spark, sf_dir))


def gold_regiao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_por_regiao(_totals(spark, sf_dir))


def gold_estado_mes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_por_estado_mes(_totals(spark, sf_dir))


def gold_flex_vs_combustao(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.frota_flex_vs_combustao(_totals(spark, sf_dir))


def gold_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest month is that of the files, so only rows of its files are joined."""
    fleet, states = adapter.fleet(spark, sf_dir), adapter.states(spark, sf_dir)
    municipalities, fuels = _dim_municipio(spark, sf_dir), _dim_combustivel(spark, sf_dir)
    seen = silver.spellings(fleet)
    files = materialize(silver.file_dates(seen.files), "files")
    month = files.agg(F.max("id_data")).first()[0]
    rows = silver.fleet_keys(
        fleet, states, municipalities, fuels, dated_files=files, month=month or 0, seen=seen
    )
    return gold.frota_municipio_ranking(rows, municipalities, fuels, month=month or 0)


def per_capita(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _keyed(spark, sf_dir)
    return gold.frota_per_capita(s.rows, s.municipalities, adapter.population(spark, sf_dir))


# --- text and links ------------------------------------------------------------------------


def accents_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = adapter.table(spark, sf_dir, "documents")
    return documents.select("doc_id", strip_accents("text").alias("text_norm"))


def names_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = adapter.municipalities(spark, sf_dir)
    return listed.select("id_municipio", normalize_name("nm_municipio_upper").alias("nm_chave"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of the pages' bodies."""
    pages = adapter.table(spark, sf_dir, "pages").select("page_id", "html")
    return container_links(pages, tag="body", element_id=None, keyword=None)


def link_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local file names of the navigation links that contain a keyword."""
    pages = adapter.table(spark, sf_dir, "pages").select("page_id", "html")
    return linked_files(container_links(pages, tag="nav", element_id=None, keyword="the"))


QUERIES: dict[str, Query] = {
    "bronze_fleet": bronze_fleet,
    "fleet_csv_load": fleet_csv_load,
    "years_replaced": years_replaced,
    "year_filter": year_filter,
    "municipality_csv_load": municipality_csv_load,
    "rejected_csv_lines": rejected_csv_lines,
    "full_load_tables": full_load_tables,
    "consolidated_files": consolidated_files,
    "uf_lookup": uf_lookup,
    "registered_with_state": registered_with_state,
    "dim_municipio": _dim_municipio,
    "dim_municipio_gapped": dim_municipio_gapped,
    "dim_combustivel": _dim_combustivel,
    "dim_data": dim_data,
    "fato_frota": fato_frota,
    "unmapped_fuel": unmapped_fuel,
    "unmapped_fuel_count": unmapped_fuel_count,
    "null_code_audit": null_code_audit,
    "null_code_listing": null_code_listing,
    "exterior_filter": exterior_filter,
    "topn_sorted": topn_sorted,
    "municipality_match": _matches,
    "unmatched_municipalities": unmatched_municipalities,
    "match_audit": match_audit,
    "fuzzy_match": fuzzy_match,
    "bad_file_names": bad_file_names,
    "fato_orphans": fato_orphans,
    "duplicated_grain": duplicated_grain,
    "ambiguous_municipalities": ambiguous_municipalities,
    "homonyms": homonyms,
    "quality_alert": quality_alert,
    "gold_eletrica_hibrida": gold_eletrica_hibrida,
    "gold_eletrica": gold_eletrica,
    "gold_grupo_regiao": gold_grupo_regiao,
    "gold_grupo_regiao_identificados": gold_grupo_regiao_identificados,
    "gold_qualidade": gold_qualidade,
    "gold_ranking": gold_ranking,
    "gold_regiao": gold_regiao,
    "gold_estado_mes": gold_estado_mes,
    "gold_flex_vs_combustao": gold_flex_vs_combustao,
    "per_capita": per_capita,
    "strip_accents": accents_removed,
    "normalize_name": names_normalized,
    "page_links": page_links,
    "link_file_names": link_file_names,
}
