"""Physical plans, and the whole pipeline from files to saved gold tables."""

import os

import pytest
from pyspark.sql import functions as F

from autostrata import seeds
from autostrata.operators import closest_names, keys, range_key
from autostrata.plans import gold, jobs, quality, silver
from autostrata.sources.files import FLEET_SCHEMA, MUNICIPALITY_SCHEMA
from autostrata.staging import materialize, staging_root

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fleet(spark):
    # Saved like the bronze table is, so that the scan shows in the plans.
    prefix = "D_Frota_por_UF_Municipio_COMBUSTIVEL_"
    month = F.element_at(F.array(*map(F.lit, seeds.MONTHS)), (F.col("id") % 12 + 1).cast("int"))
    df = spark.range(2000).select(
        F.lit("ACRE").alias("nm_uf"),
        F.concat(F.lit("MUNICIPIO "), F.col("id") % 50).alias("nm_municipio"),
        F.lit("GASOLINA").alias("nm_combustivel"),
        F.col("id").cast("int").alias("qtd_veiculos"),
        F.concat(F.lit(prefix), month, F.lit("_2024.xlsx")).alias("nm_file"),
    )
    return materialize(df, "bronze")


@pytest.fixture(scope="module")
def rfb(spark):
    df = spark.range(50).select(
        F.col("id").cast("int").alias("id_municipio"),
        (F.col("id") + 1200000).cast("string").alias("cd_municipio"),
        F.concat(F.lit("MUNICÍPIO "), F.col("id")).alias("nm_municipio_upper"),
        F.concat(F.lit("Município "), F.col("id")).alias("nm_municipio_formatted"),
        F.lit("AC").alias("sigla_uf"),
    )
    return materialize(df, "rfb")


@pytest.fixture(scope="module")
def star(spark, fleet, rfb):
    states = seeds.states(spark)
    places = silver.dim_municipio(rfb, states)
    fuels = silver.dim_combustivel(seeds.fuels(spark))
    dates = materialize(silver.dim_data(fleet), "dates")
    return silver.fleet_keys(fleet, states, places, fuels, dates), places, fuels


def test_no_python_in_the_tasks(spark, fleet, rfb, star):
    states = seeds.states(spark)
    matches = silver.match_registered(silver.fleet_municipalities(fleet, states), rfb)
    frames = [
        star[0], star[1], star[2], silver.dim_data(fleet), matches,
        quality.closest_registered(matches, rfb), gold.frota_qualidade_dados(gold.monthly_totals(*star)),
        gold.frota_municipio_ranking(*star),
    ]
    for frame in frames:
        assert "Python" not in _plan(frame)


def test_seeds_are_broadcast(spark, fleet, rfb):
    for frame in (
        silver.with_state(rfb, seeds.states(spark)),
        quality.unmapped_fuels(fleet, seeds.fuels(spark)),
        silver.file_dates(fleet),
    ):
        plan = _plan(frame)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("what", ["dates", "places"])
def test_names_are_parsed_once_per_spelling(spark, fleet, star, what):
    """Costly string work stays above the aggregation that finds the distinct spellings."""
    if what == "dates":
        plan = _plan(silver.dim_data(fleet))
    else:
        plan = _plan(silver.municipality_lookup(fleet, seeds.states(spark), star[1]))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "nm_" in line)
    nearest = max(i for i, line in enumerate(lines[:scan]) if "Aggregate" in line)
    assert "partial_count" in lines[nearest]
    assert not any("RLIKE" in line or "regexp" in line for line in lines[nearest : scan + 1])


def test_fact_reads_the_fleet_once_and_broadcasts_small_lookups(star):
    plan = _plan(star[0])
    assert "SortMergeJoin" not in plan
    assert sum("FileScan" in line and "qtd_veiculos" in line for line in plan.splitlines()) == 1
    assert "regexp" not in plan.lower() and "translate" not in plan
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]


def test_large_lookups_are_not_broadcast(spark, fleet, rfb):
    """With nothing small enough to broadcast, the joins shuffle and the result is the same."""
    states = seeds.states(spark)
    fuels, dates = silver.dim_combustivel(seeds.fuels(spark)), silver.dim_data(fleet)

    def rows():
        places = silver.dim_municipio(rfb, states)
        return silver.fleet_keys(fleet, states, places, fuels, dates)

    expected = sorted(tuple(r) for r in rows().collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = rows()
        plan = _plan(shuffled)
        # The fleet is shuffled once, by all names; the list of files is small and stays broadcast.
        scan = next(i for i, line in enumerate(plan.splitlines()) if "qtd_veiculos" in line and "FileScan" in line)
        fleet_side = [line for line in plan.splitlines()[:scan] if "Exchange" in line]
        assert sum("hashpartitioning" in line for line in fleet_side) == 1
        assert sorted(tuple(r) for r in shuffled.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_strings_of_names_are_never_broadcast(spark):
    names = spark.createDataFrame([("X", "ABC")], "uf string, nm string")
    candidates = spark.createDataFrame([("X", "ABD", "1")], "uf string, nm string, cd string")
    assert "SortMergeJoin" in _plan(closest_names(names, candidates, "uf", "nm", "cd"))


def test_only_the_range_sizes_meet_in_one_task(spark, monkeypatch):
    written = []
    monkeypatch.setattr(
        keys, "materialize", lambda df, label: written.append(df) or materialize(df, label)
    )
    numbered = range_key(spark.range(100).select(F.col("id").alias("a")), "n", ["a"])
    assert "SinglePartition" not in _plan(written[-1])
    assert "rangepartitioning" in _plan(written[-1])
    above = _plan(numbered).split("SinglePartition")
    assert len(above) == 2 and "Aggregate" in above[1].splitlines()[1]


def test_gold_sums_are_combined_before_the_shuffle(star):
    plan = _plan(gold.monthly_totals(*star))
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning(sigla_uf") == 1
    assert "WindowGroupLimit" in _plan(gold.frota_municipio_ranking(*star))


def test_group_filter_reaches_the_dimension(star):
    """Only fuels of the wanted group are joined, and the fact rows of others drop out there."""
    joins = [line for line in _plan(gold.frota_eletrica_evolucao(gold.monthly_totals(*star))).splitlines()
             if "BroadcastHashJoin [id_combustivel" in line]
    assert len(joins) == 1 and "Inner" in joins[0]


def test_pipeline_from_files_to_gold(spark, tmp_path, fleet, rfb):
    fleet_path, list_path = f"{tmp_path}/fleet", f"{tmp_path}/list"
    fleet.write.option("header", True).csv(fleet_path)
    rfb.write.options(header="true", sep=";", encoding="ISO-8859-1").csv(list_path)
    root = staging_root(spark).removeprefix("file:")

    def leftovers():
        return {name for name in os.listdir(root) if name.startswith("area-")}

    before = leftovers()
    try:
        jobs.build_bronze(spark, f"{fleet_path}/*.csv", list_path)
        jobs.build_silver(spark)
        jobs.build_gold(spark)
        assert spark.table("bronze.frota_raw").schema == spark.createDataFrame([], FLEET_SCHEMA).schema
        listed = spark.table("bronze.rfb_municipios")
        assert listed.schema == spark.createDataFrame([], MUNICIPALITY_SCHEMA).schema
        fact = spark.table("silver.fato_frota")
        assert fact.count() == fleet.count()
        ids = fact.agg(F.min("id_fato"), F.max("id_fato"), F.count_distinct("id_fato")).first()
        assert tuple(ids) == (1, 2000, 2000)
        assert tuple(quality.missing_keys(fact).first()) == (2000, 0, 0, 0)
        total = fleet.agg(F.sum("qtd_veiculos")).first()[0]
        by_region = spark.table("gold.frota_por_regiao")
        assert by_region.agg(F.sum("qt_veiculos")).first()[0] == total
        by_group = spark.table("gold.frota_por_grupo_combustivel_regiao")
        assert by_group.agg(F.sum("qt_veiculos")).first()[0] == total
        assert {t.name for t in spark.catalog.listTables("gold")} == set(jobs.gold_tables(spark))
        assert leftovers() == before
        month = fact.where("id_data = 202404")
        assert "PartitionFilters: [isnotnull(id_data" in _plan(month)
    finally:
        spark.catalog.setCurrentDatabase("default")
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
