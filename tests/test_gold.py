"""Gold tables on hand-made rows."""

import pytest

from autostrata import seeds
from autostrata.plans import gold, quality


@pytest.fixture(scope="module")
def star(spark):
    fuels = spark.createDataFrame(
        [
            (1, "G", seeds.FOSSIL, True), (2, "A", seeds.RENEWABLE, True),
            (3, "E", seeds.ELECTRIC, True), (4, "H", seeds.HYBRID, True),
            (5, "F", seeds.FLEX, True), (6, "?", seeds.UNIDENTIFIED, False),
        ],
        "id_combustivel int, nm_combustivel string, nm_grupo string, fl_identificado boolean",
    )
    places = spark.createDataFrame(
        [
            (1, "11", "A", "A", "ACRE", "AC", "Norte"), (2, "12", "B", "B", "ACRE", "AC", "Norte"),
            (3, "21", "C", "C", "PARANÁ", "PR", "Sul"),
        ],
        "id_municipio int, cd_ibge_municipio string, nm_municipio_norm string, "
        "nm_municipio_formatted string, nm_uf string, sigla_uf string, nm_regiao string",
    )
    fact = spark.createDataFrame(
        [
            (1, 1, 202404, 10), (1, 3, 202404, 1), (2, 4, 202404, 2), (3, 5, 202404, 30),
            (3, 6, 202404, None), (1, 1, 202406, 11), (2, 1, 202406, 11), (3, 1, 202406, 5),
            (1, 2, 202406, 4), (3, 6, 202406, 6), (None, 1, 202406, 100), (3, None, 202406, 7),
        ],
        "id_municipio int, id_combustivel int, id_data int, qt_veiculos int",
    )
    return fact, places, fuels


@pytest.fixture(scope="module")
def totals(star):
    return gold.monthly_totals(*star)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_electric_tables(totals):
    assert _rows(gold.frota_eletrica_e_hibrida_evolucao(totals)) == [("AC", "ACRE", 202404, 3)]
    assert _rows(gold.frota_eletrica_evolucao(totals)) == [("AC", "ACRE", 202404, 1)]


def test_months_without_rows_are_absent(totals):
    months = {r.id_data for r in gold.frota_por_regiao(totals).collect()}
    assert months == {202404, 202406}


def test_unknown_keys_stay_under_a_null_name(totals):
    by_region = {(r.nm_regiao, r.id_data): r.qt_veiculos for r in gold.frota_por_regiao(totals).collect()}
    assert by_region == {
        ("Norte", 202404): 13, ("Sul", 202404): 30, ("Norte", 202406): 26, ("Sul", 202406): 18,
        (None, 202406): 100,
    }
    assert sum(by_region.values()) == sum(
        r.qt_veiculos for r in gold.frota_por_estado_mes(totals).collect()
    )
    groups = gold.frota_por_grupo_combustivel_regiao(totals).collect()
    assert (None, "Sul", 202406, 7) in {tuple(r) for r in groups}
    assert sum(r.qt_veiculos or 0 for r in groups) == sum(by_region.values())


def test_only_identified(totals):
    rows = gold.frota_por_grupo_combustivel_regiao(totals, only_identified=True).collect()
    assert seeds.UNIDENTIFIED not in {r.nm_grupo for r in rows}
    assert None not in {r.nm_grupo for r in rows}


def test_flex_against_combustion(totals):
    assert _rows(gold.frota_flex_vs_combustao(totals)) == sorted(
        [
            ("Norte", 202404, None, 10), ("Sul", 202404, 30, None), ("Norte", 202406, None, 26),
            ("Sul", 202406, None, 5), (None, 202406, None, 100),
        ],
        key=str,
    )


def test_quality_and_alert(totals):
    rows = {(r.sigla_uf, r.id_data): r for r in gold.frota_qualidade_dados(totals).collect()}
    south = rows["PR", 202406]
    assert (south.qt_registros, south.qt_registros_nao_identificados) == (3, 1)
    assert south.pc_registros_nao_identificados == 33.33
    assert (south.qt_veiculos, south.qt_veiculos_nao_identificados) == (18, 6)
    assert south.pc_veiculos_nao_identificados == 33.33
    early = rows["PR", 202404]
    assert (early.pc_registros_nao_identificados, early.pc_veiculos_nao_identificados) == (50.0, 0.0)
    alerts = quality.quality_alert(gold.frota_qualidade_dados(totals), 40.0)
    assert [(r.sigla_uf, r.id_data) for r in alerts.collect()] == [("PR", 202404)]


def test_ranking_is_of_one_month_and_breaks_ties_by_id(star):
    rows = _rows(gold.frota_municipio_ranking(*star, top=2))
    assert [r for r in rows if r[0] == seeds.FOSSIL] == [
        (seeds.FOSSIL, 1, 1, "A", "AC", 202406, 11), (seeds.FOSSIL, 2, 2, "B", "AC", 202406, 11),
    ]
    assert {r[5] for r in rows} == {202406}
    earlier = gold.frota_municipio_ranking(*star, month=202404).collect()
    assert {r.id_data for r in earlier} == {202404}


def test_per_capita(spark, star):
    population = spark.createDataFrame(
        [("11", 5), ("21", 0)], "cd_ibge_municipio string, populacao_estimada int"
    )
    rows = {
        (r.cd_ibge_municipio, r.id_data): r.veiculos_por_habitante
        for r in gold.frota_per_capita(*star[:2], population).collect()
    }
    assert rows == {
        ("11", 202404): 11 / 5, ("12", 202404): None, ("21", 202404): None,
        ("11", 202406): 15 / 5, ("12", 202406): None, ("21", 202406): None,
    }
