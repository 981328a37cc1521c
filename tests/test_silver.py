"""Dimensions and fact on hand-made rows."""

import datetime

import pytest

from autostrata import seeds
from autostrata.operators import unique_lookup
from autostrata.plans import quality, silver

APRIL = "D_Frota_por_UF_Municipio_COMBUSTIVEL_Abril_2024.xlsx"
MARCH = "D_Frota_por_UF_Municipio_COMBUSTIVEL_Março_2025.xlsx"

FLEET = [
    ("ACRE", "ACRELANDIA", "GASOLINA", 12, APRIL),
    ("ACRE", "ACRELANDIA", "ELETRICO", 1, APRIL),
    ("SAO PAULO", "SAO PAULO", "Sem Informação", 7, MARCH),
    ("SAO PAULO", "SAO PAULO", "NOVO TIPO", 3, MARCH),
    ("SAO PAULO", "SAO PAULLO", "ALCOOL", None, "combustivel_3.xlsx"),
    ("SAO PAULO", "SAO PAULO", None, 2, MARCH),
    ("SAO PAULO", "SAO PAULO", "Sem Informação", 7, MARCH),
]

RFB = [
    (1, "1200013", "ACRELÂNDIA", "Acrelândia", "AC"),
    (2, "3550308", " SÃO PAULO ", "São Paulo", "sp"),
    (3, "0", "EXTERIOR", "Exterior", "EX"),
    (4, None, "SEM CODIGO", "Sem Codigo", "AC"),
    (5, "9999999", "NENHURES", "Nenhures", "ZZ"),
]


@pytest.fixture(scope="module")
def fleet(spark):
    from autostrata.sources.files import FLEET_SCHEMA

    return spark.createDataFrame(FLEET, FLEET_SCHEMA)


@pytest.fixture(scope="module")
def rfb(spark):
    from autostrata.sources.files import MUNICIPALITY_SCHEMA

    return spark.createDataFrame(RFB, MUNICIPALITY_SCHEMA)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_seed_sizes(spark):
    assert seeds.states(spark).count() == 27
    assert seeds.fuels(spark).count() == 29
    assert seeds.months(spark).count() == 12
    groups = {r.nm_grupo: r["count"] for r in seeds.fuels(spark).groupBy("nm_grupo").count().collect()}
    assert groups == {
        seeds.ELECTRIC: 4, seeds.HYBRID: 6, seeds.FLEX: 8, seeds.FOSSIL: 6, seeds.RENEWABLE: 1,
        seeds.UNIDENTIFIED: 4,
    }
    regions = {r.nm_regiao: r["count"] for r in seeds.states(spark).groupBy("nm_regiao").count().collect()}
    assert regions == {"Norte": 7, "Nordeste": 9, "Centro-Oeste": 4, "Sudeste": 4, "Sul": 3}
    flagged = seeds.fuels(spark).where("not fl_identificado").select("nm_grupo").distinct()
    assert _rows(flagged) == [(seeds.UNIDENTIFIED,)]


def test_dim_combustivel_keys(spark):
    dim = silver.dim_combustivel(seeds.fuels(spark))
    assert [c for c, _ in dim.dtypes] == [
        "id_combustivel", "nm_combustivel", "nm_grupo", "fl_identificado"
    ]
    spans = {}
    for r in dim.collect():
        spans.setdefault(r.nm_grupo, []).append(r.id_combustivel)
    assert {g: (min(i), max(i)) for g, i in spans.items()} == {
        seeds.FOSSIL: (1, 6), seeds.RENEWABLE: (7, 7), seeds.ELECTRIC: (8, 11),
        seeds.FLEX: (12, 19), seeds.HYBRID: (20, 25), seeds.UNIDENTIFIED: (26, 29),
    }


def test_dim_municipio(spark, rfb):
    dim = silver.dim_municipio(rfb, seeds.states(spark))
    assert dim.columns == [
        "id_municipio", "cd_ibge_municipio", "nm_municipio_norm", "nm_municipio_formatted",
        "nm_uf", "sigla_uf", "nm_regiao",
    ]
    assert _rows(dim) == [
        (1, "9999999", "NENHURES", "Nenhures", None, None, None),
        (2, "1200013", "ACRELANDIA", "Acrelândia", "ACRE", "AC", "Norte"),
        (3, "3550308", "SAO PAULO", "São Paulo", "SÃO PAULO", "SP", "Sudeste"),
    ]


def test_dim_municipio_numbered_before_the_filter_has_gaps(spark, rfb):
    dim = silver.dim_municipio(rfb, seeds.states(spark), number_before_filter=True)
    assert sorted((r.id_municipio, r.cd_ibge_municipio) for r in dim.collect()) == [
        (2, "9999999"), (3, "1200013"), (5, "3550308")
    ]


def test_file_dates(spark, fleet):
    assert _rows(silver.file_dates(fleet)) == sorted(
        [
            (APRIL, 202404, "Abril", 4, 2024, datetime.date(2024, 4, 1)),
            (MARCH, 202503, "Março", 3, 2025, datetime.date(2025, 3, 1)),
            ("combustivel_3.xlsx", None, None, None, None, None),
        ],
        key=str,
    )
    assert _rows(silver.dim_data(fleet)) == [
        (202404, "Abril", 4, 2024, datetime.date(2024, 4, 1)),
        (202503, "Março", 3, 2025, datetime.date(2025, 3, 1)),
    ]
    assert _rows(quality.undated_files(fleet)) == [("combustivel_3.xlsx",)]


def test_fact_keeps_every_row_and_leaves_unknown_keys_null(spark, fleet, rfb):
    states = seeds.states(spark)
    fact = silver.fato_frota(
        fleet, states, silver.dim_municipio(rfb, states),
        silver.dim_combustivel(seeds.fuels(spark)), silver.dim_data(fleet),
    )
    assert fact.dtypes == [
        ("id_fato", "bigint"), ("id_municipio", "int"), ("id_combustivel", "int"),
        ("id_data", "int"), ("qt_veiculos", "int"), ("nm_file", "string"),
    ]
    ids = {r.nm_combustivel: r.id_combustivel
           for r in silver.dim_combustivel(seeds.fuels(spark)).collect()}
    electric, petrol, unknown = ids["ELETRICO"], ids["GASOLINA"], ids["Sem Informação"]
    assert petrol < electric
    assert [tuple(r) for r in fact.orderBy("id_fato").collect()] == [
        (1, None, ids["ALCOOL"], None, None, "combustivel_3.xlsx"),
        (2, 2, petrol, 202404, 12, APRIL),
        (3, 2, electric, 202404, 1, APRIL),
        (4, 3, None, 202503, 2, MARCH),
        (5, 3, None, 202503, 3, MARCH),
        (6, 3, unknown, 202503, 7, MARCH),
        (7, 3, unknown, 202503, 7, MARCH),
    ]
    assert tuple(quality.missing_keys(fact).first()) == (7, 1, 2, 1)


def test_match_and_closest_name(spark, fleet, rfb):
    names = silver.fleet_municipalities(fleet, seeds.states(spark))
    matches = silver.match_registered(names, rfb)
    found = {r.nm_municipio: (r.sigla_uf, r.cd_ibge_municipio, r.fl_encontrado) for r in matches.collect()}
    assert found == {
        "ACRELANDIA": ("AC", "1200013", True),
        "SAO PAULO": ("SP", "3550308", True),
        "SAO PAULLO": ("SP", None, False),
    }
    assert _rows(quality.unmatched(matches)) == [("SAO PAULO", "SAO PAULLO", "SAO PAULLO", "SP")]
    assert tuple(quality.match_audit(matches).first()) == (3, 1, 33.33, 0)
    assert _rows(quality.closest_registered(matches, rfb)) == [
        ("SP", "SAO PAULLO", "SAO PAULO", "3550308", 1)
    ]


def test_listed_without_code_is_found(spark, rfb):
    names = spark.createDataFrame(
        [("ACRE", "SEM CODIGO", "SEM CODIGO", "AC")],
        "nm_uf string, nm_municipio string, nm_municipio_norm string, sigla_uf string",
    )
    row = silver.match_registered(names, rfb).first()
    assert (row.cd_ibge_municipio, row.fl_encontrado) == (None, True)


def test_unmapped_fuels(spark, fleet):
    assert _rows(quality.unmapped_fuels(fleet, seeds.fuels(spark))) == sorted(
        [("NOVO TIPO",), (None,)], key=str
    )


def test_null_code_audit(spark, rfb):
    joined = silver.with_state(rfb, seeds.states(spark))
    assert tuple(quality.null_code_audit(joined).first()) == (5, 1, 20.0)
    assert [r.nm_municipio_norm for r in quality.null_codes(joined).collect()] == ["SEM CODIGO"]
    assert tuple(quality.null_code_audit(joined.where("false")).first()) == (0, 0, None)


def test_homonyms(spark):
    places = spark.createDataFrame(
        [("BOM JESUS", "PIAUI"), ("BOM JESUS", "BAHIA"), ("BOM JESUS", "BAHIA"), ("ITU", "SAO PAULO")],
        "nm_municipio string, nm_uf string",
    )
    assert _rows(quality.homonyms(places)) == [("BOM JESUS", 2)]


def test_duplicate_lookup_key_fails_the_query(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), (None, 4)], "k string, v int")
    assert _rows(unique_lookup(df, ["k"], ["v"])) == [("a", 1), ("b", 2)]
    twice = df.union(spark.createDataFrame([("a", 5)], "k string, v int"))
    with pytest.raises(Exception, match="is not unique.*a"):
        unique_lookup(twice, ["k"], ["v"]).collect()
    with pytest.raises(Exception, match="is not unique.*a"):  # whichever columns are asked for
        df.join(unique_lookup(twice, ["k"], ["v"]), "k", "left").select(df["v"]).collect()


def test_lookups_do_not_multiply_rows(spark, fleet, rfb):
    states = seeds.states(spark)
    doubled = states.union(states)
    with pytest.raises(Exception, match="is not unique"):
        silver.with_state(rfb, doubled).collect()
    with pytest.raises(Exception, match="is not unique"):
        silver.fleet_municipalities(fleet, doubled).collect()


def test_ambiguous_names_are_reported_not_matched(spark):
    states = seeds.states(spark)
    rfb = spark.createDataFrame(
        [(1, "1", "SANT'ANA", "Sant'Ana", "AC"), (2, "2", "SANTANA", "Santana", "AC"),
         (3, "3", "SANTANA", "Santana", "SP")],
        "id_municipio int, cd_municipio string, nm_municipio_upper string, "
        "nm_municipio_formatted string, sigla_uf string",
    )
    fleet = spark.createDataFrame(
        [("ACRE", "SANTANA", "DIESEL", 1, "f"), ("SAO PAULO", "SANTANA", "DIESEL", 1, "f")],
        "nm_uf string, nm_municipio string, nm_combustivel string, qtd_veiculos int, nm_file string",
    )
    matches = silver.match_registered(silver.fleet_municipalities(fleet, states), rfb)
    found = {r.sigla_uf: (r.cd_ibge_municipio, r.qt_candidatos) for r in matches.collect()}
    assert found == {"AC": (None, 2), "SP": ("3", 1)}
    assert tuple(quality.match_audit(matches).first()) == (2, 0, 0.0, 1)
    assert sorted(r.cd_ibge_municipio for r in quality.ambiguous(rfb).collect()) == ["1", "2"]
    with pytest.raises(Exception, match="is not unique"):
        silver.municipality_lookup(fleet, states, silver.dim_municipio(rfb, states)).collect()


def test_unmatched_names_without_a_state_are_listed(spark, rfb):
    matches = spark.createDataFrame(
        [("ATLANTIS", "POSEIDONIA", "POSEIDONIA", None, None, None, 0, False)],
        "nm_uf string, nm_municipio string, nm_municipio_norm string, sigla_uf string, "
        "cd_ibge_municipio string, nm_municipio_formatted string, qt_candidatos bigint, "
        "fl_encontrado boolean",
    )
    rows = quality.closest_registered(matches, rfb).collect()
    assert [(r.sigla_uf, r.nm_chave, r.nm_candidato) for r in rows] == [(None, "POSEIDONIA", None)]


def test_month_in_two_files_shows_in_the_grain(spark):
    fact = spark.createDataFrame(
        [(1, 1, 202404, 5), (1, 1, 202404, 6), (1, 2, 202404, 7), (None, 1, 202404, 1)],
        "id_municipio int, id_combustivel int, id_data int, qt_veiculos int",
    )
    assert _rows(quality.duplicated_grain(fact)) == [(1, 1, 202404, 2, 11)]
