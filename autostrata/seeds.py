"""Lookup tables kept in code: states, fuel types and month names.

All three are fixed lists (27, 29 and 12 rows), so the frames carry a broadcast hint: their size
is known here and cannot grow with the data.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# State code, state name, region.
STATES = [
    ("AC", "ACRE", "Norte"),
    ("AL", "ALAGOAS", "Nordeste"),
    ("AM", "AMAZONAS", "Norte"),
    ("AP", "AMAPÁ", "Norte"),
    ("BA", "BAHIA", "Nordeste"),
    ("CE", "CEARÁ", "Nordeste"),
    ("DF", "DISTRITO FEDERAL", "Centro-Oeste"),
    ("ES", "ESPÍRITO SANTO", "Sudeste"),
    ("GO", "GOIÁS", "Centro-Oeste"),
    ("MA", "MARANHÃO", "Nordeste"),
    ("MG", "MINAS GERAIS", "Sudeste"),
    ("MS", "MATO GROSSO DO SUL", "Centro-Oeste"),
    ("MT", "MATO GROSSO", "Centro-Oeste"),
    ("PA", "PARÁ", "Norte"),
    ("PB", "PARAÍBA", "Nordeste"),
    ("PE", "PERNAMBUCO", "Nordeste"),
    ("PI", "PIAUÍ", "Nordeste"),
    ("PR", "PARANÁ", "Sul"),
    ("RJ", "RIO DE JANEIRO", "Sudeste"),
    ("RN", "RIO GRANDE DO NORTE", "Nordeste"),
    ("RO", "RONDÔNIA", "Norte"),
    ("RR", "RORAIMA", "Norte"),
    ("RS", "RIO GRANDE DO SUL", "Sul"),
    ("SC", "SANTA CATARINA", "Sul"),
    ("SE", "SERGIPE", "Nordeste"),
    ("SP", "SÃO PAULO", "Sudeste"),
    ("TO", "TOCANTINS", "Norte"),
]

# Fuel group names.
ELECTRIC = "Elétrico Puro"
HYBRID = "Híbrido"
FLEX = "Flex"
FOSSIL = "Combustão Fóssil"
RENEWABLE = "Combustão Renovável"
UNIDENTIFIED = "Não Identificado"

# The fuel types of each group.
FUELS_BY_GROUP = {
    ELECTRIC: [
        "ELETRICO",
        "ELETRICO/FONTE EXTERNA",
        "ELETRICO/FONTE INTERNA",
        "CELULA COMBUSTIVEL",
    ],
    HYBRID: [
        "HIBRIDO",
        "HIBRIDO PLUG-IN",
        "GASOLINA/ELETRICO",
        "DIESEL/ELETRICO",
        "ETANOL/ELETRICO",
        "GASOLINA/ALCOOL/ELETRICO",
    ],
    FLEX: [
        "ALCOOL/GASOLINA",
        "GASOLINA/ALCOOL/GAS NATURAL",
        "GASOL/GAS NATURAL COMBUSTIVEL",
        "GASOLINA/GAS NATURAL VEICULAR",
        "ALCOOL/GAS NATURAL COMBUSTIVEL",
        "ALCOOL/GAS NATURAL VEICULAR",
        "DIESEL/GAS NATURAL VEICULAR",
        "DIESEL/GAS NATURAL COMBUSTIVEL",
    ],
    FOSSIL: [
        "GASOLINA",
        "DIESEL",
        "GAS NATURAL VEICULAR",
        "GAS METANO",
        "GAS/NATURAL/LIQUEFEITO",
        "GASOGENIO",
    ],
    RENEWABLE: ["ALCOOL"],
    UNIDENTIFIED: [
        "Sem Informação",
        "VIDE/CAMPO/OBSERVACAO",
        "Não Identificado",
        "Não se Aplica",
    ],
}

# Month names, in calendar order.
MONTHS = [
    "Janeiro",
    "Fevereiro",
    "Março",
    "Abril",
    "Maio",
    "Junho",
    "Julho",
    "Agosto",
    "Setembro",
    "Outubro",
    "Novembro",
    "Dezembro",
]

STATE_SCHEMA = "sigla_uf string, nm_uf string, nm_regiao string"
FUEL_SCHEMA = "nm_combustivel string, nm_grupo string, fl_identificado boolean"
MONTH_SCHEMA = "nr_mes int, nm_mes string"


def _small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    names = [field.split()[0] for field in schema.split(", ")]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    return F.broadcast(spark.createDataFrame(table, schema))


def states(spark: SparkSession) -> DataFrame:
    """State code, state name and region (27 rows)."""
    return _small_table(spark, STATES, STATE_SCHEMA)


def fuels(spark: SparkSession) -> DataFrame:
    """Fuel type, fuel group and whether the fuel is identified (29 rows)."""
    rows = [
        (fuel, group, group != UNIDENTIFIED)
        for group, members in FUELS_BY_GROUP.items()
        for fuel in members
    ]
    return _small_table(spark, rows, FUEL_SCHEMA)


def months(spark: SparkSession) -> DataFrame:
    """Month number and Portuguese month name (12 rows)."""
    return _small_table(spark, list(enumerate(MONTHS, start=1)), MONTH_SCHEMA)
