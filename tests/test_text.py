"""Accent removal, name normalization and file-name parsing."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from autostrata.functions import file_date_parts, link_file_name, normalize_name, strip_accents


def _by_definition(text):
    decomposed = unicodedata.normalize("NFD", text)
    return "".join(c for c in decomposed if unicodedata.category(c) != "Mn")


def _apply(spark, function, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function("v")).collect()]


def test_strip_accents_cases(spark):
    given_ = ["ACRELÂNDIA", None, "", "São Tomé", "ã", "đ ß ø", "ãÇẽ", "MARÇO"]
    assert _apply(spark, strip_accents, given_) == [
        "ACRELANDIA", None, "", "Sao Tome", "a", "đ ß ø", "aCe", "MARCO",
    ]


def test_strip_accents_over_all_letters(spark):
    """Equal to the definition for every assigned code point, Hangul and compound signs included."""
    letters = [
        char
        for char in map(chr, [*range(0x20, 0xD800), *range(0xF900, 0x20000), *range(0x2F800, 0x2FA20)])
        if unicodedata.category(char) not in ("Cn", "Cs", "Co")
    ]
    words = ["".join(f"{c}a" for c in letters[i : i + 500]) for i in range(0, len(letters), 500)]
    assert len(words) > 100
    assert _apply(spark, strip_accents, words) == [_by_definition(w) for w in words]


def test_strip_accents_of_hangul_and_compound_signs(spark):
    given_ = ["한국 Seoul", "각", "\u0958", "\u09cb x", "\U0001d15e", "ㄱ é"]
    assert _apply(spark, strip_accents, given_) == [_by_definition(t) for t in given_]
    df = spark.createDataFrame([("한",)], "v string").select(strip_accents("v"))
    assert "Python" not in df._jdf.queryExecution().toString()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs", "Cc"])),
        min_size=1,
        max_size=30,
    )
)
def test_strip_accents_property(spark, texts):
    assert _apply(spark, strip_accents, texts) == [_by_definition(t) for t in texts]


def test_normalize_name(spark):
    given_ = [" São  João d'Aliança ", "XIQUE-XIQUE", "ACRELÂNDIA", None, "--"]
    assert _apply(spark, normalize_name, given_) == [
        "SAO JOAO DALIANCA", "XIQUEXIQUE", "ACRELANDIA", None, "",
    ]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("D_Frota_por_UF_Municipio_COMBUSTIVEL_Abril_2024.xlsx", ("ABRIL", 2024)),
        ("D_Frota_Março_2025.xlsx", ("MARCO", 2025)),
        ("D_Frota_Mar%C3%A7o_2025.xlsx", ("MARCO", 2025)),
        ("D_Frota_Março_2025.xlsx", ("MARCO", 2025)),
        ("D_Frota_MARÇO_2025.xlsx", ("MARCO", 2025)),
        ("100%_Abril_2024.xlsx", ("ABRIL", 2024)),
        ("combustivel_3.xlsx", (None, None)),
        ("D_Frota_Abril_24.xlsx", (None, None)),
        (None, (None, None)),
    ],
)
def test_file_date_parts(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string").select(*file_date_parts("n"))
    assert tuple(df.first()) == expected


def test_link_file_name(spark):
    links = [("http://x/a/b.xlsx", 0), ("http://x/a/b.XLSX", 1), ("b.xlsx", 2), ("http://x/a/", 3)]
    df = spark.createDataFrame(links, "h string, i int")
    names = [r[0] for r in df.orderBy("i").select(link_file_name(F.col("h"), F.col("i"))).collect()]
    assert names == ["b.xlsx", "combustivel_1.xlsx", "b.xlsx", "combustivel_3.xlsx"]
