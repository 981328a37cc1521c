"""File sources and table sinks."""

import pytest
from pyspark.sql import functions as F

from autostrata.plans import jobs
from autostrata.sources import tables
from autostrata.sources import (
    consolidate,
    file_headers,
    full_load,
    read_fleet,
    read_municipalities,
    read_yearly,
    save_table,
    select_years,
    use_layer,
    write_yearly,
    yearly_layouts,
)

FLEET_CSV = """nm_uf,nm_municipio,nm_combustivel,qtd_veiculos,file_name
ACRE,ACRELANDIA,GASOLINA,12,D_Frota_por_UF_Municipio_COMBUSTIVEL_Abril_2024.xlsx
ACRE,,ELETRICO,12.0,f
SAO PAULO,SAO PAULO,Sem Informação,x,f
SHORT,LINE
ACRE,ACRELANDIA,DIESEL,3,f,extra
"""

MUNICIPALITY_CSV = """id;cd;upper;formatted;uf
1;1200013;ACRELÂNDIA;Acrelândia;AC
2;3550308; SÃO PAULO ;São Paulo;sp
4;;SEM CODIGO;Sem Codigo;AC
"""


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_read_fleet_by_glob(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FLEET_CSV, encoding="utf-8")
    (tmp_path / "b.csv").write_text("h1,h2,h3,h4,h5\nBAHIA,SALVADOR,DIESEL,5,g\n")
    (tmp_path / "c.txt").write_text("not read")
    df = read_fleet(spark, f"{tmp_path}/*.csv")
    assert df.dtypes == [
        ("nm_uf", "string"), ("nm_municipio", "string"), ("nm_combustivel", "string"),
        ("qtd_veiculos", "int"), ("nm_file", "string"),
    ]
    april = "D_Frota_por_UF_Municipio_COMBUSTIVEL_Abril_2024.xlsx"
    assert _rows(df) == sorted(
        [
            ("ACRE", "ACRELANDIA", "GASOLINA", 12, april),
            ("ACRE", None, "ELETRICO", None, "f"),
            ("SAO PAULO", "SAO PAULO", "Sem Informação", None, "f"),
            ("SHORT", "LINE", None, None, None),
            ("ACRE", "ACRELANDIA", "DIESEL", 3, "f"),
            ("BAHIA", "SALVADOR", "DIESEL", 5, "g"),
        ],
        key=str,
    )


def test_malformed_lines_can_be_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FLEET_CSV, encoding="utf-8")
    df = read_fleet(spark, str(tmp_path), malformed="linha")
    bad = [r.linha for r in df.cache().where(F.col("linha").isNotNull()).collect()]
    assert sorted(bad) == sorted(FLEET_CSV.splitlines()[2:])


def test_header_check(spark, tmp_path):
    right, wrong = tmp_path / "right.csv", tmp_path / "wrong.csv"
    line = "ACRE,ACRELANDIA,DIESEL,3,f\n"
    right.write_text("nm_uf,nm_municipio,nm_combustivel,qtd_veiculos,nm_file\n" + line)
    wrong.write_text("nm_municipio,nm_uf,nm_combustivel,qtd_veiculos,nm_file\n" + line)
    assert read_fleet(spark, str(right), check_header=True).count() == 1
    assert len(read_fleet(spark, str(wrong)).collect()) == 1
    with pytest.raises(Exception, match="(?i)header"):
        read_fleet(spark, str(wrong), check_header=True).collect()


def test_read_municipalities_latin1(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes(MUNICIPALITY_CSV.encode("iso-8859-1"))
    assert _rows(read_municipalities(spark, f"{tmp_path}/m.csv")) == sorted(
        [
            (1, "1200013", "ACRELÂNDIA", "Acrelândia", "AC"),
            (2, "3550308", " SÃO PAULO ", "São Paulo", "sp"),
            (4, None, "SEM CODIGO", "Sem Codigo", "AC"),
        ],
        key=str,
    )


def test_consolidate_aligns_by_name_and_names_the_file(spark, tmp_path):
    for folder, name, text in [
        ("x", "D Frota_Abril_2024.csv", "uf,qtd\nAC,1\n"),
        ("x", "Março_2024.csv", "uf,qtd\nAL,2\n"),
        ("y", "Maio_2024.csv", "qtd,uf,obs\n3,AM,new\n"),
    ]:
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text, encoding="utf-8")
    df = consolidate(spark, [f"{tmp_path}/x", [f"{tmp_path}/y/Maio_2024.csv"]])
    assert df.columns == ["uf", "qtd", "nm_file", "obs"]
    assert _rows(df) == [
        ("AC", "1", "D Frota_Abril_2024.csv", None),
        ("AL", "2", "Março_2024.csv", None),
        ("AM", "3", "Maio_2024.csv", "new"),
    ]


def test_consolidate_refuses_a_strange_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("uf,qtd\nAC,1\n")
    (tmp_path / "b.csv").write_text("qtd,uf\n2,AL\n")
    with pytest.raises(Exception, match="(?i)header"):
        consolidate(spark, [str(tmp_path)]).collect()


@pytest.mark.parametrize("years", [None, [2024, 2025]])
def test_consolidate_years(spark, tmp_path, years):
    source, output = tmp_path / "raw", f"{tmp_path}/out"
    for year, name in [(2024, "x_Abril_2024.csv"), (2024, "x_Maio_2024.csv"), (2025, "y.csv")]:
        (source / str(year)).mkdir(parents=True, exist_ok=True)
        (source / str(year) / name).write_text(f"uf,qtd\nAC,{year}\n")
    (source / "notes").mkdir()
    (source / "notes" / "n.csv").write_text("no,year\n1,2\n")
    jobs.consolidate_years(spark, str(source), output, years)
    written = spark.read.option("header", True).csv(output)
    assert _rows(written.select("uf", "qtd", "nm_file", "nr_ano")) == [
        ("AC", "2024", "x_Abril_2024.csv", 2024),
        ("AC", "2024", "x_Maio_2024.csv", 2024),
        ("AC", "2025", "y.csv", 2025),
    ]


def test_yearly_layout_prunes_folders(spark, tmp_path):
    rows = [("A", "B", "C", year, "f", year) for year in (2024, 2025, 2026) for _ in range(2)]
    # Columns in another order than the declared one must not end up in the wrong field.
    df = spark.createDataFrame(
        rows, "nm_uf string, nm_municipio string, nm_combustivel string, qtd_veiculos int, "
        "nm_file string, nr_ano int",
    ).select("nr_ano", "nm_file", "qtd_veiculos", "nm_combustivel", "nm_municipio", "nm_uf")
    path = f"{tmp_path}/yearly"
    write_yearly(df, path)
    picked = read_yearly(spark, path, [2024, 2026])
    assert _rows(picked) == [("A", "B", "C", y, "f", y) for y in (2024, 2024, 2026, 2026)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [nr_ano" in plan
    assert read_yearly(spark, path).count() == 6
    assert select_years(df, [2025]).count() == 2
    assert select_years(df, None).count() == 6


@pytest.fixture
def layer(spark):
    use_layer(spark, "camada_teste")
    yield "camada_teste"
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP DATABASE camada_teste CASCADE")


def test_full_load_replaces_table_and_schema(spark, layer):
    assert spark.catalog.currentDatabase() == layer
    first = full_load(spark.range(3), f"{layer}.t")
    assert first.count() == 3
    second = full_load(spark.range(2).select(F.lit("x").alias("c")), "t")
    assert second.columns == ["c"] and second.count() == 2


def test_save_table_can_read_the_table_it_replaces(spark, layer):
    save_table(spark.range(4), f"{layer}.t")
    save_table(spark.table("t").withColumn("double", F.col("id") * 2), f"{layer}.t")
    assert _rows(spark.table("t")) == [(i, 2 * i) for i in range(4)]


def test_full_load_from_its_own_table(spark, layer):
    table = f"{layer}.carga"
    full_load(spark.range(3), table)
    again = full_load(spark.table(table).union(spark.range(5, 6)), table)
    assert sorted(r.id for r in again.collect()) == [0, 1, 2, 5]


def test_failed_load_leaves_the_table(spark, layer):
    table = f"{layer}.carga"
    full_load(spark.range(3), table)
    with pytest.raises(Exception, match="boom"):
        full_load(spark.range(1).select(F.raise_error(F.lit("boom")).alias("id")), table)
    assert spark.table(table).count() == 3


@pytest.mark.parametrize("step", ["aside", "fresh"])
def test_load_that_fails_between_the_steps_keeps_the_old_table(spark, layer, monkeypatch, step):
    table = f"{layer}.carga"
    full_load(spark.range(3), table)
    rename, broken = tables._rename, []

    def failing(session, old, new):
        if (new if step == "aside" else old).endswith(("__anterior", "__carga")) and not broken:
            broken.append(old)
            raise RuntimeError("no metastore")
        rename(session, old, new)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError, match="no metastore"):
        full_load(spark.range(7), table)
    assert spark.table(table).count() == 3
    assert [t.name for t in spark.catalog.listTables(layer)] == ["carga"]
    assert full_load(spark.range(7), table).count() == 7


def test_load_whose_driver_died_is_undone_by_the_next(spark, layer):
    table = f"{layer}.carga"
    full_load(spark.range(3), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__anterior")
    spark.range(1).write.saveAsTable(f"{table}__carga")
    tables.recover_load(spark, table)
    assert spark.table(table).count() == 3
    assert [t.name for t in spark.catalog.listTables(layer)] == ["carga"]


def test_external_load_keeps_one_folder(spark, layer, tmp_path):
    table, path = f"{layer}.carga", str(tmp_path / "ext")
    full_load(spark.range(3), table, path=path)
    again = full_load(spark.table(table).union(spark.range(9, 10)), table, path=path)
    assert sorted(r.id for r in again.collect()) == [0, 1, 2, 9]
    assert len(list((tmp_path / "ext").iterdir())) == 1
    spark.sql(f"DROP TABLE {table}")
    assert spark.read.parquet(f"{path}/*").count() == 4


def _month_files(root):
    for year, name, text in (
        ("2024", "a+b_Abril_2024.csv", "x,y\n1,2\n"),
        ("2024", "cç_Maio_2024.csv", "y,z\n3,4\n"),
        ("2024", "notes.txt", "q\n9\n"),
        ("2024_old", "d.csv", "x,y\n7,7\n"),
        ("2025", "e.csv", "x,y\n5,6\n"),
    ):
        (root / year).mkdir(parents=True, exist_ok=True)
        (root / year / name).write_text(text)
    (root / "2026").mkdir()


def test_consolidation_by_header_year_and_suffix(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    _month_files(root)
    layouts = yearly_layouts(spark, str(root), [2024, 2026, 2099])
    assert [len(group) for group in layouts] == [1, 1]
    rows = consolidate(spark, layouts, year="nr_ano").collect()
    assert {(r.nm_file, r.x, r.y, r.z, r.nr_ano) for r in rows} == {
        ("a+b_Abril_2024.csv", "1", "2", None, 2024),
        ("cç_Maio_2024.csv", None, "3", "4", 2024),
    }
    jobs.consolidate_years(spark, str(root), out, [2024])
    jobs.consolidate_years(spark, str(root), out, [2025])
    jobs.consolidate_years(spark, str(root), out, [2099])
    years = spark.read.option("header", "true").csv(out)
    assert {r.nr_ano for r in years.collect()} == {2024, 2025} and years.count() == 3
    jobs.consolidate_years(spark, str(root), str(tmp_path / "all"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "all")).count() == 3


def _jobs(spark, name, action):
    """How many jobs an action runs."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        result = action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return result, len(context.statusTracker().getJobIdsForGroup(name))


def test_headers_take_as_many_jobs_for_many_files_as_for_few(spark, tmp_path):
    counts = {}
    for files in (40, 400):
        root = tmp_path / f"r{files}"
        for year in (2023, 2024):
            (root / str(year)).mkdir(parents=True)
            for i in range(files // 2):
                header = "a,b" if i % 3 else "b,c"
                (root / str(year) / f"f {i:04d}+.csv").write_text(f"{header}\n" + f"{i},x\n" * (i % 5))
        (root / "2024" / "empty.csv").write_text("")
        (root / "2024_old").mkdir()
        (root / "2024_old" / "o.csv").write_text("z\n1\n")
        layouts, counts[files] = _jobs(spark, f"headers {files}", lambda: yearly_layouts(spark, str(root)))
        assert sorted(map(len, layouts)) == sorted(
            2 * sum(1 for i in range(files // 2) if bool(i % 3) == part) for part in (False, True)
        )
        rows = consolidate(spark, layouts, year="nr_ano")
        assert rows.count() == 2 * sum(i % 5 for i in range(files // 2))
        assert set(rows.columns) == {"a", "b", "c", "nm_file", "nr_ano"}
    assert counts[40] == counts[400]


def test_headers_of_one_year(spark, tmp_path):
    for year in ("2023", "02024", "x"):
        (tmp_path / year).mkdir()
        (tmp_path / year / "a b%41.csv").write_text(f"h{year},i\n1,2\n")
    found = file_headers(spark, str(tmp_path), [2024]).collect()
    assert [(r.nr_ano, r.header) for r in found] == [(2024, "h02024,i")]
    assert found[0].path.endswith("/02024/a b%41.csv")
