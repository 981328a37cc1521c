"""The named queries in plain SQL, written against the test tables alone."""

from __future__ import annotations

from autostrata import seeds

# The raw layer (see adapter.py) and the silver layer as common table expressions.
# The fixed lists as SQL literals.
_STATE_ROWS = ", ".join(f"('{code}', '{name}', '{region}')" for code, name, region in seeds.STATES)
_STATE_CODES = "[" + ", ".join(f"'{code}'" for code, _, _ in seeds.STATES) + "]"
_STATE_NAMES = "[" + ", ".join(f"'{name}'" for _, name, _ in seeds.STATES) + "]"
_FUEL_ROWS = ", ".join(
    f"('{fuel}', '{group}')" for group, fuels in seeds.FUELS_BY_GROUP.items() for fuel in fuels
)
_FUEL_NAMES = (
    "[" + ", ".join(f"'{f}'" for fuels in seeds.FUELS_BY_GROUP.values() for f in fuels)
    + ", 'COMBUSTIVEL NOVO']"
)
_FUEL = f"{_FUEL_NAMES}[(CAST(split_part(p_brand, '#', 2) AS INTEGER) * 7 + p_size) % 30 + 1]"

STATES = f"""
states AS (
  SELECT * FROM (VALUES {_STATE_ROWS}) AS t(sigla_uf, nm_uf, nm_regiao)
)"""

FUELS = f"""
fuels AS (
  SELECT nm_combustivel, nm_grupo, nm_grupo <> 'Não Identificado' AS fl_identificado
  FROM (VALUES {_FUEL_ROWS}) AS t(nm_combustivel, nm_grupo)
  WHERE nm_combustivel IN (SELECT {_FUEL} FROM part)
)"""

MUNICIPALITIES = f"""
rfb AS (
  SELECT CAST(s_suppkey AS INTEGER) AS id_municipio,
         CASE WHEN s_suppkey = 0 THEN '0'
              WHEN s_acctbal < 0 THEN NULL
              ELSE CAST(s_suppkey + 1000000 AS VARCHAR) END AS cd_municipio,
         ' ' || translate(
           upper(CASE WHEN s_acctbal > 9500 THEN s_name || right(s_name, 1) ELSE s_name END),
           'UEI', 'ÚÉÍ') || ' ' AS nm_municipio_upper,
         s_name AS nm_municipio_formatted,
         CASE WHEN s_suppkey = 0 THEN 'EX'
              ELSE ' ' || lower({_STATE_CODES}[s_nationkey + 1]) END AS sigla_uf
  FROM supplier
  WHERE s_acctbal <= 9000 OR s_acctbal > 9500
)"""

FLEET = f"""
fleet AS (
  SELECT strip_accents({_STATE_NAMES}[s_nationkey + 1]) AS nm_uf, upper(s_name) AS nm_municipio,
         {_FUEL} AS nm_combustivel,
         CAST(sum(l_quantity) AS INTEGER) AS qtd_veiculos,
         year(l_shipdate) AS y, month(l_shipdate) AS m,
         'D_Frota_por_UF_Municipio_COMBUSTIVEL_' || CASE month(l_shipdate)
           WHEN 1 THEN 'Janeiro' WHEN 2 THEN 'Fevereiro' WHEN 3 THEN 'Março'
           WHEN 4 THEN 'Abril' WHEN 5 THEN 'Maio' WHEN 6 THEN 'Junho'
           WHEN 7 THEN 'Julho' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Setembro'
           WHEN 10 THEN 'Outubro' WHEN 11 THEN 'Novembro' ELSE 'Dezembro' END
         || '_' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' AS nm_file
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY s_suppkey, s_name, s_nationkey, {_FUEL}, year(l_shipdate), month(l_shipdate)
)"""

REGISTERED = """
registered AS (
  SELECT cd_municipio AS cd_ibge_municipio, trim(nm_municipio_upper) AS nm_municipio_upper,
         upper(trim(sigla_uf)) AS sigla_uf, nm_municipio_formatted,
         strip_accents(trim(nm_municipio_upper)) AS nm_municipio_norm,
         regexp_replace(upper(strip_accents(trim(nm_municipio_upper))), '[^A-Z0-9 ]', '', 'g')
           AS nm_chave
  FROM rfb
)"""

WITH_STATE = """
with_state AS (
  SELECT r.nm_municipio_norm, s.nm_uf, r.cd_ibge_municipio, r.nm_municipio_formatted,
         s.sigla_uf, s.nm_regiao
  FROM registered r LEFT JOIN states s ON r.sigla_uf = s.sigla_uf
)"""

DIM_MUNICIPIO = """
dim_municipio AS (
  SELECT CAST(row_number() OVER (ORDER BY sigla_uf NULLS FIRST, nm_municipio_norm NULLS FIRST,
                                 cd_ibge_municipio NULLS FIRST) AS INTEGER) AS id_municipio,
         cd_ibge_municipio, nm_municipio_norm, nm_municipio_formatted, nm_uf, sigla_uf, nm_regiao
  FROM with_state
  WHERE cd_ibge_municipio IS NOT NULL AND cd_ibge_municipio <> '0'
)"""

DIM_COMBUSTIVEL = """
dim_combustivel AS (
  SELECT CAST(row_number() OVER (ORDER BY nm_grupo, nm_combustivel) AS INTEGER) AS id_combustivel,
         nm_combustivel, nm_grupo, fl_identificado
  FROM fuels
)"""

MATCHES = """
matches AS (
  SELECT f.nm_uf, f.nm_municipio, strip_accents(f.nm_municipio) AS nm_municipio_norm,
         s.sigla_uf, r.cd_ibge_municipio, r.nm_municipio_formatted,
         r.nm_chave IS NOT NULL AS fl_encontrado,
         (SELECT count(*) FROM registered c
          WHERE c.nm_chave = r.nm_chave AND c.sigla_uf = r.sigla_uf) AS qt_candidatos,
         regexp_replace(upper(strip_accents(f.nm_municipio)), '[^A-Z0-9 ]', '', 'g') AS nm_chave
  FROM (SELECT DISTINCT nm_uf, nm_municipio FROM fleet) f
  LEFT JOIN states s ON strip_accents(f.nm_uf) = strip_accents(s.nm_uf)
  LEFT JOIN registered r
    ON r.sigla_uf = s.sigla_uf
   AND r.nm_chave = regexp_replace(upper(strip_accents(f.nm_municipio)), '[^A-Z0-9 ]', '', 'g')
)"""

ROWS = """
fact AS (
  SELECT d.id_municipio, c.id_combustivel, CAST(f.y * 100 + f.m AS INTEGER) AS id_data,
         f.qtd_veiculos AS qt_veiculos, f.nm_file,
         d.nm_municipio_formatted, d.cd_ibge_municipio, d.sigla_uf, d.nm_uf, d.nm_regiao,
         c.nm_grupo, c.fl_identificado
  FROM fleet f
  LEFT JOIN dim_municipio d
    ON strip_accents(d.nm_uf) = f.nm_uf
   AND upper(strip_accents(d.nm_municipio_norm)) = f.nm_municipio
  LEFT JOIN dim_combustivel c ON c.nm_combustivel = f.nm_combustivel
)"""

LINKS = r"""
tags AS (
  SELECT page_id,
         regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
           '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'),
           '(?is)<style\b[^>]*>.*?</style\s*>', '', 'g') AS html
  FROM pages
)"""

_LISTED = [STATES, MUNICIPALITIES, REGISTERED, WITH_STATE]
_MATCHED = [STATES, MUNICIPALITIES, REGISTERED, FLEET, MATCHES]
_FACT = [*_LISTED, FUELS, FLEET, DIM_MUNICIPIO, DIM_COMBUSTIVEL, ROWS]


def _query(ctes: list[str], body: str) -> str:
    return f"WITH {','.join(ctes)}\n{body}" if ctes else body


def _links(inside: str, condition: str) -> str:
    """Links of each page's ``inside`` text that meet ``condition``, numbered from 0."""
    return rf"""
, anchors AS (
  SELECT page_id,
         regexp_extract_all({inside}, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1) AS hrefs
  FROM tags
), decoded AS (
  SELECT page_id, list_transform(hrefs, lambda h: replace(replace(replace(replace(replace(
           h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS hrefs
  FROM anchors
), kept AS (
  SELECT page_id, list_filter(hrefs, lambda h: h <> '' AND {condition}) AS hrefs FROM decoded
), links AS (
  SELECT page_id, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS nr_posicao,
         unnest(hrefs) AS href
  FROM kept
)"""


_NAV = r"regexp_extract(html, '(?is)<nav\b[^>]*>(.*?)</nav>', 1)"
_BODY = r"regexp_extract(html, '(?is)<body\b[^>]*>(.*)', 1)"
_FILE_NAME = (
    "CASE WHEN split_part(href, '/', -1) LIKE '%.xlsx' THEN split_part(href, '/', -1) "
    "ELSE 'combustivel_' || CAST(nr_posicao AS VARCHAR) || '.xlsx' END AS nm_file"
)

_STATE_SUM = (
    "SELECT sigla_uf, nm_uf, id_data, CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos "
    "FROM fact {where} GROUP BY sigla_uf, nm_uf, id_data"
)
_GROUP_SUM = (
    "SELECT nm_grupo, nm_regiao, id_data, CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos "
    "FROM fact {where} GROUP BY nm_grupo, nm_regiao, id_data"
)
_QUALITY = """
quality AS (
  SELECT sigla_uf, nm_uf, id_data, count(*) AS qt_registros,
         count(*) FILTER (nm_grupo = 'Não Identificado') AS qt_registros_nao_identificados,
         round(100.0::DOUBLE * count(*) FILTER (nm_grupo = 'Não Identificado') / count(*), 2)
           AS pc_registros_nao_identificados,
         CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos,
         CAST(coalesce(sum(qt_veiculos) FILTER (nm_grupo = 'Não Identificado'), 0) AS BIGINT)
           AS qt_veiculos_nao_identificados,
         round(100.0::DOUBLE
               * coalesce(sum(qt_veiculos) FILTER (nm_grupo = 'Não Identificado'), 0)
               / sum(qt_veiculos), 2) AS pc_veiculos_nao_identificados
  FROM fact GROUP BY sigla_uf, nm_uf, id_data
)"""

ORACLE: dict[str, str] = {
    "bronze_fleet": _query(
        [FLEET], "SELECT nm_uf, nm_municipio, nm_combustivel, qtd_veiculos, nm_file FROM fleet"
    ),
    "fleet_csv_load": _query(
        [FLEET], "SELECT nm_uf, nm_municipio, nm_combustivel, qtd_veiculos, nm_file FROM fleet"
    ),
    "year_filter": _query(
        [FLEET],
        "SELECT nm_uf, nm_municipio, nm_combustivel, qtd_veiculos, nm_file, "
        "CAST(y AS INTEGER) AS nr_ano FROM fleet WHERE y IN (1996, 1997)",
    ),
    "municipality_csv_load": _query([MUNICIPALITIES], "SELECT * FROM rfb"),
    "rejected_csv_lines": _query(
        [FLEET],
        """
SELECT nm_uf, nm_municipio, nm_combustivel,
       CASE WHEN qtd_veiculos % 7 <> 1 THEN qtd_veiculos END AS qtd_veiculos,
       CASE WHEN qtd_veiculos % 11 <> 1 THEN nm_file
            WHEN qtd_veiculos % 13 = 1 THEN 'extra' END AS nm_file,
       concat_ws(',', nm_uf, nm_municipio, nm_combustivel,
                 qtd_veiculos || CASE WHEN qtd_veiculos % 7 = 1 THEN '.0' ELSE '' END,
                 CASE WHEN qtd_veiculos % 11 <> 1 THEN nm_file END,
                 CASE WHEN qtd_veiculos % 13 = 1 THEN 'extra' END) AS tx_linha
FROM fleet
WHERE qtd_veiculos % 7 = 1
   OR (qtd_veiculos % 11 = 1) <> (qtd_veiculos % 13 = 1)""",
    ),
    "full_load_tables": _query(
        [FLEET],
        "SELECT nm_uf, nm_municipio, nm_combustivel, qtd_veiculos, nm_file, "
        "strip_accents(nm_uf) AS nm_uf_norm FROM fleet",
    ),
    "years_replaced": _query(
        [FLEET],
        "SELECT nm_uf, nm_municipio, nm_combustivel, qtd_veiculos, nm_file, "
        "CAST(y AS INTEGER) AS nr_ano FROM fleet",
    ),
    "consolidated_files": """
SELECT s_name AS nome, s_nationkey AS uf, s_acctbal, NULL AS c_mktsegment,
       'fornecedor+uf.csv' AS nm_file, CAST(2024 AS INTEGER) AS nr_ano
FROM supplier
UNION ALL
SELECT c_name, c_nationkey, NULL, c_mktsegment, 'cliente.csv', 2024 FROM customer""",
    "uf_lookup": _query(
        [STATES, FLEET],
        """
SELECT f.nm_municipio, f.nm_uf, strip_accents(f.nm_municipio) AS nm_municipio_norm, s.sigla_uf
FROM (SELECT DISTINCT nm_municipio, nm_uf FROM fleet) f
LEFT JOIN states s ON strip_accents(f.nm_uf) = strip_accents(s.nm_uf)""",
    ),
    "registered_with_state": _query(_LISTED, "SELECT * FROM with_state"),
    "dim_municipio": _query([*_LISTED, DIM_MUNICIPIO], "SELECT * FROM dim_municipio"),
    "dim_municipio_gapped": _query(
        _LISTED,
        """
SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY sigla_uf NULLS FIRST, nm_municipio_norm NULLS FIRST,
                                 cd_ibge_municipio NULLS FIRST) AS INTEGER) AS id_municipio,
         cd_ibge_municipio, nm_municipio_norm, nm_municipio_formatted, nm_uf, sigla_uf, nm_regiao
  FROM with_state
) WHERE cd_ibge_municipio <> '0'""",
    ),
    "dim_combustivel": _query([FUELS, DIM_COMBUSTIVEL], "SELECT * FROM dim_combustivel"),
    "dim_data": _query(
        [FLEET],
        """
SELECT DISTINCT CAST(y * 100 + m AS INTEGER) AS id_data,
       regexp_extract(nm_file, '_([^_]+)_\\d{4}\\.xlsx$', 1) AS nm_mes,
       CAST(m AS INTEGER) AS nr_mes, CAST(y AS INTEGER) AS nr_ano, make_date(y, m, 1) AS dt_referencia
FROM fleet""".replace("\\\\", "\\"),
    ),
    "fato_frota": _query(
        _FACT,
        """
SELECT row_number() OVER (ORDER BY id_data NULLS FIRST, id_municipio NULLS FIRST,
                          id_combustivel NULLS FIRST, nm_file, qt_veiculos) AS id_fato,
       id_municipio, id_combustivel, id_data, qt_veiculos, nm_file
FROM fact""",
    ),
    "unmapped_fuel": _query(
        [FUELS, FLEET],
        """
SELECT DISTINCT nm_combustivel FROM fleet f
WHERE NOT EXISTS (SELECT 1 FROM fuels u WHERE u.nm_combustivel = f.nm_combustivel)""",
    ),
    "unmapped_fuel_count": _query(
        [FUELS, FLEET],
        """
SELECT count(DISTINCT nm_combustivel) AS qt_sem_mapeamento FROM fleet f
WHERE NOT EXISTS (SELECT 1 FROM fuels u WHERE u.nm_combustivel = f.nm_combustivel)""",
    ),
    "null_code_audit": _query(
        _LISTED,
        """
SELECT count(*) AS qt_total, count(*) FILTER (cd_ibge_municipio IS NULL) AS qt_sem_codigo,
       round(100.0::DOUBLE * count(*) FILTER (cd_ibge_municipio IS NULL) / count(*), 2)
         AS pc_sem_codigo
FROM with_state""",
    ),
    "null_code_listing": _query(
        _LISTED,
        """
SELECT * FROM with_state WHERE cd_ibge_municipio IS NULL
ORDER BY nm_uf NULLS FIRST, nm_municipio_norm NULLS FIRST, nm_municipio_formatted NULLS FIRST""",
    ),
    "exterior_filter": _query(
        _LISTED, "SELECT * FROM with_state WHERE cd_ibge_municipio <> '0'"
    ),
    "topn_sorted": _query(
        [*_LISTED, DIM_MUNICIPIO],
        "SELECT * FROM dim_municipio ORDER BY sigla_uf NULLS FIRST, "
        "nm_municipio_norm NULLS FIRST LIMIT 10",
    ),
    "municipality_match": _query(_MATCHED, "SELECT * EXCLUDE (nm_chave) FROM matches"),
    "unmatched_municipalities": _query(
        _MATCHED,
        "SELECT nm_uf, nm_municipio, nm_municipio_norm, sigla_uf FROM matches "
        "WHERE NOT fl_encontrado",
    ),
    "match_audit": _query(
        _MATCHED,
        """
SELECT count(*) AS qt_total, count(*) FILTER (NOT fl_encontrado) AS qt_sem_match,
       round(100.0::DOUBLE * count(*) FILTER (NOT fl_encontrado) / count(*), 2) AS pc_sem_match,
       count(*) FILTER (qt_candidatos > 1) AS qt_ambiguos
FROM matches""",
    ),
    "fuzzy_match": _query(
        _MATCHED,
        """
SELECT DISTINCT u.sigla_uf, u.nm_chave, nm_candidato, b.cd_ibge_municipio, nr_distancia
FROM matches u LEFT JOIN (SELECT * FROM (
  SELECT m.sigla_uf, m.nm_chave, r.nm_chave AS nm_candidato, r.cd_ibge_municipio,
         CAST(levenshtein(m.nm_chave, r.nm_chave) AS INTEGER) AS nr_distancia,
         row_number() OVER (PARTITION BY m.sigla_uf, m.nm_chave
           ORDER BY levenshtein(m.nm_chave, r.nm_chave), r.nm_chave,
                    r.cd_ibge_municipio NULLS FIRST) AS nr
  FROM matches m JOIN registered r ON r.sigla_uf = m.sigla_uf
  WHERE NOT m.fl_encontrado AND levenshtein(m.nm_chave, r.nm_chave) <= 2
) WHERE nr = 1) b ON b.sigla_uf = u.sigla_uf AND b.nm_chave = u.nm_chave
WHERE NOT u.fl_encontrado""",
    ),
    "bad_file_names": _query([FLEET, LINKS], _links(
        _NAV, "contains(lower(h), 'the')"
    ).lstrip() + f"""
SELECT DISTINCT nm_file
FROM (SELECT {_FILE_NAME} FROM links UNION ALL SELECT nm_file FROM fleet)
WHERE NOT regexp_matches(nm_file, '_(Janeiro|Fevereiro|Marco|Março|Abril|Maio|Junho|Julho|Agosto|'
  || 'Setembro|Outubro|Novembro|Dezembro)_[0-9]{{4}}\\.xlsx')"""),
    "fato_orphans": _query(
        _FACT,
        """
SELECT count(*) AS qt_registros,
       count(*) FILTER (id_municipio IS NULL) AS qt_sem_municipio,
       count(*) FILTER (id_combustivel IS NULL) AS qt_sem_combustivel,
       count(*) FILTER (id_data IS NULL) AS qt_sem_data
FROM fact""",
    ),
    "duplicated_grain": _query(
        _FACT,
        """
SELECT id_municipio, id_combustivel, id_data, count(*) AS qt_registros,
       CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos
FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE id_data % 100 = 4)
GROUP BY id_municipio, id_combustivel, id_data HAVING count(*) > 1""",
    ),
    "ambiguous_municipalities": _query(
        [
            MUNICIPALITIES,
            """
coarse AS (
  SELECT cd_municipio AS cd_ibge_municipio,
         strip_accents(left(trim(nm_municipio_upper), 16)) AS nm_municipio_norm,
         regexp_replace(upper(strip_accents(left(trim(nm_municipio_upper), 16))), '[^A-Z0-9 ]',
                        '', 'g') AS nm_chave,
         nm_municipio_formatted, upper(trim(sigla_uf)) AS sigla_uf
  FROM rfb
)""",
        ],
        """
SELECT * FROM (
  SELECT *, count(*) OVER (PARTITION BY nm_chave, sigla_uf) AS qt_candidatos FROM coarse
) WHERE qt_candidatos > 1""",
    ),
    "homonyms": """
SELECT p_name, count(DISTINCT p_brand) AS qt_grupos FROM part
GROUP BY p_name HAVING count(DISTINCT p_brand) > 1""",
    "quality_alert": _query(
        [*_FACT, _QUALITY],
        "SELECT * FROM quality WHERE pc_registros_nao_identificados > 30",
    ),
    "gold_eletrica_hibrida": _query(
        _FACT, _STATE_SUM.format(where="WHERE nm_grupo IN ('Elétrico Puro', 'Híbrido')")
    ),
    "gold_eletrica": _query(_FACT, _STATE_SUM.format(where="WHERE nm_grupo = 'Elétrico Puro'")),
    "gold_grupo_regiao": _query(_FACT, _GROUP_SUM.format(where="")),
    "gold_grupo_regiao_identificados": _query(
        _FACT, _GROUP_SUM.format(where="WHERE fl_identificado")
    ),
    "gold_qualidade": _query([*_FACT, _QUALITY], "SELECT * FROM quality"),
    "gold_ranking": _query(
        _FACT,
        """
SELECT nm_grupo, nr_posicao, id_municipio, nm_municipio_formatted, sigla_uf, id_data, qt_veiculos
FROM (
  SELECT nm_grupo, id_municipio, nm_municipio_formatted, sigla_uf, id_data,
         CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos,
         CAST(row_number() OVER (PARTITION BY nm_grupo
           ORDER BY sum(qt_veiculos) DESC, id_municipio) AS INTEGER) AS nr_posicao
  FROM fact
  WHERE id_municipio IS NOT NULL AND id_data = (SELECT max(id_data) FROM fact)
  GROUP BY nm_grupo, id_municipio, nm_municipio_formatted, sigla_uf, id_data
) WHERE nr_posicao <= 10""",
    ),
    "gold_regiao": _query(
        _FACT,
        "SELECT nm_regiao, id_data, CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos "
        "FROM fact GROUP BY nm_regiao, id_data",
    ),
    "gold_estado_mes": _query(_FACT, _STATE_SUM.format(where="")),
    "gold_flex_vs_combustao": _query(
        _FACT,
        """
SELECT nm_regiao, id_data,
       CAST(sum(qt_veiculos) FILTER (nm_grupo = 'Flex') AS BIGINT) AS qt_flex,
       CAST(sum(qt_veiculos) FILTER (nm_grupo IN ('Combustão Fóssil', 'Combustão Renovável'))
         AS BIGINT) AS qt_combustao
FROM fact GROUP BY nm_regiao, id_data""",
    ),
    "per_capita": _query(
        _FACT,
        """
SELECT t.*, p.populacao_estimada,
       CAST(t.qt_veiculos AS DOUBLE) / p.populacao_estimada AS veiculos_por_habitante
FROM (
  SELECT cd_ibge_municipio, nm_municipio_formatted, sigla_uf, id_data,
         CAST(sum(qt_veiculos) AS BIGINT) AS qt_veiculos
  FROM fact WHERE id_municipio IS NOT NULL
  GROUP BY id_municipio, cd_ibge_municipio, nm_municipio_formatted, sigla_uf, id_data
) t
LEFT JOIN (
  SELECT CAST(s_suppkey + 1000000 AS VARCHAR) AS cd_ibge_municipio,
         nullif(CAST(floor(abs(s_acctbal)) AS INTEGER), 0) AS populacao_estimada
  FROM supplier
) p USING (cd_ibge_municipio)""",
    ),
    "strip_accents": "SELECT doc_id, strip_accents(text) AS text_norm FROM documents",
    "normalize_name": _query(
        [MUNICIPALITIES, REGISTERED],
        "SELECT CAST(regexp_extract(nm_municipio_formatted, '[0-9]+') AS INTEGER) AS id_municipio, "
        "nm_chave FROM registered",
    ),
    "page_links": _query(
        [LINKS], _links(_BODY, "true").lstrip() + "\nSELECT * FROM links"
    ),
    "link_file_names": _query(
        [LINKS],
        _links(_NAV, "contains(lower(h), 'the')").lstrip()
        + f"\nSELECT page_id, nr_posicao, href, {_FILE_NAME} FROM links",
    ),
}
