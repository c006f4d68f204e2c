"""SQL equivalents of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

from geolink.plans.territory import STATES

# Input tables, in dependency order; see standins.py.
PLACES = """
places AS (
  SELECT code7 AS municipio_codigo_7, substr(code7, 1, 6) AS municipio_codigo_6,
         n_name AS municipio_nome, substr(code7, 1, 2) AS uf_codigo,
         concat('U', cast(r_regionkey AS varchar)) AS uf_sigla, r_name AS uf_nome,
         cast(-70 AS double) + cast(1.5 AS double) * n_nationkey AS centroide_lon,
         cast(-30 AS double) + cast(1.25 AS double) * n_nationkey AS centroide_lat,
         cast(100 AS double) * (n_nationkey + 1) AS area_km2, n_nationkey
  FROM (SELECT n.*, r.*, concat(cast(r_regionkey + 11 AS varchar),
               lpad(cast(1000 + n_nationkey * 10 + n_nationkey % 10 AS varchar), 5, '0')) AS code7
        FROM nation n JOIN region r ON n_regionkey = r_regionkey) t)"""

CASES = (
    PLACES
    + """,
cases AS (
  SELECT o_orderkey AS case_id,
         CASE WHEN o_orderkey % 97 = 0 THEN concat(r.uf_codigo, '0000') ELSE r.municipio_codigo_6 END AS ID_MN_RESI,
         n.municipio_codigo_6 AS ID_MUNICIP,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '  '
              WHEN o_orderkey % 11 = 0 THEN substr(r.municipio_codigo_6, 1, 4)
              ELSE r.municipio_codigo_6 END AS ATE_MUNICI,
         CASE WHEN o_orderkey % 13 = 0 THEN '99' ELSE r.uf_codigo END AS SG_UF,
         n.uf_codigo AS SG_UF_NOT,
         CASE WHEN o_orderkey % 3 = 0 THEN r.uf_codigo ELSE '9' END AS ATE_UF_HOS,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL
              WHEN o_orderkey % 2 = 0 THEN concat(' ', lpad(cast(o_custkey AS varchar), 7, '0'), ' ')
              ELSE lpad(cast(o_custkey AS varchar), 7, '0') END AS ID_UNIDADE
  FROM orders JOIN customer c ON o_custkey = c_custkey
  JOIN places r ON c_nationkey = r.n_nationkey
  JOIN places n ON o_orderkey % 25 = n.n_nationkey)"""
)

REGISTRY = """
registry AS (
  SELECT CASE WHEN part_no = 3 THEN '0000001' WHEN c_custkey % 7 = 0 THEN concat('X', cast(c_custkey AS varchar))
              ELSE lpad(cast(c_custkey AS varchar), 7, '0') END AS CNES,
         CASE WHEN c_custkey % 37 = 0 THEN uf_codigo WHEN c_custkey % 41 = 0 THEN '0'
              WHEN part_no = 1 AND c_custkey % 4 = 0 THEN ' ' WHEN c_custkey % 53 = 0 THEN '000000'
              WHEN c_custkey % 31 = 0 THEN concat(uf_codigo, '9999')
              ELSE municipio_codigo_6 END AS CODUFMUN,
         CASE WHEN c_custkey % 37 = 0 OR c_custkey % 41 = 0 THEN '0'
              WHEN part_no = 1 AND c_custkey % 3 = 0 THEN NULL WHEN part_no = 1 AND c_custkey % 5 = 0 THEN chr(9)
              WHEN c_custkey % 29 = 0 THEN '00000000'
              ELSE concat(lpad(cast(10000 + c_custkey % 700 AS varchar), 5, '0'), '-',
                          lpad(cast(c_custkey % 2 AS varchar), 3, '0')) END AS COD_CEP,
         CASE WHEN part_no = 3 THEN '01' ELSE lpad(cast(c_custkey % 20 AS varchar), 2, '0') END AS TP_UNID,
         CASE WHEN part_no > 1 THEN substr('MED', c_custkey % 3 + 1, 1) END AS TPGESTAO,
         lpad(cast(c_custkey % 4 + 1 AS varchar), 2, '0') AS ESFERA_A, c_mktsegment AS NAT_JUR,
         CASE WHEN part_no = 1 AND c_custkey % 6 = 0 THEN ' ' ELSE '202601' END AS COMPETEN,
         c_custkey * 10 + part_no AS ord
  FROM customer JOIN places ON c_nationkey = n_nationkey
  CROSS JOIN (SELECT 1 AS part_no UNION ALL SELECT 2 UNION ALL SELECT 3) p)"""

CACHE = """
cache AS (
  SELECT CASE WHEN k % 700 % 9 = 0 THEN concat('X', cast(k AS varchar))
              ELSE concat(lpad(cast(10000 + k % 700 AS varchar), 5, '0'), lpad(cast(k % 2 AS varchar), 3, '0')) END AS cep_limpo,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN cast(-15.803258 AS double)
              ELSE centroide_lat + cast(0.03 AS double) * (k % 50 - 25) END AS latitude,
         CASE WHEN k % 10 = 0 THEN NULL WHEN k % 3 = 0 THEN cast(-47.885477 AS double) ELSE centroide_lon END AS longitude,
         CASE WHEN k % 10 = 0 THEN 'False' ELSE 'True' END AS geocode_success, k AS seq
  FROM (SELECT c_custkey AS k, centroide_lat, centroide_lon
        FROM customer JOIN places ON c_nationkey = n_nationkey) t)"""

RESULTS = """
results AS (
  SELECT concat(lpad(cast(10600 + s_suppkey % 300 AS varchar), 5, '0'), lpad(cast(s_suppkey % 2 AS varchar), 3, '0')) AS cep_limpo,
         CASE WHEN s_suppkey % 4 <> 0 THEN cast(-10 AS double) - cast(0.5 AS double) * s_nationkey END AS latitude,
         CASE WHEN s_suppkey % 4 <> 0 THEN cast(-50 AS double) + cast(0.5 AS double) * s_nationkey END AS longitude,
         CASE WHEN s_suppkey % 4 <> 0 THEN 'True' ELSE 'False' END AS geocode_success, s_suppkey AS seq
  FROM supplier)"""

NAMED = """
case_keys AS (
  SELECT DISTINCT trim(ID_UNIDADE) AS CNES FROM cases
  WHERE ID_UNIDADE IS NOT NULL AND trim(ID_UNIDADE) <> '')"""


def _first(column: str) -> str:
    return f"arg_min({column}, ord) FILTER (WHERE regexp_matches({column}, '[^ \t-\r]')) AS {column}"


CONSOLIDATED = f"""
consolidated AS (
  SELECT CNES, {_first("CODUFMUN")}, {_first("COD_CEP")}, {_first("TP_UNID")}, {_first("NAT_JUR")},
         {_first("TPGESTAO")}, {_first("ESFERA_A")}, {_first("COMPETEN")}
  FROM registry WHERE CNES IN (SELECT CNES FROM case_keys) GROUP BY CNES),
coded AS (
  SELECT *, length(cep_limpo) = 8 AND cep_limpo <> '00000000' AS cep_valido,
         length(municipio_codigo_6) = 6 AND municipio_codigo_6 <> '000000' AS municipio_valido,
         length(uf_codigo) = 2 AND uf_codigo <> '00' AS uf_valida
  FROM (SELECT *, substr(municipio_codigo_6, 1, 2) AS uf_codigo
        FROM (SELECT *, regexp_replace(cod_cep_t, '[^0-9]', '', 'g') AS cep_limpo,
                     substr(regexp_replace(codufmun_t, '[^0-9]', '', 'g'), 1, 6) AS municipio_codigo_6
              FROM (SELECT *, trim(coalesce(COD_CEP, '')) AS cod_cep_t,
                           trim(coalesce(CODUFMUN, '')) AS codufmun_t FROM consolidated) a) b) c),
facilities AS (
  SELECT CNES AS cnes_codigo, cod_cep_t AS cod_cep, cep_limpo, cep_valido, codufmun_t AS codufmun,
         municipio_codigo_6, municipio_valido, uf_codigo, uf_valida, TP_UNID AS tp_unid, NAT_JUR AS nat_jur,
         TPGESTAO AS tpgestao, ESFERA_A AS esfera_a, COMPETEN AS competen,
         CASE WHEN cep_valido THEN 'cep' WHEN municipio_valido THEN 'municipio' WHEN uf_valida THEN 'uf'
              ELSE 'sem_localizacao' END AS spatial_resolution_available,
         'cep' AS spatial_resolution_target, 'cep->municipio->uf' AS fallback_rule,
         '2026-01' AS cnes_competencia, 'CNES / DATASUS / ST' AS source_system,
         'CNES presentes no SINAN meningite' AS lookup_scope
  FROM coded)"""

FACILITIES = ",".join([CASES, REGISTRY, NAMED, CONSOLIDATED])

LOCATED = (
    ",".join([FACILITIES, CACHE])
    + """,
points AS (
  SELECT cep_limpo, latitude AS c_lat, longitude AS c_lon FROM cache
  QUALIFY row_number() OVER (PARTITION BY cep_limpo ORDER BY seq) = 1),
states AS (SELECT uf_codigo, avg(centroide_lat) AS uf_lat, avg(centroide_lon) AS uf_lon FROM places GROUP BY uf_codigo),
chosen AS (
  SELECT f.*, c_lat, c_lon, p.municipio_nome, p.uf_sigla, p.uf_nome, p.centroide_lat, p.centroide_lon, uf_lat, uf_lon,
         CASE WHEN c_lat IS NOT NULL AND c_lon IS NOT NULL THEN 'cep'
              WHEN p.centroide_lat IS NOT NULL THEN 'municipio'
              WHEN uf_lat IS NOT NULL THEN 'uf' END AS spatial_resolution_final
  FROM facilities f LEFT JOIN points USING (cep_limpo)
  LEFT JOIN places p ON f.municipio_codigo_6 = p.municipio_codigo_6 AND f.uf_codigo = p.uf_codigo
  LEFT JOIN states s ON f.uf_codigo = s.uf_codigo),
located AS (
  SELECT cnes_codigo, cod_cep, cep_limpo, codufmun, municipio_codigo_6, uf_codigo, tp_unid, tpgestao, esfera_a, nat_jur, competen, cep_valido,
         municipio_valido, uf_valida, spatial_resolution_available, spatial_resolution_target, fallback_rule,
         cnes_competencia, source_system, lookup_scope,
         CASE spatial_resolution_final WHEN 'cep' THEN c_lat WHEN 'municipio' THEN centroide_lat WHEN 'uf' THEN uf_lat
              ELSE c_lat END AS latitude,
         CASE spatial_resolution_final WHEN 'cep' THEN c_lon WHEN 'municipio' THEN centroide_lon WHEN 'uf' THEN uf_lon
              ELSE c_lon END AS longitude,
         spatial_resolution_final,
         CASE spatial_resolution_final WHEN 'cep' THEN 'nominatim_cep' WHEN 'municipio' THEN 'ibge_municipio_centroid'
              WHEN 'uf' THEN 'ibge_uf_centroid' END AS spatial_source,
         CASE spatial_resolution_final WHEN 'cep' THEN 'aproximado_por_cep' WHEN 'municipio' THEN 'centroide_municipal'
              WHEN 'uf' THEN 'centroide_uf' END AS geocode_quality,
         municipio_nome, uf_sigla, uf_nome
  FROM chosen)"""
)

DISTANCE = """2 * 6371.0 * asin(least(1.0, sqrt(
    pow(sin(radians(p.centroide_lat - l.latitude) / 2), 2)
    + cos(radians(l.latitude)) * cos(radians(p.centroide_lat)) * pow(sin(radians(p.centroide_lon - l.longitude) / 2), 2))))"""

MEASURED = (
    LOCATED
    + f""",
measured AS (
  SELECT l.*, p.municipio_nome AS municipio_nome_ibge, p.uf_sigla AS uf_sigla_ibge, p.uf_nome AS uf_nome_ibge,
         p.centroide_lat, p.centroide_lon,
         CASE WHEN l.latitude IS NOT NULL AND l.longitude IS NOT NULL AND p.centroide_lat IS NOT NULL
              THEN {DISTANCE} END AS dist_km_to_expected_municipio
  FROM located l LEFT JOIN places p ON l.municipio_codigo_6 = p.municipio_codigo_6 AND l.uf_codigo = p.uf_codigo)"""
)

AUDITED = (
    MEASURED
    + """,
audited AS (
  SELECT * REPLACE (round_even(dist_km_to_expected_municipio, 6) AS dist_km_to_expected_municipio),
         latitude IS NOT NULL AND longitude IS NOT NULL AS has_coord,
         round_even(latitude, 6) AS lat_round6, round_even(longitude, 6) AS lon_round6,
         coalesce(dist_km_to_expected_municipio > 25, false) AS dist_gt_25km,
         coalesce(dist_km_to_expected_municipio > 50, false) AS dist_gt_50km,
         coalesce(dist_km_to_expected_municipio > 100, false) AS dist_gt_100km,
         coalesce(dist_km_to_expected_municipio > 250, false) AS dist_gt_250km,
         coalesce(spatial_resolution_final = 'cep' AND dist_km_to_expected_municipio > 100, false)
           AS candidate_downgrade_to_municipio
  FROM measured),
repeated AS (
  SELECT lat_round6, lon_round6, count(cnes_codigo) AS n_cnes,
         count(DISTINCT municipio_codigo_6) AS n_municipios, count(DISTINCT uf_codigo) AS n_ufs,
         arg_min(spatial_resolution_final, cnes_codigo) FILTER (WHERE spatial_resolution_final IS NOT NULL)
           AS example_spatial_resolution
  FROM audited WHERE has_coord GROUP BY ALL)"""
)

REBUILT = (
    MEASURED
    + """,
ruled AS (
  SELECT m.*, s.uf_lat, s.uf_lon,
         CASE WHEN m.latitude IS NOT NULL AND m.longitude IS NOT NULL AND m.dist_km_to_expected_municipio <= 25 THEN 'manter_cep'
              WHEN m.centroide_lat IS NOT NULL THEN 'fallback_municipio'
              WHEN s.uf_lat IS NOT NULL THEN 'fallback_uf' END AS regra_aplicada
  FROM measured m LEFT JOIN states s ON m.uf_codigo = s.uf_codigo),
rebuilt AS (
  SELECT cnes_codigo, cod_cep, cep_limpo, codufmun, municipio_codigo_6, uf_codigo, tp_unid, tpgestao, esfera_a, nat_jur, competen, cep_valido,
         municipio_valido, uf_valida, spatial_resolution_available, spatial_resolution_target, fallback_rule,
         cnes_competencia, source_system, lookup_scope,
         round_even(CASE regra_aplicada WHEN 'manter_cep' THEN latitude WHEN 'fallback_municipio' THEN centroide_lat
                    WHEN 'fallback_uf' THEN uf_lat END, 6) AS latitude,
         round_even(CASE regra_aplicada WHEN 'manter_cep' THEN longitude WHEN 'fallback_municipio' THEN centroide_lon
                    WHEN 'fallback_uf' THEN uf_lon END, 6) AS longitude,
         CASE regra_aplicada WHEN 'manter_cep' THEN 'cep' WHEN 'fallback_municipio' THEN 'municipio'
              WHEN 'fallback_uf' THEN 'uf' ELSE 'sem_localizacao' END AS spatial_resolution_final,
         CASE regra_aplicada WHEN 'manter_cep' THEN coalesce(spatial_source, 'nominatim_cep')
              WHEN 'fallback_municipio' THEN 'ibge_municipio_centroid'
              WHEN 'fallback_uf' THEN 'ibge_uf_centroid' END AS spatial_source,
         CASE regra_aplicada WHEN 'manter_cep' THEN 'aproximado_por_cep_validado'
              WHEN 'fallback_municipio' THEN 'centroide_municipal'
              WHEN 'fallback_uf' THEN 'centroide_uf' END AS geocode_quality,
         municipio_nome, uf_sigla, uf_nome, municipio_nome_ibge, uf_sigla_ibge, uf_nome_ibge,
         centroide_lat, centroide_lon,
         round_even(dist_km_to_expected_municipio, 6) AS dist_km_to_expected_municipio,
         round_even(latitude, 6) AS latitude_cep_original, round_even(longitude, 6) AS longitude_cep_original,
         spatial_resolution_final AS spatial_resolution_original, spatial_source AS spatial_source_original,
         geocode_quality AS geocode_quality_original, regra_aplicada
  FROM ruled)"""
)


def _role(alias: str, prefix: str) -> str:
    names = {
        "municipio_nome": "nome",
        "uf_codigo": "uf_codigo",
        "uf_sigla": "uf_sigla",
        "uf_nome": "uf_nome",
        "centroide_lon": "lon",
        "centroide_lat": "lat",
        "area_km2": "area_km2",
    }
    return ", ".join(f"{alias}.{c} AS {prefix}{bare}" for c, bare in names.items())


ENRICHED = (
    REBUILT
    + f""",
enriched AS (
  SELECT s.*, {_role("r", "municipio_residencia_")}, {_role("n", "municipio_notificacao_")},
         {_role("h", "municipio_hospital_")},
         c.cod_cep AS unidade_cod_cep, c.cep_limpo AS unidade_cep_limpo, c.codufmun AS unidade_codufmun,
         c.municipio_codigo_6 AS cnes_municipio_codigo_6, c.uf_codigo AS cnes_uf_codigo, c.tp_unid AS unidade_tp_unid,
         c.tpgestao AS unidade_tpgestao, c.esfera_a AS unidade_esfera_a,
         c.nat_jur AS unidade_nat_jur, c.competen AS cnes_competen,
         c.spatial_resolution_available AS unidade_spatial_resolution_available,
         c.spatial_resolution_target AS unidade_spatial_resolution_target,
         c.spatial_resolution_final AS unidade_spatial_resolution_final,
         c.spatial_source AS unidade_spatial_source, c.geocode_quality AS unidade_geocode_quality,
         c.latitude AS unidade_latitude, c.longitude AS unidade_longitude,
         c.municipio_nome AS unidade_municipio_nome, c.uf_sigla AS unidade_uf_sigla, c.uf_nome AS unidade_uf_nome,
         'SINAN' AS source_dataset, 'IBGE' AS territorial_lookup_source, 'CNES' AS unidade_lookup_source,
         'SINAN+IBGE+CNES' AS integration_layer, 'v1' AS spatial_dataset_version
  FROM cases s LEFT JOIN places r ON s.ID_MN_RESI = r.municipio_codigo_6
  LEFT JOIN places n ON s.ID_MUNICIP = n.municipio_codigo_6
  LEFT JOIN places h ON s.ATE_MUNICI = h.municipio_codigo_6
  LEFT JOIN rebuilt c ON trim(s.ID_UNIDADE) = c.cnes_codigo)"""
)

MESH = (
    PLACES
    + """,
holders AS (
  SELECT c.*, p.uf_codigo, concat(p.uf_codigo, lpad(cast(c_custkey % 100000 AS varchar), 5, '0')) AS code
  FROM customer c JOIN places p ON c_nationkey = n_nationkey),
vertices AS (
  SELECT concat(code, CASE WHEN c_custkey % 17 = 0 THEN 'X' ELSE '' END) AS poly,
         c_custkey // 100000 * 2 + ring AS ring, seq,
         cast(-70 AS double) + cast(0.03 AS double) * (c_custkey % 1000) + cast(0.0002 AS double) * dx AS x,
         cast(-30 AS double) + cast(0.1 AS double) * (c_custkey % 300) + cast(0.0002 AS double) * dy AS y
  FROM holders CROSS JOIN (
    SELECT 0 AS ring, 0 AS seq, 0 AS dx, 0 AS dy UNION ALL SELECT 0, 1, 40, 0 UNION ALL SELECT 0, 2, 50, 30
    UNION ALL SELECT 0, 3, 20, 45 UNION ALL SELECT 0, 4, -10, 25 UNION ALL SELECT 1, 0, 10, 10
    UNION ALL SELECT 1, 1, 10, 20 UNION ALL SELECT 1, 2, 20, 10) v
  WHERE ring = 0 OR c_custkey % 5 = 0),
edges AS (
  SELECT poly, ring, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1,
         coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1
  FROM vertices WINDOW w AS (PARTITION BY poly, ring ORDER BY seq)),
rings AS (
  SELECT poly, sum(x * (y1 - y) - y * (x1 - x)) AS a, sum((x + x1) * (x * (y1 - y) - y * (x1 - x))) AS ax,
         sum((y + y1) * (x * (y1 - y) - y * (x1 - x))) AS ay, CASE WHEN ring % 2 = 1 THEN -1 ELSE 1 END AS s
  FROM edges GROUP BY poly, ring),
centroids AS (
  SELECT poly, sum(s * sign(a) * ax) / (3 * sum(s * abs(a))) AS x, sum(s * sign(a) * ay) / (3 * sum(s * abs(a))) AS y
  FROM rings GROUP BY poly),
flat AS (SELECT poly, ring, x, x1, degrees(sin(radians(y))) AS y, degrees(sin(radians(y1))) AS y1 FROM edges),
flat_rings AS (
  SELECT poly, sum(x * (y1 - y) - y * (x1 - x)) AS a, sum((x + x1) * (x * (y1 - y) - y * (x1 - x))) AS ax,
         sum((y + y1) * (x * (y1 - y) - y * (x1 - x))) AS ay, CASE WHEN ring % 2 = 1 THEN -1 ELSE 1 END AS s
  FROM flat GROUP BY poly, ring),
degree_centroids AS (
  SELECT poly, sum(s * sign(a) * ax) / (3 * sum(s * abs(a))) AS lon,
         degrees(asin(radians(sum(s * sign(a) * ay) / (3 * sum(s * abs(a)))))) AS lat
  FROM flat_rings GROUP BY poly)"""
)

_STATE_ROWS = ", ".join(f"('{k}', '{v[0]}', '{v[1]}')" for k, v in STATES.items())

TERRITORY = (
    MESH
    + f""",
payloads AS (
  SELECT concat('[{{"id":', CASE WHEN c_custkey % 8 = 0 OR c_custkey >= 100000 THEN concat('98', cast(c_custkey AS varchar)) ELSE code END, ',"nome":', CASE WHEN c_custkey % 10 = 1 THEN 'null'
           ELSE concat('"N', cast(c_custkey AS varchar), '"') END, '}},{{"id":99', cast(c_custkey AS varchar),
           ',"nome":"fora"}}]') AS payload
  FROM holders),
official AS (
  SELECT cast(item.id AS varchar) AS code7, item.nome AS nome
  FROM (SELECT unnest(from_json(payload, '[{{"id":"BIGINT","nome":"VARCHAR"}}]')) AS item FROM payloads) t),
territory AS (
  SELECT m.cd AS municipio_codigo_7, substr(m.cd, 1, length(m.cd) - 1) AS municipio_codigo_6,
         coalesce(o.nome, m.nm) AS municipio_nome, substr(m.cd, 1, 2) AS uf_codigo,
         coalesce(m.sigla, u.sigla) AS uf_sigla, u.nome AS uf_nome,
         c.lon AS centroide_lon, c.lat AS centroide_lat, m.area AS area_km2
  FROM (SELECT concat(code, CASE WHEN c_custkey % 17 = 0 THEN 'X' ELSE '' END) AS cd,
               concat('M', cast(min(c_custkey) AS varchar)) AS nm,
               CASE WHEN min(c_custkey) % 6 <> 0 THEN concat('S', any_value(uf_codigo)) END AS sigla,
               cast(0.5 AS double) * max(c_custkey) AS area FROM holders GROUP BY cd) m
  JOIN official o ON m.cd = o.code7
  LEFT JOIN degree_centroids c ON c.poly = m.cd
  LEFT JOIN (VALUES {_STATE_ROWS}) u(code, sigla, nome) ON u.code = substr(m.cd, 1, 2)
  WHERE regexp_matches(m.cd, '^[0-9]{{7}}$'))"""
)

MINIMAL = """
coord_registry AS (
  SELECT CASE WHEN s_suppkey % 17 = 0 THEN '  ' ELSE concat(lpad(cast(s_suppkey AS varchar), 7, '0'), ' ') END AS k,
         concat(' ', s_name, '/', cast(part_no AS varchar)) AS nm,
         CASE WHEN s_suppkey % 6 = 0 THEN 'n/d' ELSE concat(' -1', cast(s_suppkey % 10 AS varchar), '.',
              cast(part_no AS varchar), ' ') END AS lat,
         CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat('-4', cast(s_suppkey % 10 AS varchar), '.',
              cast(s_nationkey AS varchar)) END AS lon,
         s_suppkey * 10 + part_no AS ord
  FROM supplier CROSS JOIN (SELECT 1 AS part_no UNION ALL SELECT 2 UNION ALL SELECT 3) p),
minimal AS (
  SELECT trim(k) AS cnes_codigo, trim(nm) AS nome_unidade, try_cast(trim(lat) AS double) AS latitude,
         try_cast(trim(lon) AS double) AS longitude
  FROM coord_registry WHERE trim(k) <> ''
  QUALIFY row_number() OVER (PARTITION BY trim(k) ORDER BY ord) = 1)"""

CASE_COUNTS = """
case_counts AS (
  SELECT trim(ID_UNIDADE) AS cnes_codigo, count(*) AS n FROM cases
  WHERE ID_UNIDADE IS NOT NULL AND trim(ID_UNIDADE) <> '' GROUP BY 1)"""

INVENTORY = """
inventory AS (
  SELECT grupo, concat(grupo, tail) AS arquivo,
         CASE line WHEN 0 THEN 'COD_CEP' WHEN 1 THEN concat('S_RECEPC', number) WHEN 2 THEN concat('num_', number)
              WHEN 3 THEN concat('NOME_', number) ELSE concat('QT_', number) END AS coluna,
         cast(min(l_orderkey) AS varchar) AS primeiro
  FROM (SELECT ['DC', 'EP', 'PF', 'ST'][l_suppkey % 4 + 1] AS grupo,
               CASE WHEN l_orderkey % 1000 = 999 THEN 'ufAAmm.dbc' ELSE concat('SP',
                 lpad(cast(l_partkey % 20 AS varchar), 2, '0'), lpad(cast(l_partkey % 12 + 1 AS varchar), 2, '0'), '.dbc') END AS tail,
               l_linenumber % 7 AS line, cast(l_orderkey % 60 AS varchar) AS number, l_orderkey FROM lineitem) t
  GROUP BY ALL)"""

NAMES = (
    INVENTORY
    + """,
observed AS (SELECT DISTINCT coluna AS name FROM inventory),
declared AS (
  SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN concat('QT_', cast(p_partkey % 50 AS varchar))
           WHEN 1 THEN concat('NOME_', cast(p_partkey % 70 AS varchar)) ELSE concat('DT_', cast(p_size AS varchar)) END AS name
  FROM part)"""
)

DICTIONARY = r"""
rows AS (
  SELECT p_partkey // 40 AS page, p_partkey % 40 AS row,
         CASE p_partkey % 7 WHEN 0 THEN [name] WHEN 1 THEN ['campo', label, name] ELSE ['campo', label, name, codes] END AS cells
  FROM (SELECT p_partkey, concat(' ', p_type, '_', cast(p_size AS varchar), ' ') AS name,
               CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat(' ', p_name, ' ') END AS label,
               concat('1 - Sim 2 – Não 9-', p_name, chr(10), '1 - ', p_brand) AS codes FROM part) t),
cells AS (
  SELECT page, row, len(cells) AS width, cells[2] AS label, cells[4] AS codes,
         unnest(cells) AS cell, generate_subscripts(cells, 1) AS pos FROM rows),
entries AS (
  SELECT trim(cell) AS name, CASE WHEN width > 1 THEN trim(coalesce(label, '')) ELSE 'Label não capturado' END AS label,
         coalesce(codes, '') AS codes, page + 1 AS pagina
  FROM cells WHERE regexp_full_match(trim(cell), '[A-Z][A-Z0-9_]{2,15}')
  QUALIFY row_number() OVER (PARTITION BY trim(cell) ORDER BY page DESC, row DESC, pos DESC) = 1),
pairs AS (
  SELECT name, unnest(regexp_extract_all(codes, '(\d+)\s*[-–]\s*([^0-9\n]+)', 1)) AS codigo,
         unnest(regexp_extract_all(codes, '(\d+)\s*[-–]\s*([^0-9\n]+)', 2)) AS fator,
         generate_subscripts(regexp_extract_all(codes, '(\d+)\s*[-–]\s*([^0-9\n]+)', 1), 1) AS i
  FROM entries),
last_pairs AS (
  SELECT name, codigo, fator FROM pairs QUALIFY row_number() OVER (PARTITION BY name, codigo ORDER BY i DESC) = 1)"""

FILES = """
files AS (
  SELECT upper(g) AS grupo, CASE WHEN o_orderkey % 1000 >= 996 THEN concat(g, 'ufAAmm.dbc')
           ELSE concat(g, 'U', cast(o_custkey % 10 AS varchar), strftime(o_orderdate, '%y%m'),
                       ['.dbc', '.DBC', '.dbf'][o_orderkey % 3 + 1]) END AS name
  FROM (SELECT *, ['ST', 'st', 'EP', 'DC'][o_orderkey % 4 + 1] AS g FROM orders) t)"""


NAMED_TABLES = """
asked AS (SELECT unnest(['ST', 'EP', 'DC', 'PF']) AS grupo),
tables AS (
  SELECT g AS grupo, concat(g, 'SP', period, '.parquet') AS file, count(*) AS n_rows, min(o_orderkey) AS first_key
  FROM (SELECT o_orderkey, ['ST', 'EP', 'DC'][o_orderkey % 3 + 1] AS g,
               concat(lpad(cast(year(o_orderdate) % 100 AS varchar), 2, '0'),
                      CASE WHEN o_custkey % 2 = 0 THEN '06' ELSE '12' END) AS period FROM orders) t GROUP BY g, period
  UNION ALL SELECT 'ST', 'STufAAmm.parquet', count(*), min(o_orderkey) FROM orders WHERE o_orderkey % 97 = 0
  UNION ALL SELECT 'EP', 'EPSP9999.parquet', 0, NULL),
latest AS (
  SELECT * FROM tables WHERE regexp_full_match(substr(file, -12, 4), '[0-9]{4}')
  QUALIFY row_number() OVER (PARTITION BY grupo ORDER BY file DESC) = 1),
layout AS (
  SELECT * FROM (VALUES ('ST', 0, 'CNES', 'string'), ('ST', 1, 'COD_CEP', 'string'), ('ST', 2, 'NU_ORDEM', 'int64'),
    ('EP', 0, 'NOME_FANT', 'string'), ('EP', 1, 'NUM_ORDEM', 'int64'), ('DC', 0, 'NU_ORDEM', 'int64'),
    ('DC', 1, 'VALOR', 'double')) v(grupo, position, "column", type))"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _pct(n: str, d: str) -> str:
    return f"CASE WHEN {d} = 0 THEN 0.0 ELSE round_even(100.0::double * {n} / {d}, 2) END"


def _metric(section: str, metric: str, n: str, total: str | None = None) -> str:
    share = _pct(n, total) if total else "CAST(NULL AS double)"
    return (
        f"SELECT '{section}' AS section, '{metric}' AS metric, cast({n} AS bigint) AS n, "
        f"cast({share} AS double) AS pct, CAST(NULL AS varchar) AS verdict FROM totals"
    )


def _verdict(metric: str, expression: str) -> str:
    return (
        f"SELECT 'verdict' AS section, '{metric}' AS metric, CAST(NULL AS bigint) AS n, "
        f"CAST(NULL AS double) AS pct, {expression} AS verdict FROM totals"
    )


def _union(*rows: str) -> str:
    return "\nUNION ALL ".join(rows)


FIELDS = ("ID_MUNICIP", "ID_MN_RESI", "ATE_MUNICI")
CODES = """
codes AS (""" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, trim({f}) AS codigo FROM cases WHERE {f} IS NOT NULL AND trim({f}) <> ''"
    for f in FIELDS
) + ")"

LOCATION_SUMMARY = """,
totals AS (
  SELECT count(*) AS n, count_if(spatial_resolution_final = 'cep') AS cep,
         count_if(spatial_resolution_final = 'municipio') AS mun, count_if(spatial_resolution_final = 'uf') AS uf,
         count_if(spatial_resolution_final IS NULL) AS nowhere FROM located)
""" + _union(
    _metric("level", "facilities", "n"),
    _metric("level", "cep", "cep", "n"),
    _metric("level", "municipio", "mun", "n"),
    _metric("level", "uf", "uf", "n"),
    _metric("level", "none", "nowhere", "n"),
)

DICTIONARY_SELECT = """
SELECT e.name, e.label, e.pagina, p.codigo, p.fator FROM entries e LEFT JOIN last_pairs p ON e.name = p.name"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["q_enriched_cases"] = _with(ENRICHED) + "SELECT * FROM enriched"
    sql["q_enriched_bucketed"] = sql["q_enriched_cases"]
    sql["q_enriched_validation"] = (
        _with(ENRICHED)
        + """, totals AS (
  SELECT count(*) AS n, 54 AS cols,
         count_if(municipio_residencia_lat IS NOT NULL AND municipio_residencia_lon IS NOT NULL) AS resi,
         count_if(municipio_notificacao_lat IS NOT NULL AND municipio_notificacao_lon IS NOT NULL) AS noti,
         count_if(unidade_latitude IS NOT NULL AND unidade_longitude IS NOT NULL) AS unit FROM enriched)
"""
        + _union(
            _metric("enriched", "rows", "n"),
            _metric("enriched", "columns", "cols"),
            _metric("enriched", "residence_located", "resi"),
            _metric("enriched", "notification_located", "noti"),
            _metric("enriched", "facility_located", "unit"),
        )
    )
    sql["q_enriched_sample"] = (
        _with(ENRICHED)
        + """SELECT case_id, ID_MN_RESI, municipio_residencia_nome, municipio_residencia_uf_sigla,
  municipio_residencia_lat, municipio_residencia_lon, ID_MUNICIP, municipio_notificacao_nome,
  municipio_notificacao_uf_sigla, ID_UNIDADE, unidade_cod_cep, unidade_spatial_resolution_final,
  unidade_latitude, unidade_longitude FROM enriched ORDER BY case_id LIMIT 10"""
    )
    sql["q_key_coverage"] = (
        _with(CASES, CODES)
        + """, keys AS (SELECT DISTINCT field, codigo FROM codes),
counted AS (SELECT field, count(*) AS n_rows FROM codes GROUP BY field),
matched AS (SELECT field, count(*) AS n FROM keys JOIN places ON codigo = municipio_codigo_6 GROUP BY field),
total AS (SELECT field, count(*) AS n FROM keys GROUP BY field)
SELECT f.field, coalesce(c.n_rows, 0) AS n_rows, coalesce(t.n, 0) AS n_distinct, coalesce(m.n, 0) AS n_matched,
       coalesce(t.n, 0) - coalesce(m.n, 0) AS n_unmatched
FROM (VALUES ('ID_MUNICIP'), ('ID_MN_RESI'), ('ATE_MUNICI')) f(field)
LEFT JOIN counted c USING (field) LEFT JOIN total t USING (field) LEFT JOIN matched m USING (field)"""
    )
    sql["q_unmatched_keys"] = (
        _with(CASES, CODES)
        + """SELECT field, codigo FROM (SELECT DISTINCT field, codigo FROM codes) k
WHERE codigo NOT IN (SELECT municipio_codigo_6 FROM places)
QUALIFY row_number() OVER (PARTITION BY field ORDER BY codigo) <= 50"""
    )
    sql["q_state_coherence"] = _with(CASES) + _union(
        *[
            f"""SELECT '{m}' AS municipality_field, '{s}' AS state_field, count(*) AS n_comparable,
  cast(coalesce(sum(CASE WHEN substr(trim({m}), 1, 2) <> lpad(trim({s}), 2, '0') THEN 1 ELSE 0 END), 0) AS bigint) AS n_inconsistent
FROM cases WHERE {m} IS NOT NULL AND trim({m}) <> '' AND {s} IS NOT NULL AND trim({s}) <> ''"""
            for m, s in (("ID_MUNICIP", "SG_UF_NOT"), ("ID_MN_RESI", "SG_UF"), ("ATE_MUNICI", "ATE_UF_HOS"))
        ]
    )
    sql["q_facility_lookup"] = _with(FACILITIES) + "SELECT * FROM facilities"
    sql["q_facility_quality"] = (
        _with(FACILITIES)
        + """, shared AS (SELECT cep_limpo, count(*) AS n FROM facilities WHERE cep_valido GROUP BY 1),
totals AS (
  SELECT (SELECT count(*) FROM case_keys) AS wanted,
         (SELECT count(*) FROM case_keys WHERE CNES IN (SELECT CNES FROM registry)) AS matched,
         (SELECT count(*) FROM shared) AS uniq, (SELECT count(*) FROM shared WHERE n > 1) AS shared,
         count(*) AS n, count_if(trim(cod_cep) <> '') AS cep_filled, count_if(cep_valido) AS cep_valid,
         count_if(trim(codufmun) <> '') AS mun_filled, count_if(municipio_valido) AS mun_valid,
         count_if(uf_valida) AS uf_valid, count_if(spatial_resolution_available = 'cep') AS l_cep,
         count_if(spatial_resolution_available = 'municipio') AS l_mun,
         count_if(spatial_resolution_available = 'uf') AS l_uf,
         count_if(spatial_resolution_available = 'sem_localizacao') AS l_none FROM facilities)
"""
        + _union(
            _metric("coverage", "case_facilities", "wanted"),
            _metric("coverage", "matched", "matched", "wanted"),
            _metric("coverage", "unmatched", "wanted - matched"),
            _metric("postal_code", "facilities", "n"),
            _metric("postal_code", "filled", "cep_filled", "n"),
            _metric("postal_code", "valid", "cep_valid", "n"),
            _metric("postal_code", "valid_unique", "uniq"),
            _metric("postal_code", "valid_shared", "shared"),
            _metric("municipality", "filled", "mun_filled", "n"),
            _metric("municipality", "valid", "mun_valid", "n"),
            _metric("municipality", "state_valid", "uf_valid", "n"),
            _metric("level", "cep", "l_cep", "n"),
            _metric("level", "municipio", "l_mun", "n"),
            _metric("level", "uf", "l_uf", "n"),
            _metric("level", "sem_localizacao", "l_none", "n"),
            _verdict(
                "postal_code",
                f"CASE WHEN {_pct('cep_valid', 'n')} >= 80 THEN 'strong' WHEN {_pct('cep_valid', 'n')} >= 50 THEN 'usable' ELSE 'weak' END",
            ),
            _verdict(
                "municipality",
                f"CASE WHEN {_pct('mun_valid', 'n')} >= 95 THEN 'excellent' WHEN {_pct('mun_valid', 'n')} >= 80 THEN 'good' ELSE 'caution' END",
            ),
        )
    )
    sql["q_type_top15"] = (
        _with(FACILITIES)
        + """SELECT coalesce(tp_unid, '') AS TP_UNID, count(*) AS n FROM facilities GROUP BY 1
ORDER BY n DESC, TP_UNID LIMIT 15"""
    )
    sql["q_coverage_ratio"] = (
        _with(CASES, REGISTRY, NAMED)
        + f"""SELECT n_total, n_matched, n_total - n_matched AS n_unmatched, {_pct("n_matched", "n_total")} AS pct_matched
FROM (SELECT count(*) AS n_total, count(r.CNES) AS n_matched
      FROM case_keys k LEFT JOIN (SELECT DISTINCT CNES FROM registry) r ON k.CNES = r.CNES) t"""
    )
    sql["q_location_fallback"] = (
        _with(LOCATED)
        + "SELECT * REPLACE (round_even(latitude, 6) AS latitude, round_even(longitude, 6) AS longitude) FROM located"
    )
    sql["q_location_summary"] = _with(LOCATED) + LOCATION_SUMMARY
    sql["q_metrics_long"] = sql["q_location_summary"]
    sql["q_plausibility"] = (
        _with(AUDITED)
        + """SELECT cnes_codigo, cod_cep, cep_limpo, municipio_codigo_6, municipio_nome, uf_codigo, uf_sigla,
  round_even(latitude, 6) AS latitude, round_even(longitude, 6) AS longitude, centroide_lat, centroide_lon,
  spatial_resolution_final, spatial_source, geocode_quality, dist_km_to_expected_municipio,
  candidate_downgrade_to_municipio, dist_gt_25km, dist_gt_50km, dist_gt_100km, dist_gt_250km FROM audited"""
    )
    sql["q_plausibility_summary"] = (
        _with(AUDITED)
        + """, totals AS (
  SELECT (SELECT count(*) FROM repeated WHERE n_cnes >= 10) AS ge10,
         (SELECT count(*) FROM repeated WHERE n_cnes >= 25) AS ge25,
         (SELECT count(*) FROM repeated WHERE n_cnes >= 50) AS ge50,
         count(*) AS n, count_if(has_coord) AS located, count_if(spatial_resolution_final = 'cep') AS l_cep,
         count_if(spatial_resolution_final = 'municipio') AS l_mun, count_if(spatial_resolution_final = 'uf') AS l_uf,
         count_if(dist_gt_25km) AS gt25, count_if(dist_gt_50km) AS gt50, count_if(dist_gt_100km) AS gt100,
         count_if(dist_gt_250km) AS gt250, count_if(candidate_downgrade_to_municipio) AS cand FROM audited)
"""
        + _union(
            _metric("coverage", "facilities", "n"),
            _metric("coverage", "with_coordinates", "located", "n"),
            _metric("coverage", "cep", "l_cep", "n"),
            _metric("coverage", "municipio", "l_mun", "n"),
            _metric("coverage", "uf", "l_uf", "n"),
            *[_metric("distance", f"gt_{k}km", f"gt{k}", "n") for k in (25, 50, 100, 250)],
            *[_metric("repeated", f"ge_{k}", f"ge{k}") for k in (10, 25, 50)],
            _metric("downgrade", "candidates", "cand", "n"),
            _verdict(
                "distance",
                f"CASE WHEN gt100 = 0 THEN 'coherent' WHEN {_pct('gt100', 'n')} <= 5 THEN 'isolated_review' ELSE 'systematic_review' END",
            ),
            _verdict("repeated", "CASE WHEN ge50 > 0 THEN 'collapse' ELSE 'no_collapse' END"),
        )
    )
    sql["q_top_distances"] = (
        _with(AUDITED)
        + """SELECT cnes_codigo, municipio_codigo_6, municipio_nome, uf_sigla, round_even(latitude, 6) AS latitude,
  round_even(longitude, 6) AS longitude, centroide_lat, centroide_lon, spatial_resolution_final, spatial_source,
  geocode_quality, dist_km_to_expected_municipio, candidate_downgrade_to_municipio
FROM audited ORDER BY dist_km_to_expected_municipio DESC NULLS LAST, cnes_codigo LIMIT 500"""
    )
    sql["q_coordinate_collapse"] = (
        _with(AUDITED)
        + """SELECT * FROM repeated
ORDER BY n_cnes DESC, n_municipios DESC, n_ufs DESC, lat_round6, lon_round6 LIMIT 200"""
    )
    sql["q_collapse_counts"] = _with(AUDITED) + _union(
        *[f"SELECT {k} AS min_size, count(*) AS n_points FROM repeated WHERE n_cnes >= {k}" for k in (10, 25, 50)]
    )
    sql["q_conservative"] = _with(REBUILT) + "SELECT * FROM rebuilt"
    sql["q_conservative_summary"] = (
        _with(REBUILT)
        + """, totals AS (
  SELECT count(*) AS n, count_if(spatial_resolution_original = 'cep') AS original,
         count_if(spatial_resolution_final = 'cep') AS cep, count_if(spatial_resolution_final = 'municipio') AS mun,
         count_if(spatial_resolution_final = 'uf') AS uf, count_if(spatial_resolution_final = 'sem_localizacao') AS nowhere,
         count_if(regra_aplicada = 'manter_cep') AS r_keep, count_if(regra_aplicada = 'fallback_municipio') AS r_mun,
         count_if(regra_aplicada = 'fallback_uf') AS r_uf FROM rebuilt)
"""
        + _union(
            _metric("coverage", "facilities", "n"),
            _metric("coverage", "original_cep", "original", "n"),
            _metric("level", "cep", "cep", "n"),
            _metric("level", "municipio", "mun", "n"),
            _metric("level", "uf", "uf", "n"),
            _metric("level", "sem_localizacao", "nowhere", "n"),
            _metric("rule", "manter_cep", "r_keep", "n"),
            _metric("rule", "fallback_municipio", "r_mun", "n"),
            _metric("rule", "fallback_uf", "r_uf", "n"),
        )
    )
    sql["q_cache_worklist"] = (
        _with(FACILITIES, CACHE)
        + """SELECT DISTINCT cep_limpo FROM facilities
WHERE cep_valido AND cep_limpo NOT IN (SELECT cep_limpo FROM cache) ORDER BY cep_limpo"""
    )
    sql["q_cache_upsert"] = (
        _with(PLACES, CACHE, RESULTS)
        + """SELECT cep_limpo, latitude, longitude, geocode_success, seq
FROM (SELECT 0 AS batch, * FROM cache UNION ALL SELECT 1 AS batch, * FROM results) t
QUALIFY row_number() OVER (PARTITION BY cep_limpo ORDER BY batch DESC, seq DESC) = 1"""
    )
    sql["q_territory_lookup"] = (
        _with(TERRITORY)
        + """SELECT * REPLACE (round_even(centroide_lon, 6) AS centroide_lon, round_even(centroide_lat, 6) AS centroide_lat)
FROM territory"""
    )
    sql["q_polygon_centroid"] = (
        _with(MESH) + "SELECT poly, round_even(x, 6) AS x, round_even(y, 6) AS y FROM centroids"
    )
    sql["q_state_centroids"] = (
        _with(TERRITORY)
        + """SELECT uf_codigo, uf_sigla, uf_nome, round_even(avg(centroide_lon), 6) AS uf_lon,
  round_even(avg(centroide_lat), 6) AS uf_lat FROM territory
WHERE uf_codigo IS NOT NULL AND uf_sigla IS NOT NULL AND uf_nome IS NOT NULL GROUP BY 1, 2, 3"""
    )
    sql["q_lookup_by_state"] = (
        _with(TERRITORY) + "SELECT uf_sigla, count(*) AS n FROM territory GROUP BY uf_sigla"
    )
    sql["q_lookup_first_rows"] = (
        _with(TERRITORY)
        + """SELECT * REPLACE (round_even(centroide_lon, 6) AS centroide_lon, round_even(centroide_lat, 6) AS centroide_lat)
FROM territory ORDER BY municipio_codigo_7 LIMIT 20"""
    )
    sql["q_minimal_lookup"] = _with(MINIMAL) + "SELECT * FROM minimal"
    sql["q_minimal_completeness"] = (
        _with(MINIMAL)
        + """SELECT count(*) AS total_unidades,
  cast(sum(CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 1 ELSE 0 END) AS bigint) AS com_coordenada,
  cast(sum(CASE WHEN latitude IS NULL OR longitude IS NULL THEN 1 ELSE 0 END) AS bigint) AS sem_coordenada,
  cast(round(100.0::double * count_if(latitude IS NOT NULL AND longitude IS NOT NULL) / count(*), 2) AS double)
    AS pct_com_coordenada
FROM minimal"""
    )
    sql["q_minimal_audit"] = (
        _with(CASES, MINIMAL, CASE_COUNTS)
        + """SELECT cast(coalesce(sum(n), 0) AS bigint) AS n_rows, count(*) AS n_distinct, count(m.cnes_codigo) AS n_matched,
  cast(count_if(m.latitude IS NOT NULL AND m.longitude IS NOT NULL) AS bigint) AS n_matched_with_coord,
  cast(count_if(m.cnes_codigo IS NULL) AS bigint) AS n_unmatched
FROM case_counts k LEFT JOIN minimal m ON k.cnes_codigo = m.cnes_codigo"""
    )
    sql["q_minimal_unmatched"] = (
        _with(CASES, MINIMAL, CASE_COUNTS)
        + """SELECT cnes_codigo FROM case_counts WHERE cnes_codigo NOT IN (SELECT cnes_codigo FROM minimal)
ORDER BY cnes_codigo LIMIT 50"""
    )
    sql["q_schema_audit"] = (
        _with(NAMES)
        + """, totals AS (
  SELECT (SELECT count(*) FROM observed) AS o, (SELECT count(*) FROM declared) AS d,
         (SELECT count(*) FROM (SELECT name FROM observed INTERSECT SELECT name FROM declared) t) AS both_sides,
         (SELECT count(*) FROM (SELECT name FROM observed EXCEPT SELECT name FROM declared) t) AS o_only,
         (SELECT count(*) FROM (SELECT name FROM declared EXCEPT SELECT name FROM observed) t) AS d_only)
"""
        + _union(
            _metric("schema", "observed", "o"),
            _metric("schema", "declared", "d"),
            _metric("schema", "in_both", "both_sides"),
            _metric("schema", "observed_only", "o_only"),
            _metric("schema", "declared_only", "d_only"),
        )
    )
    sql["q_schema_differences"] = (
        _with(NAMES)
        + """SELECT 'observed_only' AS side, name FROM (SELECT name FROM observed EXCEPT SELECT name FROM declared) a
UNION ALL SELECT 'declared_only', name FROM (SELECT name FROM declared EXCEPT SELECT name FROM observed) b"""
    )
    sql["q_dictionary_cells"] = _with(DICTIONARY) + DICTIONARY_SELECT
    sql["q_roundtrip_json"] = sql["q_dictionary_cells"]
    sql["q_document_names"] = r"""SELECT name, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '[ \n]')) AS raw FROM documents) t,
  LATERAL (SELECT trim(raw, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS name) s
WHERE regexp_full_match(name, '[A-Z][A-Z0-9_]{2,15}') GROUP BY name"""
    sql["q_file_select"] = (
        _with(FILES)
        + """SELECT grupo, name FROM files WHERE lower(name) LIKE '%.dbc' AND starts_with(upper(name), 'ST')
  AND substr(name, -8, 2) = '98' AND substr(name, -6, 2) = '03' ORDER BY name"""
    )
    sql["q_file_latest"] = (
        _with(FILES)
        + """SELECT grupo, max(name) AS name FROM files WHERE lower(name) LIKE '%.dbc'
  AND regexp_full_match(substr(name, -8, 4), '[0-9]{4}') GROUP BY grupo"""
    )
    sql["q_json_payload"] = """
WITH payloads AS (
  SELECT concat('[{"id":', regexp_extract(props, '([0-9]+)', 1), ',"nome":"', event_type, '"},{"id":',
                cast(event_id AS varchar), ',"nome":null}]') AS payload FROM events)
SELECT cast(item.id AS varchar) AS municipio_codigo_7, item.nome AS municipio_nome_api
FROM (SELECT unnest(from_json(payload, '[{"id":"BIGINT","nome":"VARCHAR"}]')) AS item FROM payloads) t"""
    sql["q_stack"] = "SELECT * REPLACE (cast(o_orderdate AS date) AS o_orderdate) FROM orders"
    sql["q_results_log"] = (
        _with(RESULTS)
        + """, log AS (
  SELECT cep_limpo, latitude, longitude, geocode_success = 'True' AS geocode_success, seq,
         cast(1 AS bigint) AS batch FROM results
  UNION ALL SELECT cep_limpo, latitude + 1, longitude, geocode_success = 'True', seq, 2 FROM results
  WHERE seq % 5 = 0)
SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY cep_limpo ORDER BY batch DESC, seq DESC) = 1"""
    )
    sql["q_aligned_files"] = sql["q_stack_aligned"] = """
SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       cast(o_orderdate AS date) AS o_orderdate) FROM orders"""
    sql["q_schema_scan"] = (
        _with(INVENTORY)
        + """, per_file AS (SELECT grupo, arquivo, count(*) AS n_colunas FROM inventory
  WHERE regexp_full_match(substr(arquivo, -8, 4), '[0-9]{4}') GROUP BY 1, 2),
latest AS (SELECT * FROM per_file QUALIFY row_number() OVER (PARTITION BY grupo ORDER BY arquivo DESC) = 1)
SELECT l.grupo, l.arquivo, l.n_colunas, i.coluna, i.primeiro
FROM latest l LEFT JOIN (
  SELECT * FROM inventory WHERE regexp_matches(upper(coluna), 'CEP|LOGRA|ENDERE|BAIR|NUM|COMPL|FANT|RAZA|NOME')) i
  ON l.grupo = i.grupo AND l.arquivo = i.arquivo"""
    )
    sql["q_file_inspection"] = (
        _with(NAMED_TABLES)
        + """SELECT grupo, l.file, l.n_rows, c.n_columns, c.columns
FROM asked LEFT JOIN latest l USING (grupo) LEFT JOIN (
  SELECT grupo, count(*) AS n_columns, string_agg("column", ',' ORDER BY position) AS columns FROM layout GROUP BY grupo) c
  ON l.grupo = c.grupo"""
    )
    sql["q_folder_scan"] = (
        _with(NAMED_TABLES)
        + """SELECT grupo, l.file AS arquivo, n_colunas, m."column" AS coluna,
  CASE m."column" WHEN 'COD_CEP' THEN o_orderpriority WHEN 'NOME_FANT' THEN o_orderstatus
       WHEN 'NUM_ORDEM' THEN cast(l.first_key AS varchar) END AS primeiro
FROM asked LEFT JOIN latest l USING (grupo)
LEFT JOIN (SELECT grupo, count(*) AS n_colunas FROM layout GROUP BY grupo) c ON l.grupo = c.grupo
LEFT JOIN layout m ON l.grupo = m.grupo AND m."column" IN ('COD_CEP', 'NOME_FANT', 'NUM_ORDEM')
LEFT JOIN orders ON o_orderkey = l.first_key"""
    )
    sql["q_folder_footers"] = (
        _with(NAMED_TABLES)
        + """SELECT file AS name, n_rows, n_columns, "column", cast(position AS integer) AS position, type
FROM tables JOIN layout USING (grupo)
JOIN (SELECT grupo, count(*) AS n_columns FROM layout GROUP BY grupo) c USING (grupo)"""
    )
    sql["q_quarantined_payloads"] = """
SELECT CASE event_id % 11 WHEN 3 THEN 'no JSON array of objects' WHEN 5 THEN 'no payload'
            WHEN 7 THEN 'an object without a whole number as id' WHEN 9 THEN 'no payload' ELSE 'none' END AS fault,
       cast(sum(CASE WHEN event_id % 11 IN (3, 5, 7, 9) THEN 1 ELSE 2 END) AS bigint) AS n
FROM events GROUP BY 1"""
    sql["q_quarantined_lines"] = """
SELECT CASE WHEN fits THEN k END AS cep_limpo, CASE WHEN fits THEN v END AS latitude,
       CASE WHEN fits THEN CASE WHEN s_suppkey % 9 = 2 THEN 'more' ELSE 'True' END END AS geocode_success, CASE WHEN NOT fits THEN line END AS line,
       CASE WHEN NOT fits THEN 'another number of columns than the header' END AS fault
FROM (SELECT lpad(cast(s_suppkey AS varchar), 8, '0') AS k,
             CASE WHEN s_suppkey % 9 = 2 THEN 'True' ELSE cast(s_nationkey AS varchar) END AS v,
             concat_ws(',', k, CASE WHEN s_suppkey % 9 <> 2 THEN cast(s_nationkey AS varchar) END, 'True',
                       CASE WHEN s_suppkey % 13 = 5 THEN 'more' END) AS line,
             length(line) - length(replace(line, ',', '')) = 2 AS fits,
             s_suppkey FROM supplier) t"""
    sql["q_conservative_numbered"] = (
        _with(REBUILT)
        + """SELECT cnes_codigo, regra_aplicada, dist_km_to_expected_municipio, row_number() OVER (
  ORDER BY regra_aplicada NULLS LAST, dist_km_to_expected_municipio DESC NULLS LAST, cnes_codigo) AS n FROM rebuilt"""
    )
    sql["q_plausibility_numbered"] = (
        _with(AUDITED)
        + """SELECT cnes_codigo, candidate_downgrade_to_municipio, dist_km_to_expected_municipio, row_number() OVER (
  ORDER BY candidate_downgrade_to_municipio DESC NULLS LAST, dist_km_to_expected_municipio DESC NULLS LAST,
  cnes_codigo) AS n FROM audited"""
    )
    sql["q_cache_stream"] = sql["q_cache_upsert"]
    sql["q_first_rows"] = """
SELECT * REPLACE (cast(o_orderdate AS date) AS o_orderdate) FROM orders ORDER BY o_orderkey LIMIT 3"""
    sql["q_load_summary"] = (
        _with(CASES)
        + """, declared AS (
  SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN concat('QT_', cast(p_partkey % 50 AS varchar))
         WHEN 1 THEN concat('NOME_', cast(p_partkey % 70 AS varchar))
         ELSE concat('DT_', cast(p_size AS varchar)) END AS name FROM part),
totals AS (SELECT (SELECT count(*) FROM cases) AS n,
  (SELECT count(*) FROM declared WHERE starts_with(name, 'QT')) AS described,
  (SELECT count(*) FROM declared WHERE NOT starts_with(name, 'QT')) AS external)
"""
        + _union(
            _metric("load", "rows", "n"),
            _metric("load", "columns", "8"),
            _metric("load", "described_variables", "described"),
            _metric("load", "external_variables", "external"),
        )
    )
    sql["q_roundtrip_csv"] = (
        _with(CASES)
        + """SELECT * REPLACE (cast(case_id AS varchar) AS case_id), CAST(NULL AS varchar) AS NOT_THERE
FROM cases"""
    )
    sql["q_roundtrip_parquet"] = (
        _with(CASES) + "SELECT * FROM cases"
    )
    sql["q_projection_rules"] = (
        _with(PLACES, REGISTRY)
        + """SELECT CNES, CODUFMUN, TP_UNID AS tp_unid, TPGESTAO AS tpgestao, ESFERA_A AS esfera_a, COMPETEN AS competen, ord, '' AS COD_CEP, CAST(NULL AS double) AS AREA,
  'CNES / DATASUS / ST' AS source_system,
  CASE WHEN regexp_full_match(CODUFMUN, '[0-9]{6}') AND CODUFMUN <> '000000' THEN 'municipio'
       WHEN regexp_full_match(substr(CODUFMUN, 1, 2), '[0-9]{2}') AND substr(CODUFMUN, 1, 2) <> '00' THEN 'uf'
       ELSE 'sem_localizacao' END AS level
FROM registry ORDER BY CNES, ord"""
    )
    sql["q_label_building"] = (
        _with(FILES)
        + """SELECT concat(cast(1900 + cast(substr(name, -8, 2) AS integer) AS varchar), '-', substr(name, -6, 2)) AS period,
  lpad(cast(length(name) AS varchar), 3, '0') AS width, count(*) AS n
FROM files WHERE regexp_full_match(substr(name, -8, 4), '[0-9]{4}') GROUP BY 1, 2"""
    )
    sql["q_geocode_queries"] = (
        _with(RESULTS)
        + "SELECT seq, concat(cep_limpo, ', Brazil') AS geocode_query, geocode_success FROM results"
    )
    sql["q_key_validity"] = (
        _with(PLACES, REGISTRY)
        + f"""SELECT cep_valido, municipio_valido, n, n_filled, {_pct("n_filled", "n")} AS pct_filled
FROM (SELECT length(c) = 8 AND c <> '00000000' AS cep_valido, length(m) = 6 AND m <> '000000' AS municipio_valido,
             count(*) AS n, cast(count_if(trim(raw) <> '') AS bigint) AS n_filled
      FROM (SELECT coalesce(COD_CEP, '') AS raw, regexp_replace(coalesce(COD_CEP, ''), '[^0-9]', '', 'g') AS c,
                   regexp_replace(coalesce(CODUFMUN, ''), '[^0-9]', '', 'g') AS m FROM registry) t GROUP BY 1, 2) u"""
    )
    sql["q_shared_facilities"] = (
        _with(CASES, REGISTRY, NAMED)
        + """SELECT TP_UNID, CNES IN (SELECT CNES FROM case_keys) AS named, count(*) AS n
FROM (SELECT CNES, min(TP_UNID) AS TP_UNID FROM registry GROUP BY CNES) r GROUP BY 1, 2"""
    )
    return sql
