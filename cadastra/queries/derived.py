"""Domain tables derived from the given ones, in SQL both engines read.

Customers stand for communes, nations for departments, regions for regions, orders and their
lines for observations. Every definition covers the whole table it reads. Names in braces are
the given tables or other definitions.
"""

from __future__ import annotations

from cadastra.queries.registry import DERIVED


# A few customers stand for island communes and for Paris; whoever has such a key takes theirs.
SPECIAL = {11: 17019, 14: 56009, 17: 29155, 20: 17093, 23: 75056}


def code(key: str) -> str:
    """Five-digit commune code of a customer key (longer keys stay whole)."""
    swaps = " ".join(f"WHEN {a} THEN {b} WHEN {b} THEN {a}" for a, b in SPECIAL.items())
    number = f"(CASE {key} {swaps} ELSE {key} END)"
    return f"CASE WHEN {key} < 100000 THEN lpad(CAST({number} AS STRING), 5, '0') ELSE CAST({key} AS STRING) END"


def department(key: str) -> str:
    return (
        f"CASE {key} WHEN 0 THEN '2A' WHEN 1 THEN '2B' WHEN 20 THEN '971' WHEN 21 THEN '972' WHEN 22 THEN '973' "
        f"WHEN 23 THEN '974' WHEN 24 THEN '976' ELSE lpad(CAST({key} AS STRING), 2, '0') END"
    )


def district(nation: str, key: str) -> str:
    """Codes with districts of three cities."""
    return (
        f"CASE {nation} WHEN 5 THEN '751' || lpad(CAST({key} % 20 AS STRING), 2, '0') WHEN 6 THEN '6938' || CAST({key} % 10 AS STRING) "
        f"WHEN 7 THEN '132' || lpad(CAST({key} % 16 AS STRING), 2, '0') ELSE {code(key)} END"
    )


YEAR = "CAST(year(o_orderdate) AS STRING)"

DERIVED.update(
    {
        "cog_communes": f"""
SELECT {code("c_custkey")} AS COM, replace(c_name, '#', '-') AS NCCENR, upper(c_name) AS NCC,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE {department("c_nationkey")} || left(c_mktsegment, 1) END AS ARR,
  {department("c_nationkey")} AS DEP, lpad(CAST(n_regionkey AS STRING), 2, '0') AS REG,
  CASE WHEN c_acctbal < -500 THEN 'ARM' ELSE 'COM' END AS TYPECOM
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
        "cog_departements": f"""
SELECT {department("n_nationkey")} AS DEP, n_name AS LIBELLE, {code("k")} AS CHEFLIEU
FROM {{nation}} LEFT JOIN (SELECT c_nationkey, min(c_custkey) AS k FROM {{customer}} GROUP BY c_nationkey) m ON n_nationkey = c_nationkey""",
        "cog_arrondissements": f"""
SELECT {department("n_nationkey")} || left(seg, 1) AS ARR, n_name || ' ' || seg AS LIBELLE, {code("k")} AS CHEFLIEU
FROM {{nation}} JOIN (SELECT c_nationkey, c_mktsegment AS seg, min(c_custkey) AS k FROM {{customer}} WHERE c_mktsegment <> 'BUILDING' GROUP BY c_nationkey, c_mktsegment) m ON n_nationkey = c_nationkey""",
        "cog_regions": "SELECT lpad(CAST(r_regionkey AS STRING), 2, '0') AS REG, r_name AS LIBELLE FROM {region}",
        "cog_communes_comer": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS COM_COMER, s_name AS NCCENR, upper(s_name) AS NCC, '98' || CAST(n_regionkey AS STRING) AS COMER, 'OVERSEAS ' || r_name AS LIBELLE_COMER
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
        # A grid of squares of one tenth of a degree, 50 to a row.
        "boxes": f"""
SELECT {code("c_custkey")} AS code, replace(c_name, '#', '-') AS nom, {department("c_nationkey")} AS departement, lpad(CAST(c_nationkey AS STRING), 2, '0') AS region,
  CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE 'E' || c_mktsegment END AS epci, c_custkey % 50 AS i, CAST(floor(c_custkey / 50) AS BIGINT) AS j,
  CAST(c_custkey % 50 AS DOUBLE) / 10 AS x0, CAST(floor(c_custkey / 50) AS DOUBLE) / 10 - 40 AS y0,
  CAST(c_custkey % 50 + 1 AS DOUBLE) / 10 AS x1, CAST(floor(c_custkey / 50) + 1 AS DOUBLE) / 10 - 40 AS y1
FROM {{customer}}""",
        "mountain_perimeter": f"SELECT {code('o_custkey')} AS INSEE_COM FROM {{orders}} WHERE o_totalprice > 450000",
        "littoral_perimeter": f"""
SELECT {code("o_custkey")} AS INSEE_COM, CASE o_orderpriority WHEN '1-URGENT' THEN 'Mer' WHEN '2-HIGH' THEN 'Estuaire' WHEN '3-MEDIUM' THEN 'Lac' ELSE 'Autre' END AS CLASSEMENT
FROM {{orders}} WHERE o_orderstatus = 'P'""",
        "altitude": f"""
SELECT {code("o_custkey")} AS commune_id, CAST(CAST(floor(min(o_totalprice)) AS BIGINT) AS STRING) AS altitude_min, CAST(CAST(floor(max(o_totalprice)) AS BIGINT) AS STRING) AS altitude_max,
  CAST(CAST(avg(CAST(o_orderkey AS DOUBLE)) AS DECIMAL(18,1)) AS STRING) AS altitude_moyenne FROM {{orders}} WHERE o_orderstatus = 'F' GROUP BY o_custkey""",
        "zip_codes": f"""
SELECT CASE c_nationkey WHEN 5 THEN CAST(75000 + c_custkey % 20 AS STRING) WHEN 6 THEN CAST(69001 + c_custkey % 9 AS STRING) WHEN 7 THEN CAST(13000 + c_custkey % 17 AS STRING)
  ELSE lpad(CAST(c_nationkey * 1000 + c_custkey % 7 AS STRING), 5, '0') END AS Code_postal,
  {code("c_custkey")} AS code_insee FROM {{customer}}""",
        "populations": f"""
SELECT {code("o_custkey")} AS GEO, CASE WHEN o_orderstatus = 'P' THEN 'DEP' ELSE 'COM' END AS GEO_OBJECT, {YEAR} AS TIME_PERIOD, CAST(count(*) * 1000 AS STRING) AS OBS_VALUE
FROM {{orders}} GROUP BY o_custkey, year(o_orderdate), CASE WHEN o_orderstatus = 'P' THEN 'DEP' ELSE 'COM' END""",
        "overseas_population": f"""
SELECT 'S' || CAST(l_suppkey AS STRING) AS commune_id, CAST(year(l_shipdate) AS STRING) AS year, CAST(count(*) * 10 AS STRING) AS population FROM {{lineitem}} GROUP BY l_suppkey, year(l_shipdate)
UNION ALL SELECT {code("o_custkey")}, {YEAR}, CAST(count(*) * 1500 AS STRING) FROM {{orders}} WHERE o_orderstatus = 'P' GROUP BY o_custkey, year(o_orderdate)""",
        "births": f"""
SELECT {code("o_custkey")} AS GEO, 'COM' AS GEO_OBJECT, {YEAR} AS TIME_PERIOD, CAST(count(*) * 7 AS STRING) AS OBS_VALUE, CASE WHEN o_orderstatus = 'F' THEN 'LVB' ELSE 'OTH' END AS EC_MEASURE
FROM {{orders}} GROUP BY o_custkey, year(o_orderdate), CASE WHEN o_orderstatus = 'F' THEN 'LVB' ELSE 'OTH' END""",
        "deaths": f"""
SELECT {code("o_custkey")} AS GEO, 'COM' AS GEO_OBJECT, {YEAR} AS TIME_PERIOD, CAST(count(*) * 5 AS STRING) AS OBS_VALUE, 'DTH' AS EC_MEASURE, CASE WHEN o_orderpriority < '3' THEN 'A' ELSE 'P' END AS OBS_STATUS
FROM {{orders}} GROUP BY o_custkey, year(o_orderdate), CASE WHEN o_orderpriority < '3' THEN 'A' ELSE 'P' END""",
        "family": f"""
SELECT {code("o_custkey")} AS GEO, 'COM' AS GEO_OBJECT, {YEAR} AS TIME_PERIOD,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'CH0_Y_LT25' WHEN '2-HIGH' THEN 'CH1_Y_LT25' WHEN '3-MEDIUM' THEN 'CH2_Y_LT25' WHEN '4-NOT SPECIFIED' THEN 'CH3_Y_LT25' ELSE 'CH_GE4_Y_LT25' END AS NCH,
  '_T' AS TFN, CAST(count(*) * 11 AS STRING) AS OBS_VALUE FROM {{orders}} GROUP BY o_custkey, year(o_orderdate), o_orderpriority
UNION ALL
SELECT {code("o_custkey")}, 'COM', {YEAR}, '_T', CASE o_orderstatus WHEN 'F' THEN '11' WHEN 'O' THEN '12' ELSE '223' END, CAST(count(*) * 3 AS STRING)
FROM {{orders}} GROUP BY o_custkey, year(o_orderdate), o_orderstatus""",
        "migration": f"""
SELECT {code("o_custkey")} AS CODGEO, 'COM' AS NIVGEO, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '2' END AS IMMI, CASE WHEN o_orderpriority < '3' THEN '1' ELSE '2' END AS SEXE,
  CAST(count(*) AS STRING) AS NB FROM {{orders}}
GROUP BY o_custkey, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '2' END, CASE WHEN o_orderpriority < '3' THEN '1' ELSE '2' END""",
        "salaries": f"""
SELECT {code("o_custkey")} AS GEO, 'COM' AS GEO_OBJECT, {YEAR} AS TIME_PERIOD, CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' ELSE '_T' END AS SEX,
  CASE o_orderpriority WHEN '1-URGENT' THEN '1T3' WHEN '2-HIGH' THEN '4' WHEN '3-MEDIUM' THEN '5' WHEN '4-NOT SPECIFIED' THEN '6' ELSE '_T' END AS PCS_ESE,
  CAST(CAST(floor(max(o_totalprice) / 10) AS BIGINT) AS STRING) AS OBS_VALUE FROM {{orders}} GROUP BY o_custkey, year(o_orderdate), o_orderstatus, o_orderpriority""",
        # Labour counts per commune and year, as one delivery per year with prefixed columns.
        "labour": f"""
SELECT {code("o_custkey")} AS code, CAST(year(o_orderdate) AS INT) AS y, count(*) * 60 AS act, count(*) * 7 AS chom_h,
  CASE WHEN max(o_totalprice) > 300000 THEN count(*) * 6 END AS chom_f, CASE WHEN min(o_totalprice) < 100000 THEN count(*) * 13 END AS chom
FROM {{orders}} GROUP BY o_custkey, year(o_orderdate)""",
        "income_wide": f"""
SELECT {district("c_nationkey", "c_custkey")} AS id, c_custkey AS k, c_nationkey AS nation, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS med, CAST(c_custkey % 97 AS STRING) AS rate FROM {{customer}}""",
        "bpe": f"""
SELECT {code("l_suppkey")} AS GEO, CASE WHEN l_linestatus = 'O' THEN 'COM' ELSE 'DEP' END AS GEO_OBJECT, CAST(year(l_shipdate) AS STRING) AS TIME_PERIOD,
  CASE WHEN l_returnflag = 'R' THEN '_T' ELSE 'B' || CAST(l_partkey % 25 + 1 AS STRING) END AS FACILITY_TYPE, CAST(CAST(l_quantity AS INT) AS STRING) AS OBS_VALUE FROM {{lineitem}}""",
        "equipment": """
SELECT DISTINCT replace(p_brand, 'Brand#', 'B') AS equipment_code, p_brand AS equipment_name, 'S' AS subdomain_code, 'Sub' AS subdomain_name, 'D' AS domain_code, 'Dom' AS domain_name
FROM {part} WHERE p_brand <> 'Brand#25'""",
        "criminality": f"""
SELECT {district("o_custkey % 25", "o_custkey")} AS CODGEO_2025, CAST(year(o_orderdate) AS INT) AS annee, CASE o_orderpriority WHEN '1-URGENT' THEN 'Menaces' WHEN '2-HIGH' THEN 'Vols avec armes' WHEN '5-LOW' THEN 'Inconnu' ELSE 'Drogue (usage)' END AS indicateur,
  CAST(o_orderkey % 40 AS INT) AS nombre, CASE WHEN o_orderstatus = 'F' THEN 'diff' ELSE 'ndiff' END AS est_diffuse, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 9 AS DOUBLE) / 2 END AS complement_info_nombre,
  CAST(o_custkey AS INT) AS insee_pop, 3 AS insee_log FROM {{orders}}""",
        "indicators": """
SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN '2' ELSE '3' END AS indicateur_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Menaces' WHEN '2-HIGH' THEN 'Vols avec armes' ELSE 'Drogue (usage)' END AS name_fr,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Threats' WHEN '2-HIGH' THEN 'Armed robbery' ELSE 'Drug use' END AS name_en,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Victime' ELSE 'Infraction' END AS unite_de_compte_fr, CASE o_orderpriority WHEN '1-URGENT' THEN 'Victim' ELSE 'Offence' END AS unite_de_compte_en
FROM {orders} WHERE o_orderpriority <> '5-LOW'""",
        # One monument per order: codes with label, of districts, unknown or missing; a text of
        # up to three dated protections.
        "monuments": f"""
SELECT 'PA' || CAST(o_orderkey AS STRING) AS reference, o_orderpriority AS denomination,
  CASE o_orderpriority WHEN '1-URGENT' THEN CASE o_orderkey % 9 WHEN 0 THEN 'architecture domestique' WHEN 1 THEN 'architecture administrative' WHEN 2 THEN 'architecture militaire' WHEN 3 THEN 'industrie et artisanat' WHEN 4 THEN 'industrie'
    WHEN 5 THEN 'architecture agricole' WHEN 6 THEN 'architecture scolaire et éducative' ELSE 'architecture religieuse' END WHEN '2-HIGH' THEN 'architecture funéraire' WHEN '3-MEDIUM' THEN 'génie civil' WHEN '5-LOW' THEN NULL ELSE 'autre' END AS domaine,
  CASE o_orderstatus WHEN 'F' THEN 'Classé MH partiellement' WHEN 'O' THEN 'inscrit MH' ELSE 'zone' END AS typologie,
  CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderpriority = '5-LOW' THEN '"751' || lpad(CAST(o_orderkey % 20 AS STRING), 2, '0') || '"' WHEN o_orderpriority = '2-HIGH' THEN '75101 : Paris' ELSE {code("o_custkey")} END AS code1,
  CASE WHEN o_orderstatus = 'F' THEN {code("o_orderkey % 1200")} END AS code2,
  CAST(o_orderkey % 50 AS DOUBLE) / 10 + 0.05 AS x, CAST(o_custkey % 300 AS DOUBLE) / 100 - 39.995 AS y,
  CAST(year(o_orderdate) AS STRING) || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') AS d1,
  CAST(year(o_orderdate) + 1 AS STRING) || '/' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/15' AS d2, o_orderstatus AS s, o_orderpriority AS p
FROM {{orders}}""",
        "visits": f"""
SELECT {code("o_custkey")} AS id, CAST(min(o_orderdate) AS DATE) AS visit_date, 'DCIM/' || CAST(o_custkey AS STRING) || '.jpg' AS photo FROM {{orders}} GROUP BY o_custkey HAVING max(o_totalprice) > 300000""",
    }
)
