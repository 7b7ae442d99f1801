"""The published tables and reports, built by the recipes from derived source tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.operators.aggregates import top
from cadastra.plans import calendar as CAL
from cadastra.plans import demography as D
from cadastra.plans import equipment as E
from cadastra.plans import heritage as M
from cadastra.plans import names as N
from cadastra.plans import provenance as PR
from cadastra.plans import reports as R
from cadastra.plans import rules as RULES
from cadastra.plans import territory as T
from cadastra.plans import visits as V
from cadastra.queries import derived  # noqa: F401
from cadastra.queries import expected as W
from cadastra.queries.registry import CHECK_PARTS, Tables, query
from cadastra.session import ensure_checkpoint_dir, pin

# -- tables shared by several queries --------------------------------------------------------


def communes(t: Tables):
    return T.dim_communes(t.cog_communes, t.cog_departements, t.cog_arrondissements, t.cog_regions, t.cog_communes_comer)


def shapes(t: Tables):
    box = geo.box_polygon(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return t.boxes.select("code", "nom", "departement", "region", "epci", box.alias("geometry"))


def geography(t: Tables, towns=None):
    return T.dim_geography(
        shapes(t), T.mountain_zones(t.mountain_perimeter), T.littoral(t.littoral_perimeter), t.altitude,
        T.island_communes(communes(t) if towns is None else towns),
    )


def population(t: Tables):
    return D.fact_population(t.populations, t.overseas_population, t.births, t.deaths, t.family, t.migration)


def salaries(t: Tables):
    return D.fact_salaries(t.salaries)


def zip_codes(t: Tables):
    return t.zip_codes.withColumnRenamed("code_insee", "#Code_commune_INSEE")


def indicators(t: Tables):
    return E.dim_criminality_indicateur(t.indicators)


def monument_source(t: Tables):
    """Monuments in the shape of the source: codes as a list, dated protections as one text."""
    level = F.when(F.col("s") == "F", "Classé MH").when(F.col("s") == "O", "inscrit MH").otherwise("Zone ")
    later = F.when(F.col("p") == "1-URGENT", "inscrit partiellement").otherwise("classé")
    history = F.concat(
        "d1", F.lit(" : "), level, F.lit(";"), "d2", F.lit(" : "), later, F.lit("; ;sans date : classé;1990/5/6 : classé"),
    )
    text = F.when(F.col("p") != "5-LOW", history)
    codes = F.when(F.col("code2").isNull(), F.array("code1")).otherwise(F.array("code1", "code2"))
    blank = {
        s: F.lit(None).cast("string")
        for s, _ in M.MONUMENT_FIELDS
        if s not in ("reference", "denomination_de_l_edifice", "domaine", "typologie_de_la_protection", "date_et_typologie_de_la_protection")
    }
    return t.monuments.select(
        "reference", F.col("denomination").alias("denomination_de_l_edifice"), "domaine",
        F.col("typologie").alias("typologie_de_la_protection"), text.alias("date_et_typologie_de_la_protection"),
        codes.alias("cog_insee_lors_de_la_protection"), "x", "y", *[c.alias(n) for n, c in blank.items()],
    )


def stored_communes(t: Tables):
    return t.stored("communes", lambda: communes(t))


def bridge(t: Tables):
    return M.bridge_monument_communes(monument_source(t), stored_communes(t))


def monuments(t: Tables):
    outlines = shapes(t).select(F.col("code").alias("commune_id"), "geometry")
    return M.dim_monument(monument_source(t), stored_communes(t), outlines)


# The listed island communes, spelled out apart from the recipe's constants.
ISLAND_CODES = (
    "17019 17051 17121 17161 17207 17286 17297 17318 17369 17360 17486 17093 17140 17485 17323 17337 17385 17411 56009 56114 56152 56241 "
    "85011 85083 85106 85163 17004 56088 29082 22016 56069 56085 56086 56087 29084 29155 29083 85113"
).split()
IN_ISLANDS = "IN (" + ", ".join(f"'{c}'" for c in ISLAND_CODES) + ")"
# Fields that the derived monuments leave blank.
MONUMENT_ABSENT = [
    "alternative_name", "nature", "legal_status", "current_use", "century", "author", "conservation_state", "cadastre", "lieu_dit",
    "vocable", "description", "historical", "source_url", "palissy_url",
]
# Spelled out here, apart from the recipe's own constants.
SALARY_SQL = ", ".join(
    f"max(v) FILTER (WHERE SEX = '{sex}' AND PCS_ESE = '{job}') AS mean_salary{name}{suffix}"
    for name, job in [("", "_T"), ("_management_position", "1T3"), ("_intermediate_position", "4"), ("_service_workers", "5"), ("_manual_workers", "6")]
    for suffix, sex in [("", "_T"), ("_men", "M"), ("_women", "F")]
)

CHECK_PARTS.update(
    {
        "o_communes": """
SELECT c.COM AS id, NCCENR AS name, NCC AS name_upper, nullif(c.ARR, '') AS arrondissement_code, a.LIBELLE AS arrondissement_name, c.DEP AS department_code, d.LIBELLE AS department_name,
 c.REG AS region_code, r.LIBELLE AS region_name, 'METROPOLE_DROM' AS territory_type, CAST(c.DEP LIKE '2_' AND right(c.DEP, 1) IN ('A', 'B') AS INTEGER) AS flag_corsica,
 CAST(length(c.DEP) <> 3 AS INTEGER) AS flag_metropole, CAST(coalesce(d.CHEFLIEU = c.COM, false) AS INTEGER) AS flag_prefecture, CAST(coalesce(a.CHEFLIEU = c.COM, false) AS INTEGER) AS flag_chef_lieu_arrondissement,
 CAST(coalesce(a.CHEFLIEU = c.COM AND d.CHEFLIEU <> c.COM, false) AS INTEGER) AS flag_sous_prefecture
FROM {cog_communes} c LEFT JOIN {cog_departements} d USING (DEP) LEFT JOIN {cog_arrondissements} a ON a.ARR = c.ARR LEFT JOIN {cog_regions} r ON r.REG = c.REG WHERE TYPECOM = 'COM'
UNION ALL SELECT COM_COMER, NCCENR, NCC, NULL, NULL, COMER, LIBELLE_COMER, COMER, LIBELLE_COMER, 'COM', 0, 0, 0, 0, 0 FROM {cog_communes_comer}""",
        "o_geography": """
SELECT b.code AS commune_id, b.nom AS name, b.departement AS department_code, b.region AS region_code, b.epci, i, j, x0, x1, y0, y1,
 code IN (SELECT INSEE_COM FROM {mountain_perimeter}) AS is_mountain,
 code IN (SELECT INSEE_COM FROM {littoral_perimeter} WHERE CLASSEMENT = 'Mer') AS is_coast, code IN (SELECT INSEE_COM FROM {littoral_perimeter} WHERE CLASSEMENT = 'Estuaire') AS has_estuary,
 code IN (SELECT INSEE_COM FROM {littoral_perimeter} WHERE CLASSEMENT = 'Lac') AS has_lake,
 CAST(altitude_min AS INTEGER) AS altitude_min, CAST(altitude_max AS INTEGER) AS altitude_max, CAST(altitude_moyenne AS DOUBLE) AS altitude_moyenne,
 coalesce(c.department_code IN ('2A', '2B', '971', '972', '974', '976'), false) AS is_insular, coalesce(c.id """ + IN_ISLANDS + """, false) AS is_island_commune,
 (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy
FROM {boxes} b LEFT JOIN {altitude} ON commune_id = code LEFT JOIN {o_communes} c ON c.id = b.code""",
        "o_pop": """
SELECT id, year, max(v) AS population FROM (SELECT GEO AS id, CAST(TIME_PERIOD AS INTEGER) AS year, CAST(OBS_VALUE AS INTEGER) AS v FROM {populations} WHERE GEO_OBJECT = 'COM'
 UNION ALL SELECT commune_id, CAST(year AS INTEGER), CAST(population AS INTEGER) FROM {overseas_population}) GROUP BY id, year""",
        "o_population": """
SELECT k.id, k.year, p.population, p.population - q.population AS year_evolution, (p.population - q.population)::DOUBLE * 100 / nullif(q.population::DOUBLE, 0) AS year_evolution_percent
FROM (SELECT id, year FROM {o_pop} UNION SELECT GEO, CAST(TIME_PERIOD AS INTEGER) FROM {births} WHERE EC_MEASURE = 'LVB' UNION SELECT GEO, CAST(TIME_PERIOD AS INTEGER) FROM {deaths} WHERE OBS_STATUS = 'A'
 UNION SELECT GEO, CAST(TIME_PERIOD AS INTEGER) FROM {family} UNION SELECT CODGEO, 2022 FROM {migration}) k
LEFT JOIN {o_pop} p ON p.id = k.id AND p.year = k.year LEFT JOIN {o_pop} q ON q.id = k.id AND q.year = k.year - 1""",
        "o_salaries": """
SELECT GEO AS id, CAST(TIME_PERIOD AS INTEGER) AS year, """ + SALARY_SQL + """
FROM (SELECT *, CAST(OBS_VALUE AS INTEGER) AS v FROM {salaries}) GROUP BY GEO, TIME_PERIOD""",
        "o_bridge": r"""
WITH raw AS (SELECT reference, code1 AS c FROM {monuments} UNION ALL SELECT reference, code2 FROM {monuments} WHERE code2 IS NOT NULL),
clean AS (SELECT DISTINCT reference, CASE WHEN c LIKE '751__' OR c LIKE '"751%' OR c LIKE '75101 %' THEN '75056' ELSE c END AS c FROM raw WHERE c <> ''),
mapped AS (SELECT DISTINCT reference AS monument_reference, CASE WHEN regexp_matches(c, '^6938[0-9]$') THEN '69123' WHEN regexp_matches(c, '^132[0-9][0-9]$') THEN '13055' ELSE c END AS commune_code FROM clean)
SELECT m.*, commune_code = min(commune_code) OVER (PARTITION BY monument_reference) AS is_primary, c.id IS NOT NULL AS commune_exists FROM mapped m LEFT JOIN {o_communes} c ON c.id = commune_code""",
        "o_monuments": """
WITH coded AS (SELECT *, CASE WHEN code1 LIKE '"751%' OR code1 LIKE '751__' OR code1 LIKE '75101 %' THEN '75056' WHEN code1 LIKE '6938_' THEN '69123' WHEN code1 LIKE '132__' THEN '13055' ELSE code1 END AS c FROM {monuments}),
known AS (SELECT m.*, o.id IS NOT NULL AS ok FROM coded m LEFT JOIN {o_communes} o ON o.id = c),
hit AS (SELECT reference, min(commune_id) AS g FROM known JOIN {o_geography} ON NOT ok AND x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY reference)
SELECT reference, denomination AS name, domaine AS domain, CASE s WHEN 'F' THEN 'classé' WHEN 'O' THEN 'inscrit' END AS protection_level, CASE WHEN s = 'F' THEN 'partiellement' END AS protection_scope,
 CASE WHEN p <> '5-LOW' THEN CAST(strptime(d1, '%Y/%m/%d') AS DATE) END AS first_protection_date, CASE WHEN p <> '5-LOW' THEN DATE '1990-05-06' END AS last_protection_date,
 CASE WHEN ok THEN c ELSE coalesce(g, c) END AS primary_commune_code, x AS longitude, y AS latitude, denomination, """ + ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in MONUMENT_ABSENT) + """
FROM known LEFT JOIN hit USING (reference)""",
        "o_stats": """
SELECT id AS commune_id, count(DISTINCT reference) AS total_monuments, count(DISTINCT CASE WHEN domain = 'architecture religieuse' THEN reference END) AS religious_count,
 count(DISTINCT CASE WHEN domain LIKE 'architecture fun%' THEN reference END) AS funerary_count,
 count(DISTINCT CASE WHEN domain = 'architecture domestique' THEN reference END) AS domestic_count, count(DISTINCT CASE WHEN domain = 'architecture administrative' THEN reference END) AS administrative_count,
 count(DISTINCT CASE WHEN domain = 'architecture militaire' THEN reference END) AS military_count, count(DISTINCT CASE WHEN domain IN ('industrie et artisanat', 'industrie') THEN reference END) AS industrial_count,
 count(DISTINCT CASE WHEN domain = 'architecture agricole' THEN reference END) AS agricultural_count, count(DISTINCT CASE WHEN domain = 'architecture scolaire et éducative' THEN reference END) AS educational_count, count(DISTINCT CASE WHEN domain = 'génie civil' THEN reference END) AS civil_engineering_count,
 count(DISTINCT CASE WHEN reference IS NOT NULL AND (domain IS NULL OR domain = 'autre') THEN reference END) AS other_count, count(DISTINCT CASE WHEN protection_level = 'classé' THEN reference END) AS classified_count,
 count(DISTINCT CASE WHEN protection_level = 'inscrit' THEN reference END) AS inscribed_count, count(DISTINCT CASE WHEN protection_scope IS NOT NULL THEN reference END) AS partial_protection_count
FROM {o_communes} LEFT JOIN {o_bridge} ON commune_code = id LEFT JOIN {o_monuments} ON monument_reference = reference GROUP BY id""",
    }
)


# -- territory -------------------------------------------------------------------------------


@query("dim_communes", "SELECT * FROM o_communes", ("o_communes",))
def dim_communes(t: Tables):
    """Communes with division names and flags, overseas collectivities included."""
    return communes(t)


@query("littoral_and_mountain", """
SELECT INSEE_COM AS commune_id, bool_or(CLASSEMENT = 'Mer') AS is_coast, bool_or(CLASSEMENT = 'Estuaire') AS has_estuary, bool_or(CLASSEMENT = 'Lac') AS has_lake,
 INSEE_COM IN (SELECT INSEE_COM FROM mountain_perimeter) AS is_mountain FROM littoral_perimeter GROUP BY 1""", ("littoral_perimeter", "mountain_perimeter"))
def littoral_and_mountain(t: Tables):
    """Shore flags and mountain zones per commune."""
    zones = T.mountain_zones(t.mountain_perimeter).withColumn("is_mountain", F.lit(True))
    joined = T.littoral(t.littoral_perimeter).join(zones, "commune_id", "left")
    return joined.withColumn("is_mountain", F.coalesce("is_mountain", F.lit(False)))


@query("island_communes", f"""
SELECT id, department_code IN ('2A', '2B', '971', '972', '974', '976', '981', '984') AS is_insular, id {IN_ISLANDS} AS is_island_commune FROM o_communes""", ("o_communes",))
def island_communes(t: Tables):
    """Insular departments and island communes."""
    return T.island_communes(communes(t)).select("id", "is_insular", "is_island_commune")


@query("unknown_island_codes", """
SELECT count(*) FILTER (WHERE id IS NULL) AS n_missing FROM (VALUES {}) v(code) LEFT JOIN o_communes ON id = code""".format(
    ", ".join(f"('{c}')" for c in ISLAND_CODES)
), ("o_communes",))
def unknown_island_codes(t: Tables):
    """Listed island codes that no commune has."""
    return T.unknown_islands(communes(t)).agg(F.count("*").alias("n_missing"))


A2, E2 = 6378137.0**2, (1 / 298.257223563) * (2 - 1 / 298.257223563)
Q = "(1 - {e2}) * (sin(radians({y})) / (1 - {e2} * sin(radians({y})) ** 2) - ln((1 - sqrt({e2}) * sin(radians({y}))) / (1 + sqrt({e2}) * sin(radians({y})))) / (2 * sqrt({e2})))"
AREA_SQL = f"{A2!r}::DOUBLE / 2 * radians(x1 - x0) * ({Q.format(e2=f'{E2!r}::DOUBLE', y='y1')} - {Q.format(e2=f'{E2!r}::DOUBLE', y='y0')}) / 1000000"


@query("dim_geography", f"""
SELECT commune_id, name, department_code, region_code, epci, is_mountain, is_coast, has_estuary, has_lake, altitude_min, altitude_max, altitude_moyenne, is_insular, is_island_commune,
 round(cx, 6) AS cx, round(cy, 6) AS cy, CASE WHEN department_code NOT IN ('2A', '2B') THEN round({AREA_SQL}, 4) END AS area_km2, x0 AS bbox_xmin, x1 AS bbox_xmax, y0 AS bbox_ymin, y1 AS bbox_ymax,
 round(2 * (x1 - x0) + 2 * (y1 - y0), 6) AS perimeter, false AS is_multipolygon, CAST(0 AS INTEGER) AS number_enclaves FROM o_geography""", ("o_geography",))
def dim_geography(t: Tables):
    """R2: shapes with measures (true areas, Corsica NULL) and attribute flags."""
    table = geography(t)
    return table.withColumns(
        {"cx": F.round("centroid.x", 6), "cy": F.round("centroid.y", 6), "area_km2": F.round("area_km2", 4), "perimeter": F.round("perimeter", 6)}
    ).drop("geometry", "centroid")


@query("dim_neighbour_communes", """
SELECT a.commune_id AS parcel_id, b.commune_id AS neighbor_id FROM o_geography a JOIN o_geography b ON abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 AND a.commune_id <> b.commune_id
JOIN o_communes c ON c.id = a.commune_id JOIN o_communes d ON d.id = b.commune_id
WHERE c.flag_corsica = d.flag_corsica AND c.flag_metropole = d.flag_metropole AND (c.flag_metropole = 0 OR c.department_code = d.department_code)""", ("o_geography", "o_communes"))
def dim_neighbour_communes(t: Tables):
    """Touching communes of the same part of the territory."""
    return T.dim_neighbour_communes(shapes(t).withColumnRenamed("code", "commune_id"), communes(t))


@query("dim_zip_codes", """
SELECT CAST(Code_postal AS INTEGER) AS id, Code_postal AS zip_code_char, left(Code_postal, 2) AS zip_code_main_department, count(DISTINCT code_insee) AS number_of_communes,
 count(DISTINCT left(code_insee, 2)) AS number_of_departments FROM zip_codes GROUP BY Code_postal""", ("zip_codes",))
def dim_zip_codes(t: Tables):
    """Postal codes with the communes and departments they serve."""
    return T.dim_zip_codes(zip_codes(t))


@query("bridge_communes_zip_codes", """
SELECT DISTINCT commune_id, z AS zip_code_id, zip_code_char FROM (SELECT CAST(Code_postal AS INTEGER) AS z, Code_postal AS zip_code_char,
  CASE WHEN Code_postal LIKE '75___' THEN '75056' WHEN CAST(Code_postal AS INTEGER) BETWEEN 13000 AND 13020 THEN '13055' WHEN CAST(Code_postal AS INTEGER) BETWEEN 69001 AND 69010 THEN '69123' ELSE code_insee END AS commune_id FROM zip_codes)
WHERE EXISTS (SELECT 1 FROM o_communes WHERE id = commune_id)""", ("zip_codes", "o_communes"))
def bridge_communes_zip_codes(t: Tables):
    """Commune and postal code pairs within the commune table."""
    return T.bridge_communes_zip_codes(zip_codes(t), communes(t))


@query("rules_of_communes", """
WITH l(rule, "column", failures) AS (
 SELECT 'unique', 'id', count(*) FROM (SELECT 1 FROM o_communes GROUP BY id HAVING count(*) > 1)
 UNION ALL SELECT 'not_null', v.c, count(*) FILTER (WHERE v.x IS NULL) FROM o_communes, LATERAL (SELECT * FROM (VALUES ('id', id), ('name', name), ('department_code', department_code), ('department_name', department_name)) q(c, x)) v GROUP BY v.c
 UNION ALL SELECT 'accepted_values', 'territory_type', count(*) FILTER (WHERE territory_type NOT IN ('METROPOLE_DROM', 'COM')) FROM o_communes
 UNION ALL SELECT 'accepted_values', v.c, count(*) FILTER (WHERE v.x NOT IN (0, 1)) FROM o_communes, LATERAL (SELECT * FROM (VALUES ('flag_corsica', flag_corsica), ('flag_metropole', flag_metropole), ('flag_prefecture', flag_prefecture),
   ('flag_chef_lieu_arrondissement', flag_chef_lieu_arrondissement), ('flag_sous_prefecture', flag_sous_prefecture)) q(c, x)) v GROUP BY v.c)
SELECT rule, "column", 'error' AS severity, failures FROM l""", ("o_communes",))
def rules_of_communes(t: Tables):
    """DQ1, DQ2, DQ4: the published rules of the commune table."""
    return RULES.check_table("dim_communes", communes(t))


# -- demography ------------------------------------------------------------------------------

FAMILY_SQL = ", ".join(
    f"max(v) FILTER (WHERE NCH = '{nch}' AND TFN = '{tfn}') AS {name}" for name, (nch, tfn) in W.FAMILY_CELLS.items()
)
MIGRATION_SQL = ", ".join(
    f"sum(NB::DOUBLE) FILTER (WHERE {' AND '.join([f'IMMI = {i!r}'] * bool(i) + [f'SEXE = {s!r}'] * bool(s)) or 'true'}) AS {name}"
    for name, (i, s) in W.MIGRATION_CELLS.items()
)


@query("fact_population", f"""
WITH b AS (SELECT GEO AS id, CAST(TIME_PERIOD AS INTEGER) AS year, max(CAST(OBS_VALUE AS INTEGER)) AS births FROM births WHERE EC_MEASURE = 'LVB' GROUP BY 1, 2),
d AS (SELECT GEO AS id, CAST(TIME_PERIOD AS INTEGER) AS year, max(CAST(OBS_VALUE AS INTEGER)) AS deaths FROM deaths WHERE OBS_STATUS = 'A' GROUP BY 1, 2),
f AS (SELECT GEO AS id, CAST(TIME_PERIOD AS INTEGER) AS year, {FAMILY_SQL} FROM (SELECT *, CAST(OBS_VALUE AS INTEGER) AS v FROM family) GROUP BY GEO, TIME_PERIOD),
m AS (SELECT CODGEO AS id, CAST(2022 AS INTEGER) AS year, {MIGRATION_SQL} FROM migration GROUP BY CODGEO)
SELECT id, year, CAST(year * 10000 + 101 AS INTEGER) AS date_id, population, year_evolution, year_evolution_percent, births, deaths, births - deaths AS birth_death_diff,
 {", ".join(W.FAMILY_CELLS)}, {", ".join(W.MIGRATION_CELLS)}
FROM o_population LEFT JOIN b USING (id, year) LEFT JOIN d USING (id, year) LEFT JOIN f USING (id, year) LEFT JOIN m USING (id, year)""", ("o_population",))
def fact_population(t: Tables):
    """Population with change, births, deaths, families and migration."""
    return population(t)


@query("fact_salaries", """
SELECT *, CAST(year * 10000 + 101 AS INTEGER) AS date_id FROM o_salaries""", ("o_salaries",))
def fact_salaries(t: Tables):
    """Salaries by occupation and sex."""
    return salaries(t)


def unemployment(t: Tables):
    """The yearly deliveries: prefixed columns, one frame per year that the data has. They are stored by year, so
    that each frame reads its own files only."""
    path = f"{ensure_checkpoint_dir(t.spark)}/labour-{uuid.uuid4().hex}"
    t.labour.write.partitionBy("y").parquet(path)
    labour = t.spark.read.schema(t.labour.schema).parquet(path)
    frames = []
    for (year,) in sorted(labour.select("y").distinct().collect()):
        rows = labour.filter(F.col("y") == year)
        p = f"P{year % 100:02d}_"
        frames.append(
            (
                year,
                rows.select(
                    F.col("code").alias("CODGEO"), F.col("act").cast("string").alias(p + "ACT1564"), F.col("chom").cast("string").alias(p + "CHOM1564"),
                    F.col("chom_h").cast("string").alias(p + "HCHOM1564"), F.col("chom_f").cast("string").alias(p + "FCHOM1564"),
                    (F.col("act") - 60).cast("string").alias(p + "HACT1524"), F.col("chom_h").cast("string").alias(p + "HCHOM1524"),
                    F.lit("x").alias("LIBGEO"),
                ),
            )
        )
    return D.fact_unemployment(D.stage_unemployment(frames))


# What the deliveries hold; all other bands and sexes are NULL.
LABOUR_GIVEN = {
    "labor_force_count_total_15_64": "act::DOUBLE", "labor_force_count_men_15_24": "(act - 60)::DOUBLE",
    "unemployed_count_total_15_64": "coalesce(chom, chom_h + chom_f)::DOUBLE", "unemployed_count_men_15_64": "chom_h::DOUBLE",
    "unemployed_count_women_15_64": "chom_f::DOUBLE", "unemployed_count_men_15_24": "chom_h::DOUBLE",
}
LABOUR_PARTS = [f"{sex}_{band}" for band in ("15_64", "15_24", "25_54", "55_64") for sex in ("total", "men", "women")]
LABOUR_COUNTS = ", ".join(
    f"{LABOUR_GIVEN.get(name, 'CAST(NULL AS DOUBLE)')} AS {name}"
    for part in LABOUR_PARTS for name in (f"labor_force_count_{part}", f"unemployed_count_{part}")
)
LABOUR_RATES = ", ".join(
    f"unemployed_count_{p} / nullif(labor_force_count_{p}, 0) * 100 AS unemployment_rate_{p}" for p in LABOUR_PARTS
)


@query("fact_unemployment", f"""
WITH r AS (SELECT code AS commune_code, y AS year, {LABOUR_COUNTS} FROM labour),
s AS (SELECT *, {LABOUR_RATES} FROM r)
SELECT c.*, CASE WHEN c.labor_force_count_total_15_64 >= 500 THEN 'reliable' WHEN c.labor_force_count_total_15_64 >= 200 THEN 'caution' ELSE 'unreliable' END AS reliability_flag,
 p.labor_force_count_total_15_64 AS prev_labor_force_count_total_15_64, p.unemployed_count_total_15_64 AS prev_unemployed_count_total_15_64, p.unemployment_rate_total_15_64 AS prev_unemployment_rate_total_15_64,
 c.labor_force_count_total_15_64 - p.labor_force_count_total_15_64 AS labor_force_evolution_total_15_64, c.unemployed_count_total_15_64 - p.unemployed_count_total_15_64 AS unemployed_evolution_total_15_64,
 c.unemployment_rate_total_15_64 - p.unemployment_rate_total_15_64 AS unemployment_rate_evolution_total_15_64
FROM s c LEFT JOIN s p ON p.commune_code = c.commune_code AND p.year = c.year - 1""", ("labour",))
def fact_unemployment(t: Tables):
    """Prefixed yearly deliveries stacked, rates, reliability and change to the year before."""
    table = unemployment(t)
    return table.select(
        *[F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c) for c, kind in table.dtypes]
    )


# Measures that none of the four vintages below delivers.
INCOME_ABSENT = [
    "decile1", "decile9", "s80_s20", "activity_income_share", "salary_share", "unemployment_share", "pension_share",
    "property_income_share", "social_benefits_share", "family_benefits_share", "minimum_social_share", "housing_benefits_share", "tax_share",
]


@query("fact_income", """
WITH u AS (SELECT id, 2013 AS year, 'filosofi_1' AS v, med, rate, k FROM income_wide UNION ALL SELECT id, 2014, 'filosofi_1', med, rate, k FROM income_wide
 UNION ALL SELECT id, 2021, 'filosofi_1', med, NULL, k FROM income_wide UNION ALL SELECT id, 2023, 'filosofi_2', med, rate, k FROM income_wide)
SELECT id, CAST(year AS INTEGER) AS year, v AS methodology_version, CAST(med AS FLOAT) AS median_income, CASE WHEN year <> 2021 THEN CAST(rate AS FLOAT) END AS poverty_rate,
 CAST(CASE WHEN year IN (2013, 2014) THEN k + 1 WHEN year = 2021 THEN k END AS INTEGER) AS nb_persons, CAST(CASE WHEN year = 2013 THEN 0.25 WHEN year = 2023 THEN 0.5 END AS FLOAT) AS gini,
 CAST(NULL AS INTEGER) AS nb_tax_households, """ + ", ".join(f"CAST(NULL AS FLOAT) AS {c}" for c in INCOME_ABSENT) + """,
 CAST(year * 10000 + 101 AS INTEGER) AS date_id FROM u
WHERE NOT (id LIKE '751__' OR id LIKE '6938_' OR id LIKE '132__')""", ("income_wide",))
def fact_income(t: Tables):
    """Three wide vintages and a long one harmonised, deduplicated, districts left out."""
    key = F.concat(F.lit(" "), F.col("id")).alias("CODGEO")
    comma = F.replace("med", F.lit("."), F.lit(","))
    k = F.col("k")
    wide13 = t.income_wide.select(key, comma.alias("Q213"), (k + 1).cast("string").alias("NBPERS13"), F.lit("0,25").alias("GI13"))
    poverty13 = t.income_wide.select(F.col("id").alias("CODGEO"), F.col("rate").alias("TP6013"), k)
    # A repeated code in the second file: the later row counts.
    stale = poverty13.withColumns({"TP6013": F.lit("-1"), "k": -k - 1})
    wide14 = t.income_wide.select(key, F.concat(F.lit('"'), "med", F.lit('"')).alias("MED14"), F.col("rate").alias("TP6014"), (k + 1).cast("string").alias("NBPERSMENFISC14"), F.lit("9").alias("GI14"))
    wide21 = t.income_wide.select(key, F.col("med").alias("Q221"), k.cast("string").alias("NBPERS21"), F.lit("1").alias("PTSA21"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('" '))
    long_rows = t.income_wide.select(
        quoted(F.lit("COM")).alias("GEO_OBJECT"), quoted(F.col("id")).alias("GEO"),
        F.inline(
            F.array(
                *[
                    F.struct(quoted(F.lit(m)).alias("FILOSOFI_MEASURE"), v.alias("OBS_VALUE"), F.lit(i).alias("o"))
                    for i, (m, v) in enumerate([("MED_SL", F.lit("1")), ("PR_MD60", F.col("rate")), ("GI_SL", F.lit("0.5")), ("OTHER", F.lit("7")), ("MED_SL", F.col("med"))])
                ]
            )
        ),
    )
    # Districts share a code here; only the unique codes are compared below.
    years = [
        D.stage_income_year(2013, wide13, poverty13.unionByName(stale), "k"),
        D.stage_income_year(2014, wide14),
        D.stage_income_year(2021, wide21),
        D.stage_income_long(2023, long_rows, "o"),
    ]
    return D.fact_income(D.stage_income(years))


# -- equipment and crime ---------------------------------------------------------------------


def equipment(t: Tables):
    return E.dim_equipment(t.equipment)


@query("dim_equipment", "SELECT row_number() OVER (ORDER BY equipment_code) AS equipment_type_id, * FROM equipment", ("equipment",))
def dim_equipment(t: Tables):
    """Equipment types numbered by code."""
    return equipment(t)


@query("fact_equipment", """
SELECT c.id AS commune_id, CAST(TIME_PERIOD AS INTEGER) AS year, CAST(CAST(TIME_PERIOD AS INTEGER) * 10000 + 101 AS INTEGER) AS date_id, e.equipment_type_id, CAST(7 AS INTEGER) AS source_id, CAST(sum(CAST(OBS_VALUE AS INTEGER)) AS BIGINT) AS "count"
FROM bpe LEFT JOIN o_communes c ON c.id = GEO LEFT JOIN (SELECT equipment_code, row_number() OVER (ORDER BY equipment_code) AS equipment_type_id FROM equipment) e ON e.equipment_code = FACILITY_TYPE
WHERE GEO_OBJECT = 'COM' AND FACILITY_TYPE <> '_T' GROUP BY GEO, c.id, TIME_PERIOD, FACILITY_TYPE, e.equipment_type_id""", ("bpe", "o_communes", "equipment"))
def fact_equipment(t: Tables):
    """Equipment counts; unknown communes and types stay as NULL keys; the source id is looked
    up by name."""
    sources = t.spark.createDataFrame([(3, "births"), (7, "bpe")], "source_id int, source_name string")
    source = sources.filter("source_name = 'bpe'").select(F.max("source_id")).scalar()
    return E.fact_equipment(t.bpe, communes(t), equipment(t), source)


CRIME_SQL = """
SELECT CASE WHEN CODGEO_2025 LIKE '751__' THEN '75056' WHEN CODGEO_2025 LIKE '6938_' THEN '69123' WHEN CODGEO_2025 LIKE '132__' THEN '13055' ELSE CODGEO_2025 END AS commune_id, annee, CAST(indicateur_id AS INTEGER) AS indicateur_id,
 CAST(sum(nombre) AS BIGINT) AS nombre, round(sum(nombre)::DOUBLE * 1000 / nullif(sum(insee_pop), 0)::DOUBLE, 2) AS taux_pour_mille, CASE WHEN bool_or(est_diffuse = 'diff') THEN 'diff' ELSE 'ndiff' END AS est_diffuse,
 sum(complement_info_nombre) AS complement_info_nombre, round(sum(complement_info_nombre) * 1000 / nullif(sum(insee_pop), 0)::DOUBLE, 2) AS complement_info_taux, CAST(sum(insee_pop) AS BIGINT) AS insee_pop, CAST(sum(insee_log) AS BIGINT) AS insee_log
FROM {criminality} JOIN {indicators} ON indicateur = name_fr GROUP BY 1, 2, 3"""
CHECK_PARTS["o_crime"] = CRIME_SQL


@query("fact_criminality", "SELECT * FROM o_crime", ("o_crime",))
def fact_criminality(t: Tables):
    """Offences folded into cities, rates from sums, unknown indicators dropped."""
    return E.fact_criminality(t.criminality, indicators(t))


@query("criminality_wide", """
SELECT commune_id, annee, max(nombre) FILTER (WHERE indicateur_id = 1) AS threats, max(nombre) FILTER (WHERE indicateur_id = 2) AS armed_robbery, max(nombre) FILTER (WHERE indicateur_id = 3) AS drug_use
FROM o_crime GROUP BY 1, 2""", ("o_crime",))
def criminality_wide(t: Tables):
    """One column per listed indicator."""
    names = {1: "threats", 2: "armed_robbery", 3: "drug_use"}
    return E.criminality_wide(E.fact_criminality(t.criminality, indicators(t)), names)


@query("rules_of_criminality", """
WITH l(rule, "column", severity, failures) AS (
 SELECT 'unique_combination', 'commune_id,annee,indicateur_id', 'error', count(*) FROM (SELECT 1 FROM o_crime GROUP BY commune_id, annee, indicateur_id HAVING count(*) > 1)
 UNION ALL SELECT 'not_null', v.c, 'error', count(*) FILTER (WHERE v.x IS NULL) FROM o_crime, LATERAL (SELECT * FROM (VALUES ('commune_id', commune_id), ('annee', CAST(annee AS VARCHAR)), ('indicateur_id', CAST(indicateur_id AS VARCHAR)), ('est_diffuse', est_diffuse)) q(c, x)) v GROUP BY v.c
 UNION ALL SELECT 'relationship', 'indicateur_id', 'error', count(*) FILTER (WHERE indicateur_id NOT IN (1, 2)) FROM o_crime
 UNION ALL SELECT 'accepted_range', 'annee', 'error', count(*) FILTER (WHERE annee NOT BETWEEN 2016 AND 2025) FROM o_crime
 UNION ALL SELECT 'accepted_range', 'taux_pour_mille', 'warn', count(*) FILTER (WHERE taux_pour_mille NOT BETWEEN 0 AND 1000) FROM o_crime
 UNION ALL SELECT 'accepted_range', 'insee_pop', 'warn', count(*) FILTER (WHERE insee_pop NOT BETWEEN 0 AND 3000000) FROM o_crime
 UNION ALL SELECT 'accepted_range', 'insee_log', 'warn', count(*) FILTER (WHERE insee_log NOT BETWEEN 0 AND 1500000) FROM o_crime)
SELECT * FROM l""", ("o_crime",))
def rules_of_criminality(t: Tables):
    """DQ1, DQ3, DQ5, DQ6: the published rules of the crime table (years break one, an indicator
    missing from the parent another)."""
    facts = E.fact_criminality(t.criminality, indicators(t))
    return RULES.check_table("fact_criminality", facts, {"dim_criminality_indicateur": indicators(t).filter("indicateur_id < 3")})


# -- heritage --------------------------------------------------------------------------------


@query("dim_monument", "SELECT * FROM o_monuments", ("o_monuments",))
def dim_monument(t: Tables):
    """Monuments with protection, dates and commune (by code, else by position)."""
    return monuments(t)


@query("bridge_monument_communes", "SELECT * FROM o_bridge", ("o_bridge",))
def bridge_monument_communes(t: Tables):
    """All communes of each monument, the primary one marked."""
    return bridge(t)


@query("dim_commune_monument_stats", "SELECT * FROM o_stats", ("o_stats",))
def dim_commune_monument_stats(t: Tables):
    """Monuments per commune by domain and protection."""
    return M.dim_commune_monument_stats(stored_communes(t), bridge(t), monuments(t))


@query("fact_classification_history", """
WITH e AS (SELECT reference, CAST(strptime(d1, '%Y/%m/%d') AS DATE) AS d, CASE s WHEN 'F' THEN 'classé' WHEN 'O' THEN 'inscrit' ELSE 'zone' END AS lv, NULL AS sc FROM monuments WHERE p <> '5-LOW'
 UNION ALL SELECT reference, CAST(strptime(d2, '%Y/%m/%d') AS DATE), CASE WHEN p = '1-URGENT' THEN 'inscrit' ELSE 'classé' END, CASE WHEN p = '1-URGENT' THEN 'partiellement' END FROM monuments WHERE p <> '5-LOW'),
l AS (SELECT *, lag(lv) OVER w AS plv, lag(sc) OVER w AS psc FROM e WINDOW w AS (PARTITION BY reference ORDER BY d, lv))
SELECT reference AS monument_reference, d AS event_date, lv AS new_protection_level, sc AS new_protection_scope, plv AS previous_protection_level, psc AS previous_protection_scope,
 CASE WHEN plv IS NULL THEN 'initial' WHEN plv = 'inscrit' AND lv = 'classé' THEN 'upgrade' WHEN plv = 'classé' AND lv = 'inscrit' THEN 'downgrade' WHEN plv = lv THEN 'update' ELSE 'change' END AS event_type FROM l""", ("monuments",))
def fact_classification_history(t: Tables):
    """Protection texts to dated events with the state before each."""
    return M.fact_classification_history(monument_source(t))


# -- calendar --------------------------------------------------------------------------------


# The feasts of the Christian year, spelled out apart from the recipe's constants.
FEASTS_SQL = """
SELECT CAST(make_date(y, k // 31, (k % 31) + 1) + o AS DATE) AS date FROM (
 SELECT y, h + l - 7*((a + 11*h + 22*l)//451) + 114 AS k FROM (
  SELECT y, a, h, (32 + 2*(b % 4) + 2*(c//4) - h - (c % 4)) % 7 AS l FROM (
   SELECT y, a, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS h, b, c FROM (
    SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, year(o_orderdate) % 19 AS a, year(o_orderdate) // 100 AS b, year(o_orderdate) % 100 AS c FROM orders)))),
 (SELECT CAST(unnest([-46, -7, -3, -2, 0, 1, 7, 39, 49, 50, 56, 60, 68]) AS INTEGER) AS o)
UNION SELECT make_date(y, m, d) FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
 (VALUES (1,1),(1,6),(2,2),(3,19),(3,25),(6,24),(6,29),(8,6),(8,15),(9,8),(9,14),(11,1),(11,2),(12,8),(12,25),(12,26),(12,28)) v(m, d)"""


@query("dim_calendar", f"""
WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
terms AS (SELECT c_mktsegment AS name, DATE '1995-01-01' + CAST((length(c_mktsegment) - 8) * 400 + ascii(c_mktsegment) AS INTEGER) AS s FROM customer GROUP BY c_mktsegment),
t AS (SELECT name, s, lead(s) OVER (ORDER BY s, name) AS e FROM terms),
pm AS (SELECT n_name AS name, DATE '1992-06-01' + CAST(n_nationkey * 120 AS INTEGER) AS s, CASE WHEN n_nationkey % 5 <> 4 THEN DATE '1992-06-01' + CAST(n_nationkey * 120 + 100 AS INTEGER) END AS e FROM nation WHERE n_nationkey % 5 <> 4 OR n_nationkey = 24),
lg AS (SELECT r_name AS name, DATE '1900-01-01' + CAST(r_regionkey * 9000 AS INTEGER) AS s, CASE WHEN r_regionkey < 4 THEN DATE '1900-01-01' + CAST(r_regionkey * 9000 + 9000 AS INTEGER) END AS e FROM region),
f AS ({FEASTS_SQL}),
o AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT CAST(strftime(d.date, '%Y%m%d') AS INTEGER) AS date_id, d.date, CAST(year(d.date) AS INTEGER) AS year, CAST(month(d.date) AS INTEGER) AS month, CAST(day(d.date) AS INTEGER) AS day,
 CAST(dayofyear(d.date) AS INTEGER) AS day_of_year, CAST(quarter(d.date) AS INTEGER) AS quarter, strftime(d.date, '%Y-%m') AS year_month,
 CAST(strftime(d.date, '%V') AS INTEGER) AS iso_week, CAST(isodow(d.date) AS INTEGER) AS iso_day_of_week,
 ['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche'][CAST(isodow(d.date) AS INTEGER)] AS day_name_fr,
 ['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre','Novembre','Décembre'][CAST(month(d.date) AS INTEGER)] AS month_name_fr,
 strftime(d.date, '%A') AS day_name_en, strftime(d.date, '%B') AS month_name_en, isodow(d.date) > 5 AS is_weekend, coalesce(o.n >= 3, false) AS is_public_holiday, CASE WHEN o.n >= 3 THEN 'day of ' || o.n ELSE '' END AS fete,
 coalesce(o.n = 2, false) AS is_market_holiday, f.date IS NOT NULL AS is_christian_holiday, coalesce(o.n = 1, false) AS is_jewish_holiday, coalesce(o.n % 3 = 0, false) AS is_muslim_holiday, coalesce(o.n > 4, false) AS is_chinese_holiday,
 coalesce(t.name, '') AS president, coalesce(pm.name, '') AS prime_minister, coalesce(lg.name, '') AS legislature,
 coalesce(CAST(o.n % 28 AS DOUBLE), 0) AS moon_phase_value, CASE WHEN o.n IS NULL THEN '' WHEN o.n % 28 < 1 THEN 'New Moon' WHEN o.n % 28 < 6 THEN 'Waxing Crescent' WHEN o.n % 28 < 8 THEN 'First Quarter' WHEN o.n % 28 < 13 THEN 'Waxing Gibbous' WHEN o.n % 28 < 15 THEN 'Full Moon'
  WHEN o.n % 28 < 20 THEN 'Waning Gibbous' WHEN o.n % 28 < 22 THEN 'Last Quarter' WHEN o.n % 28 < 27 THEN 'Waning Crescent' ELSE 'New Moon' END AS moon_phase_name,
 CASE WHEN o.n IS NULL THEN 0 ELSE CAST(printf('%.2f', 1.0::DOUBLE - abs(o.n % 28 - 14.0::DOUBLE) / 14.0::DOUBLE) AS DOUBLE) END AS moon_illumination_fraction,
 coalesce(o.n % 28 BETWEEN 13 AND 14, false) AS is_full_moon, coalesce(o.n % 28 < 1 OR o.n % 28 >= 27, false) AS is_new_moon,
 CASE WHEN o.n IS NULL THEN 0 ELSE CAST(trunc(datediff('day', DATE '1923-01-17', d.date) / 29.53059::DOUBLE) AS INTEGER) + 1 END AS lunar_cycle_id
FROM d LEFT JOIN o ON o.date = d.date LEFT JOIN f ON f.date = d.date LEFT JOIN t ON d.date >= t.s AND (d.date < t.e OR t.e IS NULL)
 LEFT JOIN pm ON d.date >= pm.s AND (d.date < pm.e OR pm.e IS NULL) LEFT JOIN lg ON d.date >= lg.s AND (d.date < lg.e OR lg.e IS NULL)""")
def dim_calendar(t: Tables):
    """Days between the first and last order with holidays of all traditions, three kinds of terms
    and the moon, all taken from the data; every column of the table."""
    from pyspark.sql import Window

    day = F.col("o_orderdate").cast("date")
    span = t.orders.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("date"))
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy(day.alias("date")).agg(F.count("*").alias("n"))
    public = urgent.filter("n >= 3").select("date", F.concat(F.lit("day of "), F.col("n").cast("string")).alias("holiday_name"), F.lit(True).alias("is_public_holiday"))
    market = urgent.filter("n = 2").select("date", F.lit(True).alias("is_market_holiday"))
    religious = CAL.religious_holidays({
        "christian": CAL.christian_holidays(t.orders.select(F.year("o_orderdate").alias("year")).distinct()),
        "jewish": urgent.filter("n = 1").select("date"), "muslim": urgent.filter("n % 3 = 0").select("date"),
        "chinese": urgent.filter("n > 4").select("date"),
    })
    moon = CAL.lunar_phases(urgent.select("date", (F.col("n") % 28).cast("double").alias("phase")))
    # A handful of segments, nations and regions serve as terms of office.
    segment = F.col("c_mktsegment")
    start = F.date_add(F.lit("1995-01-01").cast("date"), ((F.length(segment) - 8) * 400 + F.ascii(segment)).cast("int"))
    presidents = t.customer.select(segment.alias("name"), start.alias("start_date")).distinct()
    presidents = presidents.withColumn("end_date", F.lead("start_date").over(Window.orderBy("start_date", "name")))

    def term(name: str, key: Column, first: str, step: int, days_: int, open_: Column):
        begin = F.date_add(F.lit(first).cast("date"), (key * step).cast("int"))
        return [F.col(name).alias("name"), begin.alias("start_date"), F.when(~open_, F.date_add(begin, days_)).alias("end_date")]

    nation, region = F.col("n_nationkey"), F.col("r_regionkey")
    ministers = t.nation.filter((nation % 5 != 4) | (nation == 24)).select(*term("n_name", nation, "1992-06-01", 120, 100, nation % 5 == 4))
    legislatures = t.region.select(*term("r_name", region, "1900-01-01", 9000, 9000, region >= 4))
    terms = {"president": presidents, "prime_minister": ministers, "legislature": legislatures}
    return CAL.dim_calendar(days, public, market, religious, terms, moon)


@query("feast_day_orders", """
WITH p AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, year(o_orderdate) % 19 AS a, year(o_orderdate) // 100 AS b, year(o_orderdate) % 100 AS c FROM orders),
q AS (SELECT y, a, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS h, b, c FROM p),
r AS (SELECT y, a, h, (32 + 2*(b % 4) + 2*(c//4) - h - (c % 4)) % 7 AS l FROM q),
s AS (SELECT y, h + l - 7*((a + 11*h + 22*l)//451) + 114 AS k FROM r),
f AS (SELECT CAST(make_date(y, k // 31, (k % 31) + 1) + o AS DATE) AS date FROM s, (SELECT CAST(unnest([-46, -7, -3, -2, 0, 1, 7, 39, 49, 50, 56, 60, 68]) AS INTEGER) AS o)
 UNION SELECT make_date(y, m, d) FROM s, (VALUES (1,1),(1,6),(2,2),(3,19),(3,25),(6,24),(6,29),(8,6),(8,15),(9,8),(9,14),(11,1),(11,2),(12,8),(12,25),(12,26),(12,28)) v(m, d))
SELECT date, count(*) AS n FROM orders JOIN f ON date = CAST(o_orderdate AS DATE) GROUP BY 1""")
def feast_day_orders(t: Tables):
    """Movable and fixed Christian feasts joined to the orders of those days."""
    years = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    per_day = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"))
    return per_day.join(CAL.christian_holidays(years), "date", "left_semi")


def nested_terms(t: Tables):
    """One nested timeline per customer; some entries break a rule."""
    n = F.col("c_nationkey")
    entry = F.struct(
        F.when(n != 1, F.col("c_name")).alias("name"),
        F.when(n == 2, F.lit(None)).when(n == 3, "01/02/2000").otherwise("2000-02-01").alias("start"),
        F.when(n > 10, "2001-02-30").when(n > 5, "2001-02-03").alias("end"),
    )
    return t.customer.select(F.create_map(F.col("c_mktsegment"), F.array(entry)).alias("timelines"))


@query("timeline_tables", """
SELECT c_mktsegment AS category, DATE '2000-02-01' AS start_date, CASE WHEN c_nationkey > 5 THEN DATE '2001-02-03' END AS end_date, c_name AS name FROM customer WHERE c_nationkey NOT IN (1, 2, 3) AND c_nationkey <= 10""")
def timeline_tables(t: Tables):
    """Nested lists of terms to rows."""
    return CAL.timelines(nested_terms(t))


@query("timeline_violations", """
SELECT problem, count(*) AS n FROM (SELECT CASE WHEN c_nationkey = 1 THEN 'name missing' WHEN c_nationkey = 2 THEN 'start missing' WHEN c_nationkey = 3 THEN 'start not ISO' WHEN c_nationkey > 10 THEN 'end not ISO' END AS problem FROM customer)
WHERE problem IS NOT NULL GROUP BY 1""")
def timeline_violations(t: Tables):
    """Entries that break a rule, by rule."""
    return CAL.timeline_violations(nested_terms(t)).groupBy("problem").agg(F.count("*").alias("n"))


# -- provenance ------------------------------------------------------------------------------


LINKED = [
    (1, "historical_population"), (2, "family"), (3, "migration"), (4, "cog_ensemble"), (5, "births"), (6, "deaths"), (7, "bpe"), (8, "salaries"), (9, "french_communes"),
    (10, "zip_codes"), (11, "dim_equipment"), (12, "criminality"), (20, "famille_plus"), (21, "ville_sportive"), (22, "petites_cites"), (30, "other"),
]


@query("bridge_source_links", """
WITH e AS (SELECT equipment_code, row_number() OVER (ORDER BY equipment_code) AS type FROM equipment),
z AS (SELECT DISTINCT CAST(Code_postal AS INTEGER) AS id, CASE WHEN Code_postal LIKE '75___' THEN '75056' WHEN CAST(Code_postal AS INTEGER) BETWEEN 13000 AND 13020 THEN '13055' WHEN CAST(Code_postal AS INTEGER) BETWEEN 69001 AND 69010 THEN '69123' ELSE code_insee END AS commune_id FROM zip_codes),
nb AS (SELECT a.commune_id AS p, b.commune_id AS q FROM o_geography a JOIN o_geography b ON abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 AND a.commune_id <> b.commune_id
 JOIN o_communes c ON c.id = a.commune_id JOIN o_communes d ON d.id = b.commune_id
 WHERE c.flag_corsica = d.flag_corsica AND c.flag_metropole = d.flag_metropole AND (c.flag_metropole = 0 OR c.department_code = d.department_code)),
l(target_table, target_key, source_id) AS (
 SELECT 'fact_population', id || '|' || year, unnest([1, 2, 3, 5, 6]) FROM o_population
 UNION SELECT 'fact_salaries', id || '|' || year, 8 FROM o_salaries
 UNION SELECT 'fact_equipment', c.id || '|' || CAST(TIME_PERIOD AS INTEGER) || '|' || e.type, 7 FROM bpe LEFT JOIN o_communes c ON c.id = GEO LEFT JOIN e ON equipment_code = FACILITY_TYPE WHERE GEO_OBJECT = 'COM' AND FACILITY_TYPE <> '_T'
 UNION SELECT 'dim_communes', id, 4 FROM o_communes
 UNION SELECT 'dim_geography', commune_id, 9 FROM o_geography
 UNION SELECT 'dim_zip_codes', CAST(id AS VARCHAR), 10 FROM z
 UNION SELECT 'dim_equipment', CAST(type AS VARCHAR), 11 FROM e
 UNION SELECT 'dim_labels', c_name || '|' || c_nationkey || '|' || k, CASE k WHEN 'famille_plus' THEN 20 WHEN 'ville_sportive' THEN 21 ELSE 22 END FROM customer, (VALUES ('famille_plus'), ('ville_sportive'), ('petites_cites')) v(k)
  WHERE k = 'famille_plus' OR (k = 'ville_sportive' AND c_nationkey > 12) OR (k = 'petites_cites' AND c_nationkey < 3)
 UNION SELECT 'bridge_communes_zip_codes', commune_id || '|' || z.id, 10 FROM z WHERE commune_id IN (SELECT id FROM o_communes)
 UNION SELECT 'dim_neighbour_communes', p || '|' || q, 9 FROM nb
 UNION SELECT 'dim_criminality_indicateur', CAST(CAST(indicateur_id AS INTEGER) AS VARCHAR), 12 FROM indicators
 UNION SELECT 'fact_criminality', commune_id || '|' || annee || '|' || indicateur_id, 12 FROM o_crime)
SELECT row_number() OVER (ORDER BY target_table, target_key NULLS FIRST, source_id) AS source_link_id, target_table, target_key, CAST(source_id AS INTEGER) AS source_id FROM l""",
       ("o_population", "o_salaries", "o_communes", "o_geography", "bpe", "equipment", "zip_codes", "indicators", "o_crime"))
def bridge_source_links(t: Tables):
    """Source links of all twelve linked tables; labels are linked by their type."""
    sources = t.spark.createDataFrame(LINKED, "source_id int, source_name string")
    named = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("department"), "c_nationkey")
    labels = PR.dim_labels({
        "famille_plus": named, "ville_sportive": named.filter("c_nationkey > 12"), "petites_cites": named.filter("c_nationkey < 3"), "unlisted": named,
    })
    # Links are made of stored tables; here those that take long to build are stored by their keys.
    towns = stored_communes(t)
    keys = lambda name, df: pin(df.select(*PR.TABLE_SOURCES[name][0]))
    tables = {
        "fact_population": keys("fact_population", population(t)), "fact_salaries": salaries(t),
        "fact_equipment": keys("fact_equipment", E.fact_equipment(t.bpe, towns, equipment(t), F.lit(7))),
        "dim_communes": towns, "dim_geography": shapes(t).select(F.col("code").alias("commune_id")),
        "dim_zip_codes": T.dim_zip_codes(zip_codes(t)), "dim_equipment": equipment(t), "dim_labels": labels,
        "bridge_communes_zip_codes": T.bridge_communes_zip_codes(zip_codes(t), towns),
        "dim_neighbour_communes": keys("dim_neighbour_communes", T.dim_neighbour_communes(shapes(t).withColumnRenamed("code", "commune_id"), towns)),
        "dim_criminality_indicateur": indicators(t),
        "fact_criminality": keys("fact_criminality", E.fact_criminality(t.criminality, indicators(t))),
    }
    return PR.bridge_source_links(tables, sources)


@query("dim_source", """
SELECT CAST(s_suppkey AS INTEGER) AS source_id, s_name AS source_name, 'Label ' || s_name AS source_label, 'org' || s_nationkey AS organization, 'd' AS domain, CAST(NULL AS VARCHAR) AS reference_url, 'open' AS license, CAST(NULL AS VARCHAR) AS description FROM supplier""")
def dim_source(t: Tables):
    """The typed source table."""
    raw = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("source_id"), F.col("s_name").alias("source_name"), F.concat(F.lit("Label "), "s_name").alias("source_label"),
        F.concat(F.lit("org"), F.col("s_nationkey").cast("string")).alias("organization"), F.lit("d").alias("domain"), F.lit(None).alias("reference_url"),
        F.lit("open").alias("license"), F.lit(None).alias("description"),
    )
    return PR.dim_source(raw)


@query("dim_labels", """
SELECT c_name || '|' || c_nationkey AS id, c_name AS label_name, 'village_etape' AS label_type FROM customer WHERE c_acctbal > 0
UNION ALL SELECT s_name || '|' || s_nationkey, s_name, 'petites_cites' FROM supplier""")
def dim_labels(t: Tables):
    """Label awards stacked from the extracted lists."""
    villages = t.customer.filter("c_acctbal > 0").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("department"))
    towns = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("department"))
    return PR.dim_labels({"village_etape": villages, "petites_cites": towns})


# -- reports ---------------------------------------------------------------------------------

CHECK_PARTS["o_report"] = """
WITH p AS (SELECT id, arg_max(population, year) AS population, max(year) AS py, arg_max(struct_pack(g := year_evolution_percent), year).g AS growth FROM {o_population} WHERE population IS NOT NULL GROUP BY id),
s AS (SELECT id, arg_max(mean_salary, year) AS mean_salary, max(year) AS sy FROM {o_salaries} WHERE mean_salary IS NOT NULL GROUP BY id),
c AS (SELECT c.id, name, department_code, department_name, population, py, growth, mean_salary, sy FROM {o_communes} c LEFT JOIN p USING (id) LEFT JOIN s USING (id)),
d AS (SELECT department_code, sum(population)::DOUBLE / nullif(count(population), 0) AS dp, sum(mean_salary)::DOUBLE / nullif(count(mean_salary), 0) AS ds FROM c GROUP BY 1)
SELECT id, name, department_code, department_name, population, py AS latest_population_year, growth AS population_growth_pct, dp AS dept_avg_population, population / nullif(dp, 0) AS population_ratio,
 mean_salary, sy AS latest_salary_year, ds AS dept_avg_salary, mean_salary / nullif(ds, 0) AS salary_ratio FROM c JOIN d USING (department_code)"""


def report(t: Tables):
    return R.department_report(communes(t), population(t), salaries(t))


@query("department_report", "SELECT * FROM o_report", ("o_report",))
def department_report(t: Tables):
    """Every commune's latest figures against its department, all departments at once."""
    return report(t)


@query("departments", "SELECT DISTINCT department_code, department_name FROM o_communes", ("o_communes",))
def departments(t: Tables):
    """The departments."""
    return R.departments(communes(t))


@query("city_series", "SELECT year, population, year_evolution FROM o_population WHERE id = '00001' ORDER BY year DESC", ("o_population",))
def city_series(t: Tables):
    """The history of one commune, newest first."""
    return R.city_series(population(t), "00001", ["population", "year_evolution"], newest_first=True)


@query("report_texts", """
SELECT id, name, department_code, format('{:,}', population) AS population, CASE WHEN population_growth_pct IS NULL THEN '—' WHEN population_growth_pct > 0 THEN '▲ ' || printf('%+.1f', population_growth_pct) || '%'
  WHEN population_growth_pct < 0 THEN '▼ ' || printf('%+.1f', population_growth_pct) || '%' ELSE '▬ ' || printf('%+.1f', population_growth_pct) || '%' END AS population_growth,
 format('{:,}', mean_salary) AS mean_salary, CASE WHEN population_ratio IS NULL THEN '—' ELSE printf('%.1f', population_ratio) END AS population_ratio,
 CASE WHEN salary_ratio IS NULL THEN '—' ELSE printf('%.1f', salary_ratio) END AS salary_ratio FROM o_report""", ("o_report",))
def report_texts(t: Tables):
    """The report as formatted texts."""
    return R.report_text(report(t))


@query("report_comparison", """
SELECT id, department_code, 'Population' AS metric, population::DOUBLE AS city_value, dept_avg_population AS dept_value, coalesce(population_ratio, population / dept_avg_population) AS ratio,
 -dept_avg_population / greatest(population, dept_avg_population) * 100 AS dept_pct, population / greatest(population::DOUBLE, dept_avg_population) * 100 AS city_pct FROM o_report WHERE population IS NOT NULL AND dept_avg_population IS NOT NULL
UNION ALL SELECT id, department_code, 'Mean Salary (€)', mean_salary::DOUBLE, dept_avg_salary, coalesce(salary_ratio, mean_salary / dept_avg_salary), -dept_avg_salary / greatest(mean_salary, dept_avg_salary) * 100,
 mean_salary / greatest(mean_salary::DOUBLE, dept_avg_salary) * 100 FROM o_report WHERE mean_salary IS NOT NULL AND dept_avg_salary IS NOT NULL""", ("o_report",))
def report_comparison(t: Tables):
    """City against department, scaled to the larger value."""
    return R.comparison(report(t))


CHECK_PARTS["o_panel"] = """
SELECT department_code, department_name, year, CAST(sum(population) AS BIGINT) AS total_population FROM {o_communes} JOIN {o_population} USING (id) GROUP BY 1, 2, 3"""


def panel(t: Tables):
    return R.department_panel(communes(t), population(t).select("id", "year", "population"))


@query("department_panel", "SELECT * FROM o_panel", ("o_panel",))
def department_panel(t: Tables):
    """Population per department and year."""
    return panel(t)


@query("panel_kpis", """
WITH l AS (SELECT * FROM o_panel WHERE year = (SELECT max(year) FROM o_panel WHERE total_population IS NOT NULL))
SELECT CAST(sum(total_population) AS BIGINT) AS total, CAST(floor(avg(total_population)) AS BIGINT) AS average, CAST(floor(median(total_population)) AS BIGINT) AS median,
 arg_max(department_name, (total_population, department_code)) AS most_populous, max(total_population) AS most_population, arg_min(department_name, (total_population, department_code)) AS least_populous, min(total_population) AS least_population FROM l""", ("o_panel",))
def panel_kpis(t: Tables):
    """Key figures of the newest year."""
    return R.panel_kpis(panel(t))


@query("panel_extremes", """
WITH l AS (SELECT * FROM o_panel WHERE year = (SELECT max(year) FROM o_panel WHERE total_population IS NOT NULL))
SELECT * FROM (SELECT 'top' AS side, * FROM l ORDER BY total_population DESC, department_code LIMIT 10) UNION ALL SELECT * FROM (SELECT 'bottom', * FROM l ORDER BY total_population, department_code LIMIT 10)""", ("o_panel",))
def panel_extremes(t: Tables):
    """The ten largest and smallest departments of the newest year."""
    rows = t.stored("panel", lambda: panel(t))
    first = R.panel_extremes(rows, 10).select(F.lit("top").alias("side"), "*")
    return first.unionByName(R.panel_extremes(rows, 10, largest=False).select(F.lit("bottom").alias("side"), "*"))


@query("panel_of_largest", """
SELECT * FROM o_panel WHERE department_code IN (SELECT department_code FROM o_panel WHERE year = (SELECT max(year) FROM o_panel WHERE total_population IS NOT NULL) ORDER BY total_population DESC, department_code LIMIT 5)""", ("o_panel",))
def panel_of_largest(t: Tables):
    """Full series of the five departments largest in the newest year."""
    return R.panel_of_largest(panel(t), 5).select("department_code", "department_name", "year", "total_population")


@query("most_populous", """
SELECT id, name, department_name, population FROM o_communes JOIN o_population USING (id) WHERE year = 1998 ORDER BY population DESC NULLS LAST, id LIMIT 10""", ("o_communes", "o_population"))
def most_populous(t: Tables):
    """The ten most populous communes of a year."""
    return R.most_populous(communes(t), population(t), 1998)


@query("pay_gap_by_region", """
SELECT region_name, year, sum(mean_salary_men)::DOUBLE / nullif(count(mean_salary_men), 0) AS avg_men, sum(mean_salary_women)::DOUBLE / nullif(count(mean_salary_women), 0) AS avg_women,
 (avg_men - avg_women) / nullif(avg_men, 0) * 100 AS gap_pct FROM o_communes JOIN o_salaries USING (id) GROUP BY 1, 2""", ("o_communes", "o_salaries"))
def pay_gap_by_region(t: Tables):
    """Pay of men and women per region and year."""
    return R.pay_gap_by_region(communes(t), salaries(t))


@query("commune_points", """
SELECT id, c.name, c.department_code, c.department_name, round(cx, 6) AS longitude, round(cy, 6) AS latitude, false AS visited, CAST(NULL AS DATE) AS visit_date, CAST(NULL AS VARCHAR) AS photo FROM o_communes c JOIN o_geography ON commune_id = id""", ("o_communes", "o_geography"))
def commune_points(t: Tables):
    """One point per commune with columns to fill in."""
    return R.commune_points(stored_communes(t), geography(t, stored_communes(t))).withColumns({"longitude": F.round("longitude", 6), "latitude": F.round("latitude", 6)})


@query("monument_points", """
SELECT reference, m.name, protection_level, longitude, latitude, c.name AS commune_name, c.department_code FROM o_monuments m JOIN
 (SELECT monument_reference, min(commune_code) AS code FROM o_bridge WHERE commune_exists AND (is_primary OR monument_reference NOT IN (SELECT monument_reference FROM o_bridge WHERE is_primary AND commune_exists)) GROUP BY 1) b ON reference = monument_reference JOIN o_communes c ON c.id = code""", ("o_monuments", "o_bridge", "o_communes"))
def monument_points(t: Tables):
    """One point per monument with its primary commune that exists."""
    points = R.monument_points(monuments(t), bridge(t), stored_communes(t))
    return points.select("reference", "name", "protection_level", "longitude", "latitude", "commune_name", "department_code")


# -- visits ----------------------------------------------------------------------------------

CHECK_PARTS["o_master"] = f"""
SELECT c.id, CASE WHEN g.department_code NOT IN ('2A', '2B') THEN {AREA_SQL} END AS area_km2, c.name, c.department_code, c.department_name, c.region_name, c.territory_type, cx AS longitude, cy AS latitude, is_mountain, is_island_commune, population, v.id IS NOT NULL AS visited, visit_date, photo,
 'https://t/' || replace(photo, 'DCIM/', '') AS photo_thumbnail_url FROM {{o_communes}} c JOIN {{o_geography}} g ON g.commune_id = c.id LEFT JOIN (SELECT * FROM {{o_population}} WHERE year = 1999) p ON p.id = c.id LEFT JOIN {{visits}} v ON v.id = c.id"""


def master(t: Tables):
    visited = t.visits.withColumn("visited", F.lit(True))
    return V.visited_master(stored_communes(t), geography(t, stored_communes(t)), population(t), visited, 1999, "https://t")


@query("visited_master", "SELECT id, department_code, population, CASE WHEN visited THEN true END AS visited, visit_date, photo_thumbnail_url FROM o_master", ("o_master",))
def visited_master(t: Tables):
    """Every commune with its visit, if any."""
    return master(t).select("id", "department_code", "population", "visited", "visit_date", "photo_thumbnail_url")


@query("visited_departments", """
SELECT department_code, department_name, region_name, count(*) FILTER (WHERE visited) AS n_done, count(*) AS n_total, round_even(count(*) FILTER (WHERE visited)::DOUBLE / count(*) * 100, 1) AS pct_done, bool_and(visited) AS is_complete
FROM o_master GROUP BY 1, 2, 3 HAVING bool_or(visited)""", ("o_master",))
def visited_departments(t: Tables):
    """Visited share of each department."""
    return V.department_completeness(master(t))


CHECK_PARTS["o_visit_kpis"] = """
SELECT count(*) AS n_total, count(*) FILTER (WHERE visited) AS n_visited, CAST(printf('%.2f', count(*) FILTER (WHERE visited)::DOUBLE / count(*) * 100) AS DOUBLE) AS pct_visited, CAST(sum(population) FILTER (WHERE visited) AS BIGINT) AS population_visited,
 count(DISTINCT department_code) FILTER (WHERE visited) AS n_departments, count(DISTINCT region_name) FILTER (WHERE visited) AS n_regions,
 (SELECT count(*) FROM (SELECT 1 FROM {o_master} GROUP BY department_code HAVING bool_and(visited))) AS departments_completed, (SELECT count(*) FROM (SELECT region_name FROM (SELECT region_name, bool_and(visited) AS all_in FROM {o_master} GROUP BY region_name) WHERE all_in)) AS regions_completed,
 count(*) FILTER (WHERE visited AND is_mountain) AS mountain_visited, count(*) FILTER (WHERE visited AND is_island_commune) AS island_visited, count(*) FILTER (WHERE visited AND territory_type = 'COM') AS overseas_visited, count(*) FILTER (WHERE visited AND id = '75056') AS paris_visited,
 CAST(round(sum(round(area_km2, 6)) FILTER (WHERE visited)) AS DOUBLE) AS area_visited FROM {o_master}"""


@query("visit_kpis", "SELECT * FROM o_visit_kpis", ("o_visit_kpis",))
def visit_kpis(t: Tables):
    """Key figures of the visits in one row."""
    return V.visit_kpis(master(t))


@query("visit_badges", """
SELECT label, value, minimum FROM o_visit_kpis, LATERAL (SELECT * FROM (VALUES {}) v(label, value, minimum)) WHERE value >= minimum""".format(
    ", ".join(f"('{label}', {metric}::DOUBLE, {float(limit)}::DOUBLE)" for label, metric, limit in W.BADGES)
), ("o_visit_kpis",))
def visit_badges(t: Tables):
    """Badges earned."""
    return V.visit_badges(master(t))


@query("referenced_photos", "SELECT DISTINCT photo FROM o_master WHERE photo IS NOT NULL", ("o_master",))
def referenced_photos(t: Tables):
    """Photos that visits refer to."""
    return V.referenced_photos(master(t))


@query("visit_map_points", """
SELECT id, CAST(printf('%.5f', latitude) AS DOUBLE) AS latitude, CAST(printf('%.5f', longitude) AS DOUBLE) AS longitude, name, coalesce(population, 0) AS population, visited FROM o_master""", ("o_master",))
def visit_map_points(t: Tables):
    """Map dots with rounded positions and default population."""
    return V.map_points(master(t))


CHECK_PARTS["o_timed"] = """
WITH b AS (SELECT c.id AS commune_id, c.department_code, c.department_name, c.region_name, c.flag_metropole, coalesce(is_mountain, false) AS m, coalesce(is_coast, false) AS s, is_mountain, is_coast, is_insular, is_island_commune,
  coalesce(total_monuments, 0) AS n, population FROM {o_communes} c LEFT JOIN {o_geography} g ON g.commune_id = c.id LEFT JOIN {o_stats} st ON st.commune_id = c.id LEFT JOIN (SELECT id, population FROM {o_population} WHERE year = 1999) p ON p.id = c.id),
v AS (SELECT *, least(480, CAST(trunc(((CASE WHEN population IS NULL OR population < 500 THEN 10 WHEN population < 2000 THEN 20 WHEN population < 10000 THEN 45 WHEN population < 50000 THEN 120 WHEN population < 100000 THEN 240 ELSE 480 END
  + least(60, CASE WHEN n > 5 THEN n - 2 ELSE 0 END))::DOUBLE * CASE WHEN m THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END * CASE WHEN s THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END * CASE WHEN is_island_commune THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END)
  + CASE WHEN commune_id IN ('17004', '56088', '29082', '22016', '56069', '56085', '56086', '56087', '29084', '29155', '29083', '85113') THEN 300 WHEN commune_id IN ('56009', '56114', '56152', '56241') THEN 75 ELSE 0 END) AS BIGINT)) AS visit_minutes FROM b)
SELECT v.*, round_even(visit_minutes::DOUBLE / 60, 2) AS visit_hours, CASE WHEN department_code IN ('2A', '2B') THEN 1 WHEN department_code IN ('971', '972', '973', '974', '976') THEN 4 ELSE 0 END AS overseas_travel_days,
 CASE WHEN department_code IN ('2A', '2B') THEN 'Corse' WHEN department_code IN ('971', '972') THEN 'Antilles' WHEN department_code = '973' THEN 'Guyane' WHEN department_code IN ('974', '976') THEN 'Océan Indien' ELSE '' END AS overseas_group FROM v"""


def timed(t: Tables):
    stats = M.dim_commune_monument_stats(stored_communes(t), bridge(t), M.monument_traits(monument_source(t)))
    base = V.visit_base(stored_communes(t), geography(t, stored_communes(t)), stats, population(t), 1999)
    return V.with_overseas(V.visit_minutes(base))


@query("visit_times", "SELECT commune_id, n AS total_monuments, visit_minutes, visit_hours, CAST(overseas_travel_days AS INTEGER) AS overseas_travel_days, overseas_group FROM o_timed", ("o_timed",))
def visit_times(t: Tables):
    """Visit minutes per commune and the overseas trip it belongs to."""
    return timed(t).select("commune_id", "total_monuments", "visit_minutes", "visit_hours", "overseas_travel_days", "overseas_group")


CHECK_PARTS["o_dept"] = """
WITH g AS (SELECT department_code, min(department_name) AS department_name, min(region_name) AS region_name, min(flag_metropole) AS flag_metropole, count(*) AS n_towns, CAST(sum(CAST(visit_hours AS DECIMAL(18,2))) AS DOUBLE) AS total_visit_hours,
  CAST(max(overseas_travel_days) AS INTEGER) AS overseas_travel_days FROM {o_timed} GROUP BY 1),
h AS (SELECT *, round_even((n_towns - 1) * CASE WHEN department_code IN ('13') THEN 8 ELSE 15 END / 60, 1) AS intra_travel_hours FROM g)
SELECT *, round_even(total_visit_hours + intra_travel_hours, 1) AS total_hours, round_even((total_visit_hours + intra_travel_hours) / 10, 1) AS total_days FROM h"""


@query("visit_departments", "SELECT * FROM o_dept", ("o_dept",))
def visit_departments(t: Tables):
    """Visit and travel time per department."""
    return V.department_summary(timed(t))


@query("visit_regions", """
SELECT region_name, CAST(sum(n_towns) AS BIGINT) AS n_towns, CAST(printf('%.0f', CAST(sum(CAST(total_visit_hours AS DECIMAL(18,2))) AS DOUBLE)) AS DOUBLE) AS visit_hours,
 CAST(printf('%.0f', CAST(sum(CAST(intra_travel_hours AS DECIMAL(18,1))) AS DOUBLE) + greatest(count(*) - 1, 0) * 1.5::DOUBLE) AS DOUBLE) AS travel_hours,
 CAST(printf('%.1f', (CAST(sum(CAST(total_visit_hours AS DECIMAL(18,2))) AS DOUBLE) + (CAST(sum(CAST(intra_travel_hours AS DECIMAL(18,1))) AS DOUBLE) + greatest(count(*) - 1, 0) * 1.5::DOUBLE)) / 10) AS DOUBLE) AS total_days FROM o_dept GROUP BY 1""", ("o_dept",))
def visit_regions(t: Tables):
    """Visit and travel time per region with transfers between departments."""
    return V.region_summary(V.department_summary(timed(t)))


@query("visit_overseas", """
SELECT overseas_group, count(*) AS n_towns, CAST(sum(CAST(visit_hours AS DECIMAL(18,2))) AS DOUBLE) AS total_visit_hours, CAST(max(overseas_travel_days) AS INTEGER) AS travel_days,
 round_even(CAST(sum(CAST(visit_hours AS DECIMAL(18,2))) AS DOUBLE) / 10 + max(overseas_travel_days), 1) AS total_days FROM o_timed WHERE flag_metropole = 0 AND overseas_group <> '' GROUP BY 1""", ("o_timed",))
def visit_overseas(t: Tables):
    """Overseas trips."""
    return V.overseas_summary(timed(t))


@query("visit_grand_total", """
WITH r AS (SELECT region_name, count(*) AS n, sum(CAST(CASE WHEN flag_metropole = 1 THEN total_hours END AS DECIMAL(18,1))) AS main, sum(CAST(CASE WHEN flag_metropole = 0 THEN total_hours END AS DECIMAL(18,1))) AS away FROM o_dept GROUP BY 1),
q AS (SELECT (CAST(sum(main) AS DOUBLE) + CAST(sum(greatest(n - 1, 0) * 1.5) AS DOUBLE)) / 10 AS mainland_days, CAST(sum(away) AS DOUBLE) / 10 AS overseas_days FROM r)
SELECT round(mainland_days, 6) AS mainland_days, round(overseas_days, 6) AS overseas_days, CAST(29 AS INTEGER) AS travel_days, round(mainland_days + overseas_days + 29, 6) AS grand_total_days FROM q""", ("o_dept",))
def visit_grand_total(t: Tables):
    """Days for the whole tour."""
    days = V.grand_total(V.department_summary(timed(t)))
    return days.withColumns({c: F.round(c, 6) for c in ("mainland_days", "overseas_days", "grand_total_days")})


@query("visit_tour_kpis", """
SELECT count(*) AS n_towns, CAST(sum(n) AS BIGINT) AS n_monuments, count(*) FILTER (WHERE is_mountain) AS n_mountain, count(*) FILTER (WHERE is_coast) AS n_coast, count(*) FILTER (WHERE is_insular) AS n_insular,
 count(*) FILTER (WHERE is_island_commune) AS n_island_commune, count(DISTINCT overseas_group) AS n_overseas_groups, count(*) FILTER (WHERE visit_minutes >= 480) AS n_full_day FROM o_timed""", ("o_timed",))
def visit_tour_kpis(t: Tables):
    """Head counts of the tour."""
    return V.tour_kpis(timed(t))


@query("most_monuments", """
SELECT commune_id, total_monuments FROM o_stats ORDER BY total_monuments DESC, commune_id LIMIT 10""", ("o_stats",))
def most_monuments(t: Tables):
    """The communes richest in monuments."""
    stats = M.dim_commune_monument_stats(stored_communes(t), bridge(t), monuments(t))
    return top(stats.select("commune_id", "total_monuments"), 10, F.col("total_monuments").desc(), F.col("commune_id").asc())


# -- names -----------------------------------------------------------------------------------
# Town names: part names joined with hyphens, a third of them saints.

NAMES = """
SELECT p_type AS department_name, CASE WHEN p_size <= 15 THEN 'Saint-' || upper(left(p_name, 1)) || replace(substr(p_name, 2), ' ', '-') WHEN p_size <= 20 THEN 'Bourg sur ' || p_name WHEN p_size <= 25 THEN replace(p_name, ' ', '-la-')
  ELSE upper(left(p_name, 1)) || substr(p_name, 2) || CASE WHEN p_size > 45 THEN ' l''' || p_brand ELSE '' END END AS name FROM {part}"""
derived.DERIVED["town_names"] = NAMES


@query("name_lengths", """
SELECT 'chars' AS kind, CAST(length(name) AS INTEGER) AS size, count(*) AS n FROM town_names GROUP BY 2 UNION ALL
SELECT 'letters', CAST(length(regexp_replace(name, '[^a-zA-Z]', '', 'g')) AS INTEGER), count(*) FROM town_names GROUP BY 2""", ("town_names",))
def name_lengths(t: Tables):
    """Distribution of name lengths in characters and in letters."""
    chars = N.length_distribution(t.town_names).select(F.lit("chars").alias("kind"), F.col("name_length").alias("size"), "n")
    return chars.unionByName(N.letter_distribution(t.town_names).select(F.lit("letters").alias("kind"), F.col("letters").alias("size"), "n"))


@query("name_length_stats", """
SELECT CAST(min(length(name)) AS INTEGER) AS min_len, round(sum(length(name))::DOUBLE / count(*), 1) AS avg_len, CAST(round_even(median(length(name)), 0) AS INTEGER) AS med_len, CAST(max(length(name)) AS INTEGER) AS max_len FROM town_names""", ("town_names",))
def name_length_stats(t: Tables):
    """Shortest, mean, median and longest name."""
    return N.length_stats(t.town_names)


@query("extreme_names", """
SELECT * FROM (SELECT 'long' AS side, name, CAST(length(name) AS INTEGER) AS len FROM town_names ORDER BY 3 DESC, 2 LIMIT 5) UNION ALL SELECT * FROM (SELECT 'short', name, CAST(length(name) AS INTEGER) AS len FROM town_names ORDER BY 3, 2 LIMIT 5)""", ("town_names",))
def extreme_names(t: Tables):
    """The longest and the shortest names."""
    side = lambda name, flag: N.extreme_names(t.town_names, 5, flag).select(F.lit(name).alias("side"), "*")
    return side("long", True).unionByName(side("short", False))


@query("name_length_bins", """
SELECT CASE WHEN length(name) <= 8 THEN '1-8' WHEN length(name) <= 12 THEN '9-12' WHEN length(name) <= 20 THEN '13-20' ELSE '21+' END AS bin, count(*) AS n FROM town_names GROUP BY 1""", ("town_names",))
def name_length_bins(t: Tables):
    """Names per right-closed length bin."""
    return N.length_bins(t.town_names, [8, 12, 20])


@query("repeated_names", "SELECT name, count(*) AS n FROM town_names GROUP BY 1 HAVING count(*) >= 2", ("town_names",))
def repeated_names(t: Tables):
    """Names borne by several towns."""
    return N.repeated_names(t.town_names)


@query("common_name_words", """
SELECT word, count(*) AS n FROM (SELECT upper(left(w, 1)) || lower(substr(w, 2)) AS word FROM (SELECT unnest(string_split(replace(replace(name, '-', ' '), '''', ' '), ' ')) AS w FROM town_names) WHERE length(w) > 1 AND lower(w) NOT IN ('la', 'sur'))
GROUP BY 1 ORDER BY n DESC, word LIMIT 15""", ("town_names",))
def common_name_words(t: Tables):
    """The most common words of names."""
    return N.common_words(t.town_names)


@query("patron_saints", """
SELECT saint_name, count(*) AS n FROM (SELECT regexp_extract(name, '^Saint[- ](.+?)(?:$|[- ])', 1) AS saint_name FROM town_names WHERE name LIKE 'Saint-%' OR name LIKE 'Saint %') GROUP BY 1 ORDER BY n DESC, saint_name LIMIT 10""", ("town_names",))
def patron_saints(t: Tables):
    """The most common saints."""
    return N.patron_saints(t.town_names)


@query("name_qualifiers", " UNION ALL ".join(
    f"SELECT '{w}' AS qualifier, '{m}' AS meaning, count(*) FILTER (WHERE name LIKE '%-{w}-%' OR name LIKE '% {w} %') AS n FROM town_names" for w, m in W.NAME_QUALIFIERS.items()
), ("town_names",))
def name_qualifiers(t: Tables):
    """Names with each geographic qualifier."""
    return N.qualifiers(t.town_names)


@query("name_first_letters", """
SELECT upper(left(name, 1)) AS letter, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS percentage FROM town_names GROUP BY 1""", ("town_names",))
def name_first_letters(t: Tables):
    """First letters with their share."""
    return N.first_letters(t.town_names)


@query("name_missing_letters", """
SELECT chr(i) AS letter FROM (SELECT CAST(unnest(generate_series(65, 90)) AS INTEGER) AS i) WHERE chr(i) NOT IN (SELECT upper(left(name, 1)) FROM town_names)""", ("town_names",))
def name_missing_letters(t: Tables):
    """Letters no name starts with."""
    return N.missing_letters(t.town_names)


@query("name_lengths_by_department", """
SELECT department_name, count(*) AS n, CAST(min(length(name)) AS INTEGER) AS min_value, round(sum(length(name))::DOUBLE / count(*), 1) AS avg_value, median(length(name)) AS median_value, CAST(max(length(name)) AS INTEGER) AS max_value,
 round(stddev_samp(length(name)), 1) AS stddev_value FROM town_names GROUP BY 1""", ("town_names",))
def name_lengths_by_department(t: Tables):
    """Name lengths per department."""
    return N.group_lengths(t.town_names, "department_name")


@query("lengths_in_top_departments", """
SELECT department_name, CAST(length(name) AS INTEGER) AS len FROM town_names WHERE department_name IN (SELECT department_name FROM town_names GROUP BY 1 ORDER BY round(sum(length(name))::DOUBLE / count(*), 1) DESC, 1 LIMIT 3)""", ("town_names",))
def lengths_in_top_departments(t: Tables):
    """All name lengths of the departments with the longest mean name."""
    return N.lengths_in_top_groups(t.town_names, "department_name", 3)
