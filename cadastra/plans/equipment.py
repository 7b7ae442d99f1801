"""Equipment and crime statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import crosswalk, enforce, ratio, round_sql, year_key
from cadastra.operators.aggregates import pivot_when
from cadastra.operators.skew import skew_join
from cadastra.operators.windows import surrogate_id
from cadastra.plans.constants import CITY_CODES

EQUIPMENT = [
    "equipment_code", "equipment_name", "subdomain_code", "subdomain_name", "domain_code", "domain_name",
]


def dim_equipment(equipment: DataFrame) -> DataFrame:
    """Equipment types numbered by code."""
    return surrogate_id(equipment.select(*EQUIPMENT), ["equipment_code"], "equipment_type_id")


def fact_equipment(
    observed: DataFrame, communes: DataFrame, equipment: DataFrame, source_id: Column
) -> DataFrame:
    """Equipment counts per commune, year and type. Unknown communes and types stay as NULL keys.
    ``source_id`` is looked up, not fixed."""
    base = (
        observed.filter((F.col("GEO_OBJECT") == "COM") & (F.col("FACILITY_TYPE") != "_T"))
        .groupBy("GEO", F.col("TIME_PERIOD").cast("int").alias("year"), "FACILITY_TYPE")
        .agg(F.sum(F.round(F.col("OBS_VALUE").cast("decimal(38,6)"), 0).cast("int")).alias("count"))
    )
    towns = communes.select(F.col("id").alias("GEO"), F.col("id").alias("commune_id"))
    types = equipment.select(F.col("equipment_code").alias("FACILITY_TYPE"), "equipment_type_id")
    typed = skew_join(
        base, types, ["FACILITY_TYPE"], "left", spread=["GEO", "year"], sketch=observed
    )
    return typed.join(towns, "GEO", "left").select(
        "commune_id", "year", year_key(F.col("year")).alias("date_id"), "equipment_type_id",
        source_id.cast("int").alias("source_id"), "count",
    )


def dim_criminality_indicateur(indicators: DataFrame) -> DataFrame:
    names = ["name_fr", "name_en", "unite_de_compte_fr", "unite_de_compte_en"]
    return enforce(
        indicators, [("indicateur_id", "indicateur_id", "int"), *[(n, n, "string") for n in names]]
    )


def fact_criminality(recorded: DataFrame, indicators: DataFrame) -> DataFrame:
    """Offences per commune, year and indicator; districts are summed into their city and rates
    recomputed from the sums. Unknown indicators drop out (a relationship rule reports them)."""
    raw = enforce(
        recorded,
        [
            ("CODGEO_2025", "code", "string"), ("annee", "annee", "int"),
            ("indicateur", "indicateur", "string"), ("nombre", "nombre", "int"),
            ("est_diffuse", "est_diffuse", "string"),
            ("complement_info_nombre", "complement_info_nombre", "double"),
            ("insee_pop", "insee_pop", "int"), ("insee_log", "insee_log", "int"),
        ],
    )
    extra = F.col("complement_info_nombre").cast("decimal(28,6)")
    summed = raw.groupBy(
        crosswalk(F.col("code"), CITY_CODES).alias("commune_id"), "annee", "indicateur"
    ).agg(
        F.sum("nombre").alias("nombre"),
        F.coalesce(F.bool_or(F.col("est_diffuse") == "diff"), F.lit(False)).alias("_diffused"),
        F.sum(extra).cast("double").alias("complement_info_nombre"),
        F.sum("insee_pop").alias("insee_pop"),
        F.sum("insee_log").alias("insee_log"),
    )
    known = indicators.select("indicateur_id", F.col("name_fr").alias("indicateur"))
    per_thousand = lambda c: round_sql(ratio(F.col(c) * F.lit(1000.0), F.col("insee_pop")), 2)
    named = skew_join(
        summed, known, ["indicateur"], "inner", spread=["commune_id", "annee"], sketch=raw
    )
    return named.select(
        "commune_id", "annee", "indicateur_id", "nombre",
        per_thousand("nombre").alias("taux_pour_mille"),
        F.when(F.col("_diffused"), "diff").otherwise("ndiff").alias("est_diffuse"),
        "complement_info_nombre",
        per_thousand("complement_info_nombre").alias("complement_info_taux"),
        "insee_pop", "insee_log",
    )


def criminality_wide(facts: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """One column per indicator of ``names`` (indicator id to column name)."""
    cells = {name: (F.col("indicateur_id") == number, F.col("nombre")) for number, name in names.items()}
    return pivot_when(facts, ["commune_id", "annee"], cells)
