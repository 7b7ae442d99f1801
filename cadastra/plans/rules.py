"""Quality rules of the published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from cadastra.operators import quality as Q
from cadastra.operators.quality import Rule
from cadastra.plans import constants as K

BINARY = [0, 1]


def _required(*columns: str, severity: str = "error") -> list[Rule]:
    return [Q.not_null(c, severity) for c in columns]


def _ranges(severity: str, **bounds: tuple[float | None, float | None]) -> list[Rule]:
    return [Q.accepted_range(c, low, high, severity=severity) for c, (low, high) in bounds.items()]


def _key(*columns: str, severity: str = "error") -> list[Rule]:
    return [Q.unique(*columns, severity=severity)]


def _of_commune(column: str, severity: str = "error") -> list[Rule]:
    return [Q.relationship(column, "dim_communes", "id", severity)]


# Upper limits of the salary measures by occupation.
SALARY_LIMITS = {
    "management_position": 300_000,
    "intermediate_position": 150_000,
    "service_workers": 100_000,
    "manual_workers": 100_000,
}
# Upper limits of labour force and unemployed by age band, for all and by sex.
LABOUR_LIMITS = {
    "15_64": (2_000_000, 500_000),
    "15_24": (200_000, 100_000),
    "25_54": (800_000, 400_000),
    "55_64": (300_000, 150_000),
}
UNEMPLOYED_LIMITS = {
    "15_64": (200_000, 100_000),
    "15_24": (100_000, 50_000),
    "25_54": (150_000, 75_000),
    "55_64": (50_000, 25_000),
}


def _salary_rules() -> list[Rule]:
    limits = {f"mean_salary{s}": 200_000 for s in ("", "_men", "_women")}
    limits |= {f"mean_salary_{o}{s}": high for o, high in SALARY_LIMITS.items() for s in K.SEXES}
    return [
        *_required(*limits, severity="warn"),
        *_ranges("warn", **{c: (0, high) for c, high in limits.items()}),
    ]


def _labour_rules() -> list[Rule]:
    rules = _required("labor_force_count_total_15_64", severity="warn")
    for band in K.AGE_BANDS:
        for sex in K.LABOUR_SEXES:
            one = 0 if sex == "total" else 1
            hard = band == "15_64" and sex == "total"
            rules += _ranges("warn", **{f"labor_force_count_{sex}_{band}": (0, LABOUR_LIMITS[band][one])})
            rules += _ranges(
                "error" if hard else "warn",
                **{f"unemployed_count_{sex}_{band}": (0, UNEMPLOYED_LIMITS[band][one])},
            )
            rules += _ranges("warn", **{f"unemployment_rate_{sex}_{band}": (0, 100)})
    return rules


INCOME_SHARES = [m for m in K.INCOME_MEASURES if m.endswith("_share") and m != "tax_share"]

RULES: Mapping[str, Sequence[Rule]] = {
    "dim_communes": [
        *_key("id"),
        *_required("id", "name", "department_code", "department_name"),
        Q.accepted_values("territory_type", ["METROPOLE_DROM", "COM"]),
        *[
            Q.accepted_values(f"flag_{f}", BINARY)
            for f in (
                "corsica", "metropole", "prefecture", "chef_lieu_arrondissement", "sous_prefecture"
            )
        ],
    ],
    "dim_geography": [
        *_key("commune_id"),
        *_required("commune_id"),
        *_of_commune("commune_id", "warn"),
        Q.accepted_range("area_km2", 0, 10_000_000, where="area_km2 is not null", severity="warn"),
        *_ranges("error", perimeter=(0, 1_000_000_000), number_enclaves=(0, 100)),
    ],
    "dim_neighbour_communes": [
        *_key("parcel_id", "neighbor_id"),
        *_required("parcel_id", "neighbor_id"),
        *_of_commune("parcel_id"),
        *_of_commune("neighbor_id"),
    ],
    "dim_zip_codes": [
        *_key("id"),
        *_required(
            "id", "zip_code_char", "zip_code_main_department", "number_of_communes",
            "number_of_departments",
        ),
        *_ranges("error", number_of_communes=(1, None), number_of_departments=(1, None)),
    ],
    "bridge_communes_zip_codes": [
        *_key("commune_id", "zip_code_id"),
        *_required("commune_id", "zip_code_id", "zip_code_char"),
        *_of_commune("commune_id"),
    ],
    "dim_monument": [
        *_key("reference"),
        *_required("reference"),
        *_required("name", severity="warn"),
        *_ranges("warn", longitude=(-5.5, 10), latitude=(41, 52)),
    ],
    "bridge_monument_communes": [
        *_key("monument_reference", "commune_code"),
        *_required("monument_reference", "commune_code"),
    ],
    "dim_commune_monument_stats": [*_key("commune_id"), *_required("commune_id")],
    "fact_classification_history": [
        *_key("monument_reference", "event_date", "new_protection_level", severity="warn"),
        *_required("monument_reference", "event_date", "new_protection_level"),
    ],
    "dim_criminality_indicateur": [
        *_key("indicateur_id"),
        *_key("name_fr"),
        *_key("name_en"),
        *_required("indicateur_id", "name_fr", "name_en", "unite_de_compte_fr", "unite_de_compte_en"),
    ],
    "fact_criminality": [
        *_key("commune_id", "annee", "indicateur_id"),
        *_required("commune_id", "annee", "indicateur_id", "est_diffuse"),
        Q.relationship("indicateur_id", "dim_criminality_indicateur", "indicateur_id"),
        *_ranges("error", annee=(2016, 2025)),
        *_ranges("warn", taux_pour_mille=(0, 1000), insee_pop=(0, 3_000_000), insee_log=(0, 1_500_000)),
    ],
    "dim_equipment": [*_key("equipment_type_id"), *_required("equipment_type_id")],
    "fact_equipment": [
        *_key("commune_id", "year", "equipment_type_id"),
        *_required("commune_id", "year", "equipment_type_id", "source_id"),
        *_of_commune("commune_id"),
        Q.relationship("equipment_type_id", "dim_equipment", "equipment_type_id"),
        Q.relationship("source_id", "dim_source", "source_id"),
        *_ranges("warn", count=(0, 500_000)),
    ],
    "fact_population": [
        *_key("id", "year"),
        *_required("id", "year"),
        *_of_commune("id"),
        *_ranges("error", population=(0, 3_000_000)),
        *_ranges(
            "warn",
            year_evolution=(-3_000_000, 3_000_000), year_evolution_percent=(-100, 1000),
            births=(0, 50_000), deaths=(0, 50_000),
            **{c: (0, 100_000) for c in K.FAMILY_CELLS},
        ),
    ],
    "fact_salaries": [
        *_key("id", "year"),
        *_required("id", "year"),
        *_of_commune("id"),
        Q.accepted_values("year", [2023], "warn"),
        *_salary_rules(),
    ],
    "fact_unemployment": [
        *_key("commune_code", "year"),
        *_required("commune_code", "year"),
        *_of_commune("commune_code"),
        *_labour_rules(),
    ],
    "fact_income": [
        *_key("id", "year"),
        *_required("id", "year", "methodology_version"),
        *_of_commune("id", "warn"),
        *_ranges("error", year=(2013, 2023)),
        Q.accepted_values("methodology_version", ["filosofi_1", "filosofi_2"]),
        *_ranges(
            "warn",
            nb_tax_households=(0, 2_000_000), nb_persons=(0, 5_000_000), median_income=(0, 200_000),
            poverty_rate=(0, 100), gini=(0, 1),
            **{share: (-50, 150) for share in INCOME_SHARES},
            tax_share=(-100, 0),
        ),
    ],
    "dim_calendar": [*_key("date_id"), *_key("date"), *_required("date_id", "date")],
    "dim_source": [*_key("source_id"), *_required("source_id")],
    "bridge_source_links": [
        *_key("source_link_id"),
        *_key("target_table", "target_key", "source_id"),
        *_required("source_link_id", "target_key", "source_id"),
        Q.relationship("source_id", "dim_source", "source_id"),
    ],
}


def check_table(table: str, df: DataFrame, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Failures of a published table, one row per rule."""
    return Q.report(df, RULES[table], parents)


def build_and_check(
    table: str, df: DataFrame, path: str, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Write a table, then test what was written; error-level failures raise. Returns the report."""
    from cadastra.sources import readers, writers

    number = writers.write_table(df, path)
    return Q.gate(readers.read_table(df.sparkSession, path, number), RULES[table], parents)
