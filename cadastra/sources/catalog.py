"""Where each source lies and how it is read; layered views over stored tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.sources import readers


@dataclass(frozen=True)
class Source:
    """One external table: folder, file pattern and format. ``all_versions`` reads every stamped
    file (rows of several versions stack up); the default is the newest only."""

    folder: str
    pattern: str
    kind: str = "csv"
    sep: str = ""
    encoding: str = "UTF-8"
    columns: tuple[str, ...] = ()
    lists: tuple[str, ...] = ()
    all_versions: bool = False


# The declared sources, their file patterns and encodings. An empty separator is
# taken from the header line.
SOURCES: Mapping[str, Source] = {
    "communes_geojson": Source(
        "geography", "communes_*.geojson", "geojson",
        columns=("code", "nom", "departement", "region", "epci"),
    ),
    "cog_communes": Source("geography", "v_commune_2026_*.csv"),
    "cog_communes_comer": Source("geography", "v_commune_comer_2026_*.csv"),
    "cog_departements": Source("geography", "v_departement_2026_*.csv"),
    "cog_arrondissements": Source("geography", "v_arrondissement_2026_*.csv"),
    "cog_regions": Source("geography", "v_region_2026_*.csv"),
    "mountain_zones": Source("geography", "mountain_zones_*.csv"),
    "littoral": Source("geography", "littoral_*.csv"),
    "altitude": Source("geography", "altitude_*.csv"),
    "island_communes": Source("geography", "island_communes_*.csv"),
    "zip_codes": Source("geography", "zip_codes_*.csv", sep=";", encoding="ISO-8859-1"),
    "populations_historiques": Source("demographics", "historical_population_*.csv"),
    "salaries": Source("demographics", "historical_salaries_*.csv"),
    "births": Source("demographics", "births_*.csv"),
    "deaths": Source("demographics", "deaths_*.csv"),
    "family": Source("demographics", "family_*.csv"),
    "migration": Source("demographics", "migration_*.csv"),
    "unemployment": Source("demographics", "unemployment_*.csv"),
    "overseas_population": Source("demographics", "overseas_population_*.csv"),
    "filosofi_income": Source("income", "filosofi_income_*.csv"),
    "bpe": Source("equipment", "bpe_*.csv", sep=";"),
    "dim_equipment": Source("dim_equipment", "dim_equipment_*.csv"),
    "criminality": Source("criminality", "delinquance_*.parquet", "parquet"),
    "dim_criminality_indicateur": Source(
        "dim_criminality_indicateur", "dim_criminality_indicateur_*.csv"
    ),
    "monuments_historiques": Source(
        "cultural_heritage", "monuments_historiques_*.geojson", "geojson",
        columns=(
            "reference", "denomination_de_l_edifice", "autre_appellation_de_l_edifice", "domaine",
            "typologie_de_la_protection", "nature_de_la_protection",
            "statut_juridique_de_l_edifice", "destination_actuelle_de_l_edifice",
            "siecle_de_la_campagne_principale_de_construction", "auteur_de_l_edifice",
            "etat_de_conservation", "cadastre", "lieudit", "vocable_pour_les_edifices_cultuels",
            "description_de_l_edifice", "historique", "lien_vers_la_base_archiv_mh",
            "lien_vers_la_base_palissy", "date_et_typologie_de_la_protection",
            "cog_insee_lors_de_la_protection",
        ),
        lists=("cog_insee_lors_de_la_protection",),
    ),
    "french_holidays": Source("dim_calendar", "french_holidays_*.csv"),
    "market_holidays": Source("dim_calendar", "market_holidays_*.csv"),
    "religious_holidays": Source("dim_calendar", "religious_holidays_*.csv"),
    "french_presidents": Source("dim_calendar", "french_presidents_*.csv"),
    "french_prime_ministers": Source("dim_calendar", "french_prime_ministers_*.csv"),
    "french_legislatures": Source("dim_calendar", "french_legislatures_*.csv"),
    "lunar_phases": Source("dim_calendar", "lunar_phases_*.csv"),
    "sources": Source("dim_source", "sources_*.csv"),
    "bridge_model_sources": Source("dim_source", "bridge_model_sources_*.csv"),
}


def read_source(
    spark: SparkSession, root: str, name: str, specs: Mapping[str, Source] = SOURCES
) -> DataFrame:
    """A declared source below ``root``, newest version by default."""
    spec = specs[name]
    folder = f"{root}/{spec.folder}"
    path = f"{folder}/{spec.pattern}" if spec.all_versions else readers.newest_file(spark, folder, spec.pattern)
    if spec.kind == "parquet":
        return readers.read_parquet(spark, path)
    if spec.kind == "geojson":
        return readers.read_geojson(spark, path, spec.columns, spec.lists)
    sep = spec.sep or readers.detect_sep(spark, path)
    return readers.read_csv(spark, path, spec.columns or None, sep, spec.encoding)


def register_layer(spark: SparkSession, layer: str, tables: Mapping[str, DataFrame]) -> list[str]:
    """Lazy views ``<layer>_<table>`` over stored tables; nothing is read yet."""
    names = []
    for table, df in tables.items():
        view = f"{layer}_{table}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def register_stored_layer(spark: SparkSession, layer: str, root: str, tables: Iterable[str]) -> list[str]:
    """Views over the newest version of each stored table below ``root``."""
    return register_layer(
        spark, layer, {t: readers.read_table(spark, f"{root}/{t}") for t in tables}
    )


def create_layer(spark: SparkSession, layer: str, root: str, tables: Iterable[str]) -> list[str]:
    """A schema with one external table per stored table, so that SQL names ``layer.table``. The
    tables point at the newest versions; run it again after a load."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
    names = []
    for table in tables:
        number = readers.versions(spark, f"{root}/{table}")[-1]
        spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
        spark.catalog.createTable(f"{layer}.{table}", f"{root}/{table}/version={number}", "parquet")
        names.append(f"{layer}.{table}")
    return names


SOURCE_FIELDS = [
    "source_id", "source_name", "source_label", "organization", "domain",
    "reference_url", "license", "description",
]


def source_table(spark: SparkSession, groups: Mapping[str, Sequence[Mapping]]) -> DataFrame:
    """The table of sources from configuration lists (downloads, files, scrapes, generated), by
    numeric id. Entries without an id are not sources."""
    rows = [
        tuple(entry.get(f) if f == "source_id" or entry.get(f) is None else str(entry.get(f)) for f in SOURCE_FIELDS)
        for entries in groups.values()
        for entry in entries
        if entry.get("source_id") is not None
    ]
    schema = "source_id int, " + ", ".join(f"{f} string" for f in SOURCE_FIELDS[1:])
    return spark.createDataFrame(rows, schema).orderBy("source_id")


def model_sources(spark: SparkSession, models: Mapping[str, Sequence[int]]) -> DataFrame:
    """Which sources feed which model: one row per pair."""
    listed = spark.createDataFrame(
        [(name, list(ids)) for name, ids in models.items()], "model_name string, ids array<int>"
    )
    return listed.select("model_name", F.explode("ids").alias("source_id"))
