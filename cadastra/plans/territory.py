"""Communes, their geography, neighbours and postal codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.functions.columns import crosswalk_ranges, enforce, flag, found
from cadastra.operators.joins import requested_keys
from cadastra.operators.sets import union_all
from cadastra.operators.spatial import neighbours
from cadastra.plans.constants import CITY_ZIP_RANGES, CORSICA, INSULAR_DEPARTMENTS, ISLANDS

COMMUNE_COLUMNS = [
    "id", "name", "name_upper", "arrondissement_code", "arrondissement_name", "department_code",
    "department_name", "region_code", "region_name", "territory_type", "flag_corsica",
    "flag_metropole", "flag_prefecture", "flag_chef_lieu_arrondissement", "flag_sous_prefecture",
]


def _names(df: DataFrame, code: str, prefix: str, seat: bool = True) -> DataFrame:
    seats = [F.col("CHEFLIEU").alias(f"{prefix}_seat")] if seat else []
    return df.select(F.col(code), F.col("LIBELLE").alias(f"{prefix}_name"), *seats)


def dim_communes(
    communes: DataFrame,
    departments: DataFrame,
    arrondissements: DataFrame,
    regions: DataFrame,
    overseas: DataFrame,
) -> DataFrame:
    """All communes with their division names and flags. The lookups are dimension tables that
    Spark broadcasts when their files are small enough."""
    named = (
        communes.filter(F.col("TYPECOM") == "COM")
        .join(_names(departments, "DEP", "department"), "DEP", "left")
        .join(_names(arrondissements, "ARR", "arrondissement"), "ARR", "left")
        .join(_names(regions, "REG", "region", seat=False), "REG", "left")
    )
    own = F.col("COM")
    is_seat_of = {
        "department": F.col("department_seat") == own,
        "arrondissement": F.col("arrondissement_seat") == own,
    }
    mainland = named.select(
        own.alias("id"),
        F.col("NCCENR").alias("name"),
        F.col("NCC").alias("name_upper"),
        F.nullif("ARR", F.lit("")).alias("arrondissement_code"),
        "arrondissement_name",
        F.col("DEP").alias("department_code"),
        "department_name",
        F.col("REG").alias("region_code"),
        "region_name",
        F.lit("METROPOLE_DROM").alias("territory_type"),
        flag(F.col("DEP").isin(CORSICA)).alias("flag_corsica"),
        # Overseas department codes have three characters; an unknown code is not overseas.
        F.when(F.length("DEP") == 3, 0).otherwise(1).alias("flag_metropole"),
        flag(is_seat_of["department"]).alias("flag_prefecture"),
        flag(is_seat_of["arrondissement"]).alias("flag_chef_lieu_arrondissement"),
        flag(is_seat_of["arrondissement"] & (F.col("department_seat") != own)).alias(
            "flag_sous_prefecture"
        ),
    )
    territory = F.col("COMER")
    collectivities = overseas.select(
        F.col("COM_COMER").alias("id"),
        F.col("NCCENR").alias("name"),
        F.col("NCC").alias("name_upper"),
        F.lit(None).cast("string").alias("arrondissement_code"),
        F.lit(None).cast("string").alias("arrondissement_name"),
        territory.alias("department_code"),
        F.col("LIBELLE_COMER").alias("department_name"),
        territory.alias("region_code"),
        F.col("LIBELLE_COMER").alias("region_name"),
        F.lit("COM").alias("territory_type"),
        *[F.lit(0).alias(c) for c in COMMUNE_COLUMNS if c.startswith("flag_")],
    )
    return union_all([mainland, collectivities]).select(*COMMUNE_COLUMNS)


def littoral(perimeter: DataFrame) -> DataFrame:
    """Shore classification rows to one row per commune with a flag per kind of shore."""
    kinds = {"is_coast": "Mer", "has_estuary": "Estuaire", "has_lake": "Lac"}
    classed = F.col("CLASSEMENT")
    return perimeter.groupBy(F.col("INSEE_COM").alias("commune_id")).agg(
        *[F.coalesce(F.bool_or(classed == v), F.lit(False)).alias(k) for k, v in kinds.items()]
    )


def mountain_zones(perimeter: DataFrame) -> DataFrame:
    return perimeter.select(F.col("INSEE_COM").alias("commune_id")).distinct()


def island_communes(communes: DataFrame) -> DataFrame:
    """Insular departments and single island communes, which do not overlap."""
    listed = [code for codes in ISLANDS.values() for code in codes]
    return communes.select(
        "id", "name", "department_code",
        F.col("department_code").isin(INSULAR_DEPARTMENTS).alias("is_insular"),
        F.col("id").isin(listed).alias("is_island_commune"),
    )


def unknown_islands(communes: DataFrame) -> DataFrame:
    """Listed island codes that no commune has."""
    listed = [(c,) for codes in ISLANDS.values() for c in codes]
    wanted = communes.sparkSession.createDataFrame(listed, "id string")
    return requested_keys(wanted, communes, "id")[1]


def dim_geography(
    shapes: DataFrame,
    mountains: DataFrame,
    shores: DataFrame,
    altitudes: DataFrame,
    islands: DataFrame,
    *,
    corsica_area: bool = False,
) -> DataFrame:
    """Shapes with measures and attribute flags.

    Areas come from one equal-area projection for all territories. Corsican areas stay NULL as
    published unless ``corsica_area`` is set.
    """
    yes = F.lit(False)
    g = F.col("geometry")
    shore_flags = ["is_coast", "has_estuary", "has_lake"]
    island_flags = ["is_insular", "is_island_commune"]
    joined = (
        shapes.select(
            F.col("code").alias("commune_id"), F.col("nom").alias("name"),
            F.col("departement").alias("department_code"), F.col("region").alias("region_code"),
            "epci", "geometry",
        )
        .join(mountains.select("commune_id", F.lit(True).alias("_m")).distinct(), "commune_id", "left")
        .join(
            shores.select("commune_id", *[F.col(c).cast("boolean") for c in shore_flags]).distinct(),
            "commune_id", "left",
        )
        .join(
            enforce(
                altitudes,
                [
                    ("commune_id", "commune_id", "string"),
                    ("altitude_min", "altitude_min", "int"),
                    ("altitude_max", "altitude_max", "int"),
                    ("altitude_moyenne", "altitude_moyenne", "double"),
                ],
            ).distinct(),
            "commune_id", "left",
        )
        .join(
            islands.select(
                F.col("id").alias("commune_id"), *[F.col(c).cast("boolean") for c in island_flags]
            ).distinct(),
            "commune_id", "left",
        )
    )
    area = geo.area_km2(g)
    if not corsica_area:
        area = F.when(~F.col("department_code").isin(CORSICA), area)
    return joined.select(
        "commune_id", "name", "department_code", "region_code", "epci", "geometry",
        found(F.col("_m")).alias("is_mountain"),
        *[F.coalesce(F.col(c), yes).alias(c) for c in shore_flags],
        "altitude_min", "altitude_max", "altitude_moyenne",
        *[F.coalesce(F.col(c), yes).alias(c) for c in island_flags],
        geo.centroid(g).alias("centroid"),
        area.alias("area_km2"),
        *geo.bbox(g),
        geo.perimeter(g).alias("perimeter"),
        (geo.parts(g) > 1).alias("is_multipolygon"),
        geo.holes(g).alias("number_enclaves"),
    )


def dim_neighbour_communes(
    geography: DataFrame, communes: DataFrame, *, same_department: bool = True
) -> DataFrame:
    """Touching communes of the same part of the territory; on the mainland of the same
    department unless told otherwise. Overseas communes are compared across departments."""
    mainland = F.col("flag_metropole") == 1
    scope = F.when(mainland & F.lit(same_department), F.col("department_code")).otherwise(F.lit(""))
    shapes = geography.select(F.col("commune_id").alias("parcel_id"), "geometry").join(
        communes.select(
            F.col("id").alias("parcel_id"), "flag_corsica", "flag_metropole", scope.alias("scope")
        ),
        "parcel_id",
    )
    pairs = neighbours(shapes, "parcel_id", "geometry", ["flag_corsica", "flag_metropole", "scope"])
    return pairs.select("parcel_id", F.col("neighbour").alias("neighbor_id"))


def dim_zip_codes(zip_codes: DataFrame) -> DataFrame:
    """Postal codes with the communes and departments they serve. Pairs fold first, so a code
    that serves most rows is not counted in one task."""
    zip_code, commune = F.col("Code_postal"), F.col("`#Code_commune_INSEE`")
    pairs = zip_codes.select(zip_code.alias("z"), commune.alias("c")).distinct()
    departments = pairs.groupBy("z", F.substring("c", 1, 2).alias("d")).agg(F.count("c").alias("n"))
    return departments.groupBy("z").agg(
        F.sum("n").alias("number_of_communes"), F.count("d").alias("number_of_departments")
    ).select(
        F.col("z").cast("int").alias("id"),
        F.col("z").alias("zip_code_char"),
        F.substring("z", 1, 2).alias("zip_code_main_department"),
        "number_of_communes",
        "number_of_departments",
    )


def bridge_communes_zip_codes(zip_codes: DataFrame, communes: DataFrame) -> DataFrame:
    """Commune and postal code pairs; district codes of three cities go to the city, codes
    outside the commune table are dropped."""
    number = F.col("Code_postal").cast("int")
    pairs = zip_codes.select(
        crosswalk_ranges(number, CITY_ZIP_RANGES, F.col("`#Code_commune_INSEE`")).alias("commune_id"),
        number.alias("zip_code_id"),
        F.col("Code_postal").alias("zip_code_char"),
    ).distinct()
    return pairs.join(communes.select(F.col("id").alias("commune_id")), "commune_id", "left_semi")
