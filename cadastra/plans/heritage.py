"""Monuments, the communes they stand in, and their protection history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import crosswalk, enforce, found
from cadastra.functions.dates import slashed_date
from cadastra.operators.aggregates import distinct_buckets
from cadastra.operators.skew import skew_join
from cadastra.operators.spatial import locate
from cadastra.operators.windows import flag_extreme, previous_state
from cadastra.plans.constants import CITY_CODES, MONUMENT_DOMAINS

MONUMENT_FIELDS = [
    ("reference", "reference"),
    ("denomination_de_l_edifice", "name"),
    ("autre_appellation_de_l_edifice", "alternative_name"),
    ("domaine", "domain"),
    ("denomination_de_l_edifice", "denomination"),
    ("nature_de_la_protection", "nature"),
    ("typologie_de_la_protection", "_protection"),
    ("date_et_typologie_de_la_protection", "_history"),
    ("statut_juridique_de_l_edifice", "legal_status"),
    ("destination_actuelle_de_l_edifice", "current_use"),
    ("siecle_de_la_campagne_principale_de_construction", "century"),
    ("auteur_de_l_edifice", "author"),
    ("etat_de_conservation", "conservation_state"),
    ("cadastre", "cadastre"),
    ("lieudit", "lieu_dit"),
    ("vocable_pour_les_edifices_cultuels", "vocable"),
    ("description_de_l_edifice", "description"),
    ("historique", "historical"),
    ("lien_vers_la_base_archiv_mh", "source_url"),
    ("lien_vers_la_base_palissy", "palissy_url"),
]
MONUMENT_COLUMNS = [
    "reference", "name", "alternative_name", "domain", "denomination", "nature",
    "protection_level", "protection_scope", "first_protection_date", "last_protection_date",
    "legal_status", "current_use", "century", "author", "conservation_state", "cadastre",
    "lieu_dit", "vocable", "description", "historical", "source_url", "palissy_url",
    "primary_commune_code", "longitude", "latitude",
]


def protection_level(text: Column) -> Column:
    lowered = F.lower(text)
    return F.when(lowered.contains("classé"), "classé").when(lowered.contains("inscrit"), "inscrit")


def protection_scope(text: Column) -> Column:
    return F.when(F.lower(text).contains("partiellement"), "partiellement")


def clean_code(raw: Column) -> Column:
    """A commune code without label, quotes and blanks, mapped to its city."""
    code = F.when(raw.contains(":"), F.trim(F.split_part(raw, F.lit(":"), F.lit(1)))).otherwise(
        F.btrim(raw, F.lit(' "'))
    )
    return crosswalk(code, CITY_CODES)


def _event_date(event: Column) -> Column:
    return slashed_date(F.split_part(F.trim(event), F.lit(" : "), F.lit(1)))


def dim_monument(monuments: DataFrame, communes: DataFrame, geography: DataFrame) -> DataFrame:
    """Monuments with protection, dates and their commune. Only monuments whose code is unknown
    and that have coordinates are located by their position."""
    codes = F.col("cog_insee_lors_de_la_protection")
    typed = enforce(
        monuments.withColumn("_code", clean_code(F.coalesce(F.get(codes, F.lit(0)), F.lit("")))),
        [*[(s, d, "string") for s, d in MONUMENT_FIELDS], ("_code", "_code", "string"),
         ("x", "longitude", "double"), ("y", "latitude", "double")],
    )
    # One city may hold a third of the monuments.
    known = communes.select(F.col("id").alias("_code"), F.lit(True).alias("_known"))
    coded = skew_join(typed, known, ["_code"], "left", spread=["reference"])
    lost = coded.filter(F.col("_known").isNull() & F.col("longitude").isNotNull())
    placed = locate(
        lost, "reference", "longitude", "latitude",
        geography.select("commune_id", "geometry"), "commune_id", "geometry",
    )
    events = F.split("_history", ";")
    return (
        coded.join(placed, "reference", "left")
        .withColumns(
            {
                "primary_commune_code": F.when(F.col("_known"), F.col("_code")).otherwise(
                    F.coalesce("commune_id", "_code")
                ),
                "protection_level": protection_level(F.col("_protection")),
                "protection_scope": protection_scope(F.col("_protection")),
                "first_protection_date": _event_date(F.get(events, F.lit(0))),
                "last_protection_date": _event_date(F.get(F.reverse(events), F.lit(0))),
            }
        )
        .select(*MONUMENT_COLUMNS)
    )


def monument_traits(monuments: DataFrame) -> DataFrame:
    """Domain and protection of each monument, as ``dim_monument`` has them, without looking for its place."""
    wanted = [(s, d, "string") for s, d in MONUMENT_FIELDS if d in ("reference", "domain", "_protection")]
    return enforce(monuments, wanted).select(
        "reference", "domain",
        protection_level(F.col("_protection")).alias("protection_level"),
        protection_scope(F.col("_protection")).alias("protection_scope"),
    )


def bridge_monument_communes(monuments: DataFrame, communes: DataFrame) -> DataFrame:
    """All communes of each monument; the smallest code is the primary one."""
    listed = (
        monuments.select(
            F.col("reference").alias("monument_reference"),
            F.explode("cog_insee_lors_de_la_protection").alias("raw"),
        )
        .filter(F.btrim("raw", F.lit(' "')) != "")
        .select("monument_reference", clean_code(F.col("raw")).alias("commune_code"))
        .filter(F.col("commune_code").rlike("^[0-9A-B]{5}$"))
    )
    pairs = listed.distinct()
    flagged = flag_extreme(
        pairs, ["monument_reference"], ["commune_code"], "is_primary",
        sketch=monuments.select(F.col("reference").alias("monument_reference")),
    )
    known = communes.select(F.col("id").alias("commune_code"), F.col("id").alias("_id"))
    joined = skew_join(
        flagged, known, ["commune_code"], "left", spread=["monument_reference"], sketch=listed
    )
    return joined.select(
        "monument_reference", "commune_code", "is_primary", found(F.col("_id")).alias("commune_exists")
    )


def dim_commune_monument_stats(
    communes: DataFrame, bridge: DataFrame, monuments: DataFrame
) -> DataFrame:
    """Monuments per commune by domain and protection; communes without one count 0."""
    domain = F.col("domain")
    listed = [d for group in MONUMENT_DOMAINS.values() for d in group]
    buckets = {name: domain.isin(group) for name, group in MONUMENT_DOMAINS.items()}
    buckets["other_count"] = domain.isNull() | ~domain.isin(listed)
    buckets["classified_count"] = F.col("protection_level") == "classé"
    buckets["inscribed_count"] = F.col("protection_level") == "inscrit"
    buckets["partial_protection_count"] = F.col("protection_scope") == "partiellement"
    facts = monuments.select(
        F.col("reference").alias("monument_reference"), "domain", "protection_level", "protection_scope"
    )
    counted = distinct_buckets(
        bridge.join(facts, "monument_reference"), ["commune_code"], "monument_reference",
        buckets, "total_monuments",
    )
    names = ["total_monuments", *buckets]
    return communes.select(F.col("id").alias("commune_code")).join(counted, "commune_code", "left").select(
        F.col("commune_code").alias("commune_id"),
        *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names],
    )


def transition(previous: Column, new: Column) -> Column:
    """Kind of change between two protection levels."""
    return (
        F.when(previous.isNull(), "initial")
        .when(previous == new, "update")
        .when((previous == "inscrit") & (new == "classé"), "upgrade")
        .when((previous == "classé") & (new == "inscrit"), "downgrade")
        .otherwise("change")
    )


def protection_events(monuments: DataFrame) -> DataFrame:
    """Dated entries of the protection texts, one row each. Entries without a full date are
    dropped."""
    history = F.col("date_et_typologie_de_la_protection")
    entries = monuments.filter(history.isNotNull()).select(
        F.col("reference").alias("monument_reference"), F.explode(F.split(history, ";")).alias("e")
    )
    entry = F.trim("e")
    day = F.split_part(entry, F.lit(" : "), F.lit(1))
    kind = F.split_part(entry, F.lit(" : "), F.lit(2))
    return (
        entries.filter(day.rlike(r"^\d{4}/\d{2}/\d{2}$"))
        .select(
            "monument_reference",
            slashed_date(day).alias("event_date"),
            F.coalesce(protection_level(kind), F.lower(F.trim(kind))).alias("new_protection_level"),
            protection_scope(kind).alias("new_protection_scope"),
        )
        .filter("event_date is not null")
    )


def fact_classification_history(monuments: DataFrame) -> DataFrame:
    """Protection events with the state before each. Events of one day follow the level name."""
    events = protection_events(monuments).withColumn(
        "_scope", F.coalesce("new_protection_scope", F.lit(""))
    )
    staged = previous_state(
        events, ["monument_reference"], ["event_date", "new_protection_level", "_scope"],
        ["new_protection_level", "new_protection_scope"], prefix="_before_",
    )
    before = F.col("_before_new_protection_level")
    return staged.select(
        "monument_reference", "event_date", "new_protection_level", "new_protection_scope",
        before.alias("previous_protection_level"),
        F.col("_before_new_protection_scope").alias("previous_protection_scope"),
        transition(before, F.col("new_protection_level")).alias("event_type"),
    )
