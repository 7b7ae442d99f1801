"""Fact loads: append what is new, reload in full, and the checks before a load."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators.skew import skew_join


def append_new(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], loaded_at: str | Column
) -> DataFrame:
    """Incoming rows whose natural key the table does not hold yet, stamped with the load time.

    Known keys are folded to distinct ones before the anti join; a key repeated in the delivery
    is salted.
    """
    now = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    known = existing.select(*keys).distinct()
    rest = skew_join(incoming, known, keys, "left_anti")
    return rest.select(now.cast("timestamp").alias("inserted_at"), *incoming.columns)


def full_reload(incoming: DataFrame, loaded_at: str | Column) -> DataFrame:
    """The delivery as the new content of the table."""
    now = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return incoming.select(now.cast("timestamp").alias("inserted_at"), *incoming.columns)


def assert_loadable(read: Callable[[], DataFrame], table: str) -> DataFrame:
    """The validated table, or an error if it cannot be read or is empty. Only one row is
    fetched to find out."""
    try:
        df = read()
        blank = df.isEmpty()
    except Exception as error:
        raise ValueError(f"{table}: validated data cannot be read") from error
    if blank:
        raise ValueError(f"{table}: validated data is empty")
    return df


@dataclass(frozen=True)
class Load:
    """How one table is loaded: by history, by appending or by full reload."""

    strategy: str
    keys: tuple[str, ...] = ()


# Natural keys and load strategies of the published tables.
LOADS: Mapping[str, Load] = {
    "dim_communes": Load("history", ("id",)),
    "dim_geography": Load("history", ("commune_id",)),
    "dim_zip_codes": Load("history", ("id",)),
    "dim_neighbour_communes": Load("history", ("parcel_id", "neighbor_id")),
    "bridge_communes_zip_codes": Load("append", ("commune_id", "zip_code_id")),
    "dim_monument": Load("history", ("reference",)),
    "bridge_monument_communes": Load("append", ("monument_reference", "commune_code")),
    "fact_classification_history": Load("append", ("monument_reference", "event_date")),
    "dim_commune_monument_stats": Load("append", ("commune_id",)),
    "dim_criminality_indicateur": Load("history", ("indicateur_id",)),
    "fact_criminality": Load("reload", ("commune_id", "annee", "indicateur_id")),
    "dim_equipment": Load("append", ("equipment_code",)),
    "fact_equipment": Load("reload", ("commune_id", "year", "equipment_type_id")),
    "fact_population": Load("reload", ("id", "year")),
    "fact_salaries": Load("reload", ("id", "year")),
    "fact_unemployment": Load("reload", ("commune_code", "year")),
    "fact_income": Load("reload", ("id", "year")),
    "dim_calendar": Load("reload", ("date_id",)),
    "dim_source": Load("reload", ("source_id",)),
    "bridge_source_links": Load("reload", ("source_link_id",)),
}


def load(
    table: str, existing: DataFrame | None, incoming: DataFrame, as_of: str, loaded_at: str
) -> DataFrame:
    """New content of a table by its registered strategy."""
    from cadastra.operators import history

    plan = LOADS[table]
    if plan.strategy == "history":
        history.check_keys(incoming, plan.keys)
        base = existing if existing is not None else history.empty_history(
            incoming.sparkSession, incoming.schema
        )
        return history.scd2_merge(base, incoming, plan.keys, as_of, loaded_at)
    if plan.strategy == "append" and existing is not None:
        return existing.unionByName(append_new(existing, incoming, plan.keys, loaded_at))
    return full_reload(incoming, loaded_at)
