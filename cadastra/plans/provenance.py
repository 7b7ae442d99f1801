"""Sources, model links and the row-level provenance bridge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import enforce, text_key
from cadastra.operators import provenance as P
from cadastra.operators.sets import union_all
from cadastra.plans.constants import LABEL_TYPES, TABLE_SOURCES
from cadastra.sources.catalog import SOURCE_FIELDS

LABEL_SCHEMA = "id string, label_name string, label_type string"


def dim_source(sources: DataFrame) -> DataFrame:
    return enforce(
        sources, [("source_id", "source_id", "int"), *[(f, f, "string") for f in SOURCE_FIELDS[1:]]]
    )


def dim_labels(labelled: Mapping[str, DataFrame]) -> DataFrame:
    """Label awards from the extracted pages: label type -> table with a name column. The id is
    the place name with its department, as the pages carry no commune code."""
    parts = [
        df.select(
            text_key(F.col("name"), F.col("department")).alias("id"),
            F.col("name").alias("label_name"),
            F.lit(kind).alias("label_type"),
        )
        for kind, df in labelled.items()
    ]
    return union_all(parts).distinct()


def bridge_source_links(tables: Mapping[str, DataFrame], sources: DataFrame) -> DataFrame:
    """Provenance of every given table. Tables of labels link by label type."""
    parts = []
    for table, df in tables.items():
        if table == "dim_labels":
            key = text_key(F.col("id"), F.coalesce("label_type", F.lit("")))
            mapping = {kind: kind for kind in LABEL_TYPES}
            parts.append(P.mapped_links(df, table, key, "label_type", mapping, sources))
            continue
        columns, names = TABLE_SOURCES[table]
        parts.append(P.links(df, table, text_key(*[F.col(c) for c in columns]), sources, names))
    return P.bridge(parts)
