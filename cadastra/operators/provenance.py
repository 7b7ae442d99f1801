"""Row-level provenance: which source each row of each table comes from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.operators.joins import mapped_join
from cadastra.operators.skew import skew_join
from cadastra.operators.windows import surrogate_id


def links(
    df: DataFrame, table: str, key: Column, sources: DataFrame, names: Sequence[str]
) -> DataFrame:
    """One link per row and named source. The ids are looked up as a scalar array, so each row is
    expanded in place instead of joined. ``names`` is a short literal list."""
    ids = (
        sources.filter(F.col("source_name").isin(list(names)))
        .agg(F.array_sort(F.collect_set("source_id")).alias("ids"))
        .scalar()
    )
    return df.select(
        F.lit(table).alias("target_table"),
        key.cast("string").alias("target_key"),
        F.explode(ids).alias("source_id"),
    )


def mapped_links(
    df: DataFrame, table: str, key: Column, column: str, mapping: Mapping[str, str], sources: DataFrame
) -> DataFrame:
    """One link per row; the source depends on the value of a column."""
    known = sources.select("source_id", "source_name")
    joined = mapped_join(df.withColumn("_key", key.cast("string")), column, mapping, known, "source_name")
    return joined.select(
        F.lit(table).alias("target_table"), F.col("_key").alias("target_key"), "source_id"
    )


def bridge(parts: Sequence[DataFrame]) -> DataFrame:
    """All links with an id that is unique over the whole table and stable between runs."""
    stacked = reduce(lambda a, b: a.unionByName(b), parts).distinct()
    return surrogate_id(
        stacked, ["target_table", "target_key", "source_id"], "source_link_id"
    )


def sources_per_table(bridge_: DataFrame, sources: DataFrame) -> DataFrame:
    """Sources of each table as one sorted text, with the number of links."""
    pairs = bridge_.groupBy("target_table", "source_id").agg(F.count("*").alias("n"))
    named = pairs.join(sources.select("source_id", "source_name"), "source_id")
    return named.groupBy("target_table").agg(
        F.expr("listagg(DISTINCT source_name, ', ') WITHIN GROUP (ORDER BY source_name)").alias("sources"),
        F.sum("n").alias("n_links"),
    )


def rows_from(
    df: DataFrame, key: Column, table: str, bridge_: DataFrame, sources: DataFrame
) -> DataFrame:
    """Rows of a table with the label of every source they come from."""
    ours = bridge_.filter(F.col("target_table") == table).select("target_key", "source_id")
    labels = sources.select("source_id", "source_name", "organization")
    # One source may stand behind most rows.
    named = skew_join(ours, labels, ["source_id"], "inner").select(
        F.col("target_key").alias("_key"), "source_name", "organization"
    )
    return df.withColumn("_key", key.cast("string")).join(named, "_key").drop("_key")
