"""Sinks: versioned Parquet tables, delimited text, GeoJSON lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.sources.readers import _filesystem, versions


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite one validated table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_table(df: DataFrame, path: str) -> int:
    """Write the next version of a table and return its number. Readers of the version before
    are not disturbed, and a failed job leaves no visible version."""
    known = versions(df.sparkSession, path)
    number = known[-1] + 1 if known else 1
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    return number


def create_if_missing(spark: SparkSession, path: str, schema) -> None:
    """Start a table as an empty first version."""
    if not versions(spark, path):
        write_table(spark.createDataFrame([], schema), path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to an append-only table."""
    df.write.mode("append").parquet(path)


def drop_table(spark: SparkSession, path: str) -> bool:
    """Remove a stored table; False if there was none."""
    fs, root = _filesystem(spark, path)
    return bool(fs.exists(root) and fs.delete(root, True))


def drop_old_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` versions; returns those removed."""
    fs, root = _filesystem(spark, path)
    old = versions(spark, path)[:-keep] if keep else versions(spark, path)
    for number in old:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"version={number}"), True)
    return old


def write_csv(df: DataFrame, path: str, columns: Sequence[str], single: bool = False) -> None:
    """Delimited text with a header and a fixed column order. ``single`` gathers a small
    aggregate into one file; leave it off for anything that grows with the data."""
    out = df.select(*columns)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).csv(path)


def feature_text(x: Column, y: Column, properties: Sequence[str]) -> Column:
    """A GeoJSON point feature; NULL properties stay as explicit nulls."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates"))
    body = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        geometry.alias("geometry"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def write_points(df: DataFrame, path: str, x: str, y: str) -> None:
    """Points as GeoJSON lines."""
    properties = [c for c in df.columns if c not in (x, y)]
    df.select(feature_text(F.col(x), F.col(y), properties).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def collection_columns(df: DataFrame) -> DataFrame:
    """Columns a field worker fills in."""
    return df.withColumns(
        {
            "visited": F.lit(False),
            "visit_date": F.lit(None).cast("date"),
            "photo": F.lit(None).cast("string"),
        }
    )
