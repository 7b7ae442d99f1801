"""Scans: delimited text, Parquet, GeoJSON, tables with a preamble, stored versions."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions import geo


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def detect_sep(spark: SparkSession, path: str) -> str:
    """The separator of a delimited file: the most frequent candidate on its first line."""
    first = spark.read.text(path).first()
    if first is None:
        return ","
    return max(",;\t|", key=first[0].count)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Delimited text with every column as text: codes keep their leading zeros and there is no
    inference pass. Casting is the recipe's first step."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    reader = reader.option("enforceSchema", False)
    return (reader.schema(strings(columns)) if columns else reader).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def newest_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the newest stamped file of a pattern; names sort by their stamp."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    newest = files.agg(F.max("path")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no file matches {pattern} in {folder}")
    return newest


def newest_delivery(spark: SparkSession, deliveries: str, pattern: str = "part-*") -> str:
    """The newest of the stamped folders that match ``deliveries`` (a glob) and hold files of a pattern."""
    return newest_file(spark, deliveries, pattern).rsplit("/", 1)[0]


def read_deliveries(spark: SparkSession, deliveries: str) -> DataFrame:
    """All Parquet deliveries that match a glob, by column name, with ``delivery``, the name of its folder."""
    rows = spark.read.option("mergeSchema", True).parquet(deliveries)
    return rows.withColumn("delivery", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def read_geojson(spark: SparkSession, path: str, properties: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """Features of GeoJSON text: properties as text columns and the geometry.

    A polygon becomes the nested array type, a point ``x``/``y``. Properties named in ``lists``
    are arrays of text. Every file may have its own layout: a feature per line, or collections laid
    out in any way, spelled with or without spaces.

    The text is cut at the value ``"Feature"``, so one document is split over tasks. Each cut must
    stand behind the key ``type``, and a feature must name its type first; whatever else is met
    is refused, not skipped.
    """
    pieces = spark.read.option("lineSep", '"Feature"').text(path)
    value = F.col("value")
    # A piece ends where the next type value starts, or closes the file.
    ends = value.rlike(r'"type"\s*:\s*$') | value.rlike(r"[\]}]\s*$") | (F.trim("value") == "")
    opening = value.rlike(r"^\s*[\uFEFF]?\s*[\[{]") | (F.trim("value") == "")
    feature = F.concat(F.lit('{"type":"Feature"'), value)
    body = F.from_json(feature, "struct<properties:string,geometry:string>")
    fits = value.rlike(r"^\s*[,}]") & ends & (body["properties"].isNotNull() | body["geometry"].isNotNull())
    refuse = F.raise_error(F.lit(f"{path}: a feature does not start with its type"))
    checked = F.when(opening & ends, F.lit(None).cast("string")).when(fits, F.to_json(body)).otherwise(refuse)
    return features(pieces.select(checked.alias("feature")).filter("feature is not null"), "feature", properties, lists)


def features(df: DataFrame, column: str, properties: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """Feature texts to columns."""
    body = F.from_json(F.col(column), "struct<properties:string,geometry:string>")
    parsed = df.withColumn("_f", body)
    # Nested JSON kept as text may arrive quoted once more; get_json_object reads both.
    props, shape = F.col("_f")["properties"], F.col("_f")["geometry"]
    kind = F.get_json_object(shape, "$.type")
    coords = F.get_json_object(shape, "$.coordinates")
    spot = F.when(kind == "Point", F.from_json(coords, "array<double>"))

    def prop(name: str) -> Column:
        text = F.get_json_object(props, f"$.{name}")
        return (F.from_json(text, "array<string>") if name in lists else text).alias(name)

    return parsed.select(
        *[prop(p) for p in properties],
        geo.from_geojson(kind, coords).alias("geometry"),
        F.get(spot, F.lit(0)).alias("x"),
        F.get(spot, F.lit(1)).alias("y"),
    )


def read_after_preamble(
    spark: SparkSession, path: str, skip: int, columns: Sequence[str] | None = None, sep: str = ","
) -> DataFrame:
    """Delimited text whose header stands on line ``skip`` (0-based) of each file.

    A task reads the block of a file in order, so the lines up to the header are dropped while
    the first block streams by; later blocks pass whole. Each file's own header names its values,
    whatever their order; a column that a file lacks is NULL there. Given ``columns`` name the
    values by position instead, and headers are not looked at.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )

    def body(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            place = batch.groupby("file").cumcount() + batch["file"].map(lambda f: seen.get(f, 0))
            for file, n in batch["file"].value_counts().items():
                seen[file] = seen.get(file, 0) + int(n)
            header = (batch["block"] == 0) & (place == skip)
            kept = header | (((batch["block"] > 0) | (place > skip)) & (batch["value"].str.strip() != ""))
            yield batch.loc[kept, ["file", "value"]].assign(header=header[kept])

    kept = lines.mapInPandas(body, "file string, value string, header boolean")
    data = kept.filter("not header")
    if columns is not None:
        schema = ", ".join(f"`{c}` string" for c in columns)
        return data.select(F.from_csv("value", schema, {"sep": sep}).alias("r")).select("r.*")
    names = F.transform(F.split("value", re.escape(sep)), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    heads = kept.filter("header").select(F.col("file").alias("_file"), names.alias("_names"))
    shapes = heads.groupBy("_names").agg(F.min("_file").alias("first")).orderBy("first").collect()
    if not shapes:
        raise ValueError(f"{path}: no header on line {skip}")
    # One header per kind of file comes to the driver.
    columns = list(dict.fromkeys(c for s in shapes for c in s["_names"]))
    width = max(len(s["_names"]) for s in shapes)
    schema = ", ".join(f"`{i}` string" for i in range(width))
    values = F.array(*[F.col(f"_row.`{i}`") for i in range(width)])
    named = data.join(heads, data["file"] == F.col("_file")).withColumn("_row", F.from_csv("value", schema, {"sep": sep}))
    at = lambda c: F.array_position("_names", c).cast("int") - 1
    return named.select(*[F.when(at(c) >= 0, F.get(values, at(c))).alias(c) for c in columns])


def query(spark: SparkSession, sql: str, params: Sequence | Mapping | None = None, limit: int | None = None) -> DataFrame:
    """SQL text with bound parameters; ``limit`` caps the rows only where a caller asks."""
    df = spark.sql(sql, args=params) if params else spark.sql(sql)
    return df if limit is None else df.limit(limit)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a stored table, ascending. A version counts once its job committed."""
    fs, root = _filesystem(spark, path)
    if not fs.exists(root):
        return []
    jvm = spark.sparkContext._jvm
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("version=") and fs.exists(done):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored table, at its newest or a given version."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{path}: version {version if version is not None else 'any'} not found")
    return spark.read.parquet(f"{path}/version={known[-1] if version is None else version}")
