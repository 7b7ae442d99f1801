"""Unions, key spines and membership."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All key values that occur anywhere: one union, one distinct."""
    return union_all([f.select(*keys) for f in frames]).distinct()


def unused_values(
    spark: SparkSession, domain: Sequence[str], df: DataFrame, column: str
) -> DataFrame:
    """Members of a fixed domain that a column never takes."""
    listed = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in domain])).alias(column))
    return listed.join(df.select(column).distinct(), column, "left_anti")


def membership(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Distinct keys of several sets with one flag per set."""
    tagged = union_all(
        [f.select(key, F.lit(name).alias("_set")) for name, f in frames.items()]
    )
    return tagged.groupBy(key).agg(
        *[F.bool_or(F.col("_set") == name).alias(name) for name in frames]
    )
