"""Analytics on a name column."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import lookup, round_sql, tiers
from cadastra.operators.aggregates import (
    describe, frequency, members_of_top_groups, pattern_tally, token_counts, top,
)
from cadastra.operators.sets import unused_values
from cadastra.operators.windows import share_of_total
from cadastra.plans.constants import NAME_QUALIFIERS, STOPWORDS

SAINT = r"^Saint[- ](.+?)(?:$|[- ])"


def length_distribution(df: DataFrame, name: str = "name") -> DataFrame:
    return frequency(df, {"name_length": F.length(name)})


def letter_distribution(df: DataFrame, name: str = "name") -> DataFrame:
    """Counts by number of letters (blanks, hyphens and apostrophes not counted)."""
    return frequency(df, {"letters": F.length(F.regexp_replace(name, r"\P{L}", ""))})


def length_stats(df: DataFrame, name: str = "name") -> DataFrame:
    """Shortest, mean, median and longest length; the median is rounded half to even."""
    stats = describe(df, [], F.length(name))
    return stats.select(
        F.col("min_value").alias("min_len"),
        F.col("avg_value").alias("avg_len"),
        F.bround("median_value", 0).cast("int").alias("med_len"),
        F.col("max_value").alias("max_len"),
    )


def extreme_names(df: DataFrame, k: int = 5, longest: bool = True, name: str = "name") -> DataFrame:
    size = F.length(name)
    rows = df.select(F.col(name), size.alias("len"))
    return top(rows, k, F.col("len").desc() if longest else F.col("len").asc(), F.col(name).asc())


def length_bins(df: DataFrame, edges: list[int], name: str = "name") -> DataFrame:
    """Names per length bin ``(lo, hi]``."""
    steps = [(hi, f"{lo + 1}-{hi}") for lo, hi in zip([0, *edges], edges)]
    label = tiers(F.length(name), steps, f"{edges[-1] + 1}+", closed="right", missing="unknown")
    return frequency(df, {"bin": label})


def repeated_names(df: DataFrame, at_least: int = 2, name: str = "name") -> DataFrame:
    return frequency(df, {"name": F.col(name)}, at_least)


def common_words(df: DataFrame, k: int | None = 15, name: str = "name") -> DataFrame:
    return token_counts(df, F.col(name), STOPWORDS, k)


def patron_saints(df: DataFrame, k: int = 10, name: str = "name") -> DataFrame:
    col = F.col(name)
    saint = F.trim(F.regexp_extract(col, SAINT, 1))
    named = df.filter(col.like("Saint-%") | col.like("Saint %")).select(saint.alias("saint_name"))
    kept = named.filter(~F.lower("saint_name").isin(STOPWORDS))
    return top(frequency(kept, {"saint_name": F.col("saint_name")}), k, F.desc("n"), F.asc("saint_name"))


def qualifiers(df: DataFrame, words: dict[str, str] = NAME_QUALIFIERS, name: str = "name") -> DataFrame:
    """Names that hold each word in their middle, with its meaning."""
    tally = pattern_tally(df, F.col(name), {w: f"-{w}-| {w} " for w in words})
    return tally.select(
        F.col("label").alias("qualifier"), lookup(F.col("label"), words).alias("meaning"), F.col("n")
    )


def first_letter(name: Column) -> Column:
    return F.upper(F.left(name, F.lit(1)))


def first_letters(df: DataFrame, name: str = "name") -> DataFrame:
    counted = frequency(df, {"letter": first_letter(F.col(name))})
    return share_of_total(counted, "n", "percentage")


def missing_letters(df: DataFrame, name: str = "name") -> DataFrame:
    used = df.select(first_letter(F.col(name)).alias("letter")).filter("letter is not null")
    return unused_values(df.sparkSession, list(string.ascii_uppercase), used, "letter")


def group_lengths(df: DataFrame, group: str, name: str = "name") -> DataFrame:
    return describe(df, [group], F.length(name))


def lengths_in_top_groups(df: DataFrame, group: str, k: int = 12, name: str = "name") -> DataFrame:
    """Name lengths of the groups with the longest mean name."""
    size = F.length(name)
    rows = members_of_top_groups(df, group, round_sql(F.avg(size), 1), k)
    return rows.select(group, size.alias("len"))
