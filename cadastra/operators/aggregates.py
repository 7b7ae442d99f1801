"""Aggregations: conditional pivots, distinct buckets, benchmarks, medians, reports.

Every one is a partial aggregate first, so a heavy group reaches the shuffle as one row per
map task (or per distinct member where distinct members count).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.columns import round_even, round_sql
from cadastra.operators.skew import skew_join
from cadastra.operators.windows import latest_per_key, running_sum


def pivot_when(
    df: DataFrame,
    keys: Sequence[str],
    cells: Mapping[str, tuple[Column, Column]],
    how: str = "max",
) -> DataFrame:
    """Long to wide: each output column aggregates a value over the rows meeting a condition.
    NULL (not 0) where no row does."""
    fold = {"max": F.max, "sum": F.sum}[how]
    return df.groupBy(*keys).agg(
        *[fold(F.when(cond, value)).alias(name) for name, (cond, value) in cells.items()]
    )


def distinct_buckets(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    buckets: Mapping[str, Column],
    total: str,
    traits: DataFrame | None = None,
    by_trait: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct entities per key in total and per condition.

    Rows are first folded to one per (key, entity) with a flag for every condition; counting
    flags then needs no distinct aggregate, whose many-column form multiplies all rows. Conditions
    of ``by_trait`` are on ``traits``, rows of further columns by entity. They are folded to one row per
    entity and joined to the folded rows, which so need no second fold; to an entity without a row
    the columns are NULL.
    """
    flag = lambda c: F.when(c, 1).otherwise(0)
    members = (
        df.filter(F.col(entity).isNotNull())
        .groupBy(*keys, entity)
        .agg(*[F.max(flag(c)).alias(name) for name, c in buckets.items()])
    )
    by_trait = by_trait or {}
    if traits is not None:
        known = traits.groupBy(entity).agg(*[F.max(flag(c)).alias(name) for name, c in by_trait.items()])
        blank = {f.name: F.lit(None).cast(f.dataType) for f in traits.schema.fields if f.name != entity}
        joined = members.join(known, entity, "left").select(*keys, *buckets, *by_trait, *[c.alias(n) for n, c in blank.items()])
        members = joined.select(
            *keys, *buckets, *[F.coalesce(F.col(name), flag(c)).alias(name) for name, c in by_trait.items()]
        )
    return members.groupBy(*keys).agg(
        F.count("*").alias(total),
        *[F.sum(name).cast("bigint").alias(name) for name in [*buckets, *by_trait]],
    )


def reconcile(frames: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """One value per key from overlapping sources: the highest."""
    stacked = reduce(lambda a, b: a.unionByName(b), [f.select(*keys, value) for f in frames])
    return stacked.groupBy(*keys).agg(F.max(value).alias(value))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key in a stated order."""
    return latest_per_key(df, keys, order)


def group_benchmark(
    df: DataFrame,
    groups: Sequence[str],
    averages: Mapping[str, str],
    sketch: DataFrame | None = None,
) -> DataFrame:
    """Add group averages (name -> column) to every row, for all groups in one pass. Heavy groups
    are looked for in ``sketch`` (default ``df``)."""
    stats = df.groupBy(*groups).agg(
        *[
            (F.sum(F.col(c).cast("decimal(38,6)")).cast("double") / F.nullif(F.count(c), F.lit(0))).alias(n)
            for n, c in averages.items()
        ]
    )
    return skew_join(df, stats, groups, "left", sketch=sketch)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact median per key (mean of the two middle values for an even count).

    A sketch brackets the middle within 0.2 % of the ranks. Rows below the bracket are only
    counted; the few inside are folded to value counts and ranked by a chunked running sum.
    """
    if not keys:
        # One key for all rows, but no literal: a join on a literal would be planned as a nested loop.
        whole = df.select(F.xxhash64(value).bitwiseAND(F.lit(0)).alias("_all"), value)
        return exact_median(whole, ["_all"], value, name).drop("_all")
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    bracket = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", [0.499, 0.501], 10000).alias("_b"),
    )
    # Copies of a value fold first; what is left of a heavy key differs in value and can be salted.
    counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    held = skew_join(counted, bracket, keys, "inner", spread=[*keys, "_v"], sketch=rows)
    below = F.col("_v") < F.col("_b")[0]
    within = F.col("_v").between(F.col("_b")[0], F.col("_b")[1])
    # Values outside the bracket fold into one row per key, so counts and candidates come
    # from a single aggregate.
    folded = (
        held.filter(below | within)
        .groupBy(*keys, F.when(within, F.col("_v")).alias("_v"))
        .agg(F.sum("_c").alias("_c"), F.first("_n").alias("_n"), F.first("_b").alias("_b"))
    )
    span = F.nullif(F.col("_b")[1] - F.col("_b")[0], F.lit(0.0))
    chunk = F.when(F.col("_v").isNull(), F.lit(-1)).otherwise(
        F.coalesce(F.floor((F.col("_v") - F.col("_b")[0]) / span * 255), F.lit(0)).cast("int")
    )
    ranked = running_sum(folded, keys, chunk, ["_v"], "_c", "_upto")
    first, last = F.col("_upto") - F.col("_c") + 1, F.col("_upto")
    low = F.floor((F.col("_n") + 1) / 2)
    high = F.floor(F.col("_n") / 2) + 1
    return (
        ranked.filter("_v is not null")
        .groupBy(*keys)
        .agg(
            (
                (
                    F.max(F.when(low.between(first, last), F.col("_v")))
                    + F.max(F.when(high.between(first, last), F.col("_v")))
                )
                / 2
            ).alias(name)
        )
    )


def frequency(df: DataFrame, by: Mapping[str, Column], at_least: int = 1) -> DataFrame:
    """Counts per derived value, optionally only those reaching a minimum."""
    counted = df.groupBy(*[c.alias(n) for n, c in by.items()]).agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= at_least) if at_least > 1 else counted


def describe(df: DataFrame, keys: Sequence[str], value: Column, decimals: int = 1) -> DataFrame:
    """Count, min, mean, median, max and sample deviation of a small-domain value (a length, an
    age): the value counts are bounded, so the exact percentile over them is cheap."""
    counts = df.groupBy(*keys, value.alias("_v")).agg(F.count("*").alias("_c"))
    v, c = F.col("_v"), F.col("_c")
    n = F.sum(F.when(v.isNotNull(), c))
    s1, s2 = F.sum(v * c).cast("double"), F.sum(v * v * c).cast("double")
    variance = F.greatest((s2 - s1 * s1 / n) / F.nullif(n - 1, F.lit(0)), F.lit(0.0))
    return counts.groupBy(*keys).agg(
        F.sum("_c").alias("n"),
        F.min("_v").alias("min_value"),
        round_sql(s1 / n, decimals).alias("avg_value"),
        F.percentile(v, F.lit(0.5), c).alias("median_value"),
        F.max("_v").alias("max_value"),
        round_sql(F.sqrt(variance), decimals).alias("stddev_value"),
    )


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Ordered top-k: each task keeps k rows, the driver merges them."""
    return df.orderBy(*order).limit(k)


def token_counts(df: DataFrame, text: Column, stopwords: Sequence[str], k: int | None = None) -> DataFrame:
    """Words of a name column in title case with their frequency; blanks, hyphens and
    apostrophes separate, single characters and stopwords are left out."""
    words = df.select(F.explode(F.split(F.translate(text, "-'", "  "), " ")).alias("word"))
    kept = words.filter((F.length("word") > 1) & ~F.lower("word").isin(list(stopwords)))
    counted = kept.groupBy(F.initcap(F.lower("word")).alias("word")).agg(F.count("*").alias("n"))
    return top(counted, k, F.desc("n"), F.asc("word")) if k else counted


def pattern_tally(df: DataFrame, text: Column, patterns: Mapping[str, str]) -> DataFrame:
    """Rows matching each pattern, counted in one scan and turned to rows."""
    row = df.agg(
        *[F.count_if(text.rlike(p)).alias(f"c{i}") for i, p in enumerate(patterns.values())]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.col(f"c{i}").alias("n"))
            for i, label in enumerate(patterns)
        ]
    )
    return row.select(F.inline(pairs))


def completeness(df: DataFrame, groups: Sequence[str], done: Column) -> DataFrame:
    """Done and total members of each group, the share in percent, and whether all are done."""
    hit = F.count_if(F.coalesce(done, F.lit(False)))
    return (
        df.groupBy(*groups)
        .agg(hit.alias("n_done"), F.count("*").alias("n_total"))
        .withColumn("pct_done", round_even(F.col("n_done") / F.col("n_total") * 100, 1))
        .withColumn("is_complete", F.col("n_done") == F.col("n_total"))
    )


def badges(kpis: DataFrame, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Turn a one-row KPI frame into the badges earned: (label, metric, minimum)."""
    earned = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.col(metric).cast("double").alias("value"),
                F.lit(float(limit)).alias("minimum"),
            )
            for label, metric, limit in rules
        ]
    )
    return kpis.select(F.inline(earned)).filter("value >= minimum")


def long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    value: str,
    order: str,
    columns: Mapping[str, str],
) -> DataFrame:
    """Measure rows to columns; of repeated measures the last in ``order`` wins. The measures are
    named up front, so Spark does not scan for them."""
    wide = (
        df.groupBy(*keys)
        .pivot(measure, list(columns))
        .agg(F.max_by(F.col(value), F.col(order)))
    )
    return wide.select(*keys, *[F.col(f"`{m}`").alias(c) for m, c in columns.items()])


def members_of_top_groups(
    df: DataFrame, group: str, measure: Column, k: int
) -> DataFrame:
    """Rows of the k groups with the largest measure."""
    best = top(df.groupBy(group).agg(measure.alias("_m")), k, F.desc("_m"), F.asc(group))
    # k rows by construction, so the broadcast is bounded.
    return df.join(F.broadcast(best.select(group)), group, "left_semi")
