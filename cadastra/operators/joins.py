"""Join shapes: prior period, intervals, mapped values, set membership."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.skew import skew_join


def prior_period(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    columns: Sequence[str],
    prefix: str = "prev_",
    step: int = 1,
) -> DataFrame:
    """Values of the period exactly ``step`` before, NULL across a gap.

    ``(keys, period)`` must be unique; then the row before in order is the only candidate, and
    one window replaces a self join with its second scan and shuffle.
    """
    before = F.lag(F.struct(F.col(period), *[F.col(c) for c in columns])).over(
        Window.partitionBy(*keys).orderBy(period)
    )
    held = df.withColumn("_before", before)
    follows = F.col(period) - F.col("_before")[period] == step
    return held.select(
        *df.columns,
        *[F.when(follows, F.col("_before")[c]).alias(prefix + c) for c in columns],
    )


def left_join_all(spine: DataFrame, keys: Sequence[str], parts: Sequence[DataFrame]) -> DataFrame:
    """Widen a key spine by several tables that are unique on the keys. All joins share the
    key, so Spark reuses one partitioning of the spine."""
    return reduce(lambda acc, part: acc.join(part, list(keys), "left"), parts, spine)


# Days are numbered from a day before all dates, in 2 ** DAY_BITS numbers.
DAY_BITS = 23


def _day(value: Column) -> Column:
    return F.unix_date(value.cast("date")) + F.lit(1 << (DAY_BITS - 1))


def dyadic_nodes(first: Column, end: Column) -> Column:
    """The numbers from ``first`` up to ``end`` (not included) as an array of (level, node), of which
    each stands for the 2 ** level numbers from node * 2 ** level on: at most two of a level, so at most
    2 * DAY_BITS however long the span. Empty for an empty span or a NULL end."""

    def of(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("bigint")
        low, high = F.ceil(first / size).cast("bigint"), F.floor(end / size).cast("bigint")
        node = lambda wanted, n: F.when(wanted, F.struct(level.alias("level"), n.alias("node")))
        return F.array(
            node((low < high) & (low % 2 == 1), low), node((low < high) & (high % 2 == 1), high - 1)
        )

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(DAY_BITS)), of))
    return F.filter(every, lambda n: n.isNotNull())


def interval_join(
    facts: DataFrame,
    intervals: DataFrame,
    at: str,
    columns: Sequence[str],
    *,
    start: str = "start_date",
    end: str = "end_date",
    spread: Sequence[str] | None = None,
    sketch: DataFrame | None = None,
) -> DataFrame:
    """Left join of dates to half-open intervals ``[start, end)``; an open end lasts on.

    The facts are folded to their distinct dates first. An interval is listed once per dyadic node of
    its days, a few dozen rows even if it never ends; a date looks up the one node of each level that
    holds it, so no match repeats, and dates in several intervals keep all matches. The facts then
    join on the date, with crowded dates salted. ``sketch`` may name a table with the same dates that is
    cheaper to read than ``facts``.
    """
    source = facts if sketch is None else sketch
    points = source.select(F.col(at).alias("_at")).filter("_at is not null").distinct()
    low, high = F.col(start), F.col(end)
    # A day on which an interval ends at a later hour is part of it.
    stop = F.when(high.isNull(), F.lit(1 << DAY_BITS)).otherwise(_day(high) + (high > high.cast("date")).cast("int"))
    listed = intervals.filter(low.isNotNull() & (high.isNull() | (high > low))).select(
        low.alias("_start"), high.alias("_end"), *columns, F.inline(dyadic_nodes(_day(low), stop))
    )
    ladder = F.transform(
        F.sequence(F.lit(0), F.lit(DAY_BITS)),
        lambda level: F.struct(
            level.alias("level"), F.floor(_day(F.col("_at")) / F.pow(F.lit(2), level)).cast("bigint").alias("node")
        ),
    )
    inside = (F.col("_at") >= F.col("_start")) & (F.col("_end").isNull() | (F.col("_at") < F.col("_end")))
    holding = (
        points.select("_at", F.inline(ladder)).join(listed, ["level", "node"])
        .filter(inside).select(F.col("_at").alias(at), *columns)
    )
    return skew_join(facts, holding, [at], "left", spread=spread, sketch=sketch)


def mapped_join(
    df: DataFrame, column: str, mapping: Mapping[str, str], right: DataFrame, right_key: str
) -> DataFrame:
    """Inner join through a literal map of column value to right key. The map is an expression,
    so only the lookup into ``right`` is a join; at most the mapped keys of it take part."""
    from cadastra.functions.columns import lookup

    keyed = df.withColumn("_mapped", lookup(F.col(column), mapping)).filter("_mapped is not null")
    wanted = right.filter(F.col(right_key).isin(sorted(set(mapping.values()))))
    renamed = wanted.withColumnRenamed(right_key, "_mapped")
    return skew_join(keyed, renamed, ["_mapped"], "inner").drop("_mapped")


def not_in(
    df: DataFrame, column: str, values: DataFrame, value: str, *, null_aware: bool = False
) -> DataFrame:
    """Rows whose value is absent from ``values``. With ``null_aware`` a NULL among the values
    makes the result empty and a NULL on the left is dropped, as SQL ``NOT IN`` has it; without,
    NULLs among the values are ignored.

    Written as an anti join on distinct values: the null-aware form Spark plans for ``NOT IN``
    would broadcast the whole value list.
    """
    known = values.select(F.col(value).alias(column)).filter(F.col(column).isNotNull()).distinct()
    rest = skew_join(df.filter(F.col(column).isNotNull()), known, [column], "left_anti")
    if null_aware:
        has_null = values.agg(F.max(F.col(value).isNull())).scalar()
        rest = rest.filter(~F.coalesce(has_null, F.lit(False)))
    return rest


def requested_keys(
    requested: DataFrame, dimension: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Split requested keys into those the dimension has and those it misses."""
    known = dimension.select(key).distinct()
    return skew_join(requested, known, [key], "left_semi"), skew_join(requested, known, [key], "left_anti")


def attach_scalars(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the columns of a one-row relation to every row, as scalar subqueries."""
    return df.select(
        "*", *[stats.select(F.max(F.col(c))).scalar().alias(c) for c in stats.columns]
    )


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key; the last in ``order`` wins, as when a dict is filled row by row."""
    from cadastra.operators.windows import latest_per_key

    return latest_per_key(df, [key], [F.col(order).desc()])
