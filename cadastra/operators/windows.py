"""Window results that stay correct and spread out when one key holds many rows.

A window puts a whole key into one task. Where only the first row matters, the ranking is cut to
one row per key before the shuffle. Where every row needs the state before it, the table is cut
into even ranges of (key, order), however few keys there are: a window scans each range by itself, and
one row per range carries its end into the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.columns import round_sql
from cadastra.operators.skew import skew_join
from cadastra.session import pin, shuffle_partitions


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], where: Column | None = None
) -> DataFrame:
    """First row of each key in ``order``. Spark cuts every map task to one row per key
    ahead of the exchange (window group limit), so a heavy key is not collected."""
    rows = df if where is None else df.filter(where)
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")


def flag_extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    *,
    last: bool = False,
    sketch: DataFrame | None = None,
) -> DataFrame:
    """Mark the first (or last) row of each key. ``order`` must tell the rows of a key apart.

    The extreme is found by a partial aggregate and joined back, instead of ranking every row
    of a key in one task.
    """
    pick = F.max if last else F.min
    rank = F.struct(*[F.col(c) for c in order])
    best = df.groupBy(*keys).agg(pick(rank).alias("_best"))
    joined = skew_join(df, best, keys, "left", spread=[*keys, *order], sketch=sketch, null_safe=True)
    return joined.withColumn(name, rank == F.col("_best")).drop("_best")


def surrogate_id(
    df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None
) -> DataFrame:
    """Dense 1-based number over the whole table in ``order`` (which must be unique).

    The table is range-partitioned and sorted inside each partition; the offset of a partition
    is the count of the ones before it. The ranges are pinned to the checkpoint folder first, so
    that counts and rows agree even if a task is repeated.
    """
    spark = df.sparkSession
    parts = partitions or shuffle_partitions(spark)
    ranged = pin(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright(F.col("_at"), 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # At most one row per partition, so the running sum and the broadcast are bounded.
    offsets = sizes.withColumn(
        "_before",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_part", "_before")
    row = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_before") + row + 1).alias(name), *df.columns)


def _ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows as they lie, the same rows with each range in a task of its own), with ``_part``, the number
    of the range of (keys, order). Stored first, so that both see the same ranges even if a task is
    repeated."""
    parts = shuffle_partitions(df.sparkSession)
    stored = pin(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    return stored, stored.repartitionById(parts, F.col("_part"))


def _same_key(keys: Sequence[str], other: Column) -> Column:
    """NULL keys form a group of their own, as in a window."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(other[k])
    return same


def previous_state(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], prefix: str = "previous_"
) -> DataFrame:
    """Values of ``columns`` in the row before, per key in ``order`` (which needs a tiebreak)."""
    key = F.struct(*[F.col(c) for c in keys])
    state = F.struct(*[F.col(c) for c in columns])
    rank = F.struct(*[F.col(c) for c in [*keys, *order]])
    stored, rows = _ranges(df, keys, order)
    # The row before the first of a range is the last of the range before: one row per range.
    ends = stored.groupBy("_part").agg(F.max_by(F.struct(key.alias("key"), state.alias("state")), rank).alias("_end"))
    carried = ends.select("_part", F.lag("_end").over(Window.orderBy("_part")).alias("_carried"))
    local = F.lag(state).over(Window.partitionBy("_part", *keys).orderBy(*order))
    joined = rows.withColumn("_local", local).join(F.broadcast(carried), "_part", "left")
    inherited = F.when(_same_key(keys, F.col("_carried.key")), F.col("_carried.state"))
    before = F.coalesce(F.col("_local"), inherited)
    return joined.select(*df.columns, *[before[c].alias(prefix + c) for c in columns])


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str
) -> DataFrame:
    """Last non-NULL value of ``column`` up to and including each row, per key in ``order``."""
    key = F.struct(*[F.col(c) for c in keys])
    rank = F.struct(*[F.col(c) for c in [*keys, *order]])
    stored, rows = _ranges(df, keys, order)
    known = F.col(column).isNotNull()
    upto = Window.unboundedPreceding
    # Two rows per range: the key it begins with asks, the key it ends with answers later ranges.
    sides = stored.groupBy("_part").agg(
        F.min_by(key, rank).alias("_first"),
        F.max_by(key, rank).alias("_last"),
        F.max_by(F.when(known, F.struct(key.alias("key"), F.col(column).alias("value"))), F.when(known, rank)).alias("_known"),
    )
    value = F.when(F.col("_known.key").eqNullSafe(F.col("_last")), F.col("_known.value"))
    turns = sides.select("_part", F.inline(F.array(
        F.struct(F.col("_first").alias("_key"), F.lit(0).alias("_turn"), F.nullif(value, value).alias("_value")),
        F.struct(F.col("_last").alias("_key"), F.lit(1).alias("_turn"), value.alias("_value")),
    )))
    earlier = Window.partitionBy("_key").orderBy("_part", "_turn").rowsBetween(upto, -1)
    answers = turns.withColumn("_carried", F.last("_value", ignorenulls=True).over(earlier)).filter("_turn = 0")
    local = F.last(column, ignorenulls=True).over(
        Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(upto, 0)
    )
    carried = answers.select("_part", "_key", "_carried")
    joined = rows.withColumn("_local", local).join(F.broadcast(carried), "_part", "left")
    inherited = F.when(_same_key(keys, F.col("_key")), F.col("_carried"))
    return joined.select(*df.columns, F.coalesce(F.col("_local"), inherited).alias(name))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column,
    order: Sequence[str],
    column: str,
    name: str,
) -> DataFrame:
    """Sum of ``column`` up to and including each row, per key in ``chunk`` then ``order``; ``chunk``
    must grow with the order, and holds few rows. A second window runs over the chunks' sums only."""
    rows = df.withColumn("_chunk", chunk)
    upto = Window.unboundedPreceding
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(upto, 0)
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum(column).alias("_total"))
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(upto, -1)
    carried = totals.select(*keys, "_chunk", F.sum("_total").over(over_chunks).alias("_carried"))
    # One row per key and chunk on the right; NULL keys form a group of their own, as in a window.
    on = [*keys, "_chunk"]
    renamed = carried.select(*[F.col(c).alias(f"_r_{c}") for c in on], "_carried")
    same = F.lit(True)
    for c in on:
        same = F.col(c).eqNullSafe(F.col(f"_r_{c}")) & same
    joined = rows.withColumn("_local", F.sum(column).over(inside)).join(renamed, same, "left")
    return joined.select(
        *df.columns, (F.col("_local") + F.coalesce(F.col("_carried"), F.lit(0))).alias(name)
    )


def share_of_total(df: DataFrame, column: str, name: str, decimals: int = 1) -> DataFrame:
    """Percent of the column total per row. The total is a scalar subquery: a one-row aggregate,
    not a window over an unpartitioned table."""
    total = df.agg(F.sum(column)).scalar().cast("double")
    return df.withColumn(name, round_sql(F.col(column) * F.lit(100.0) / total, decimals))
