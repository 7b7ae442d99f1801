"""Joins that hold when one key has a large share of the rows.

A plain shuffle join sends every row of a key to one task. Here a sketch of the most frequent keys is
taken first: Spark's frequent-item counters, a bounded number of them for each map task, merged in two
small steps. Nothing that grows with the number of keys is shuffled. A key with more than a fair task's
share, 1 / shuffle partitions, is heavy: its left rows are spread over as many salts as fair tasks it
would fill, and only its right rows are repeated, that many times. All other keys travel as in a plain
join. The sketch is part of the query itself, so nothing runs while it is planned, and the path is the
same at every size. The result does not depend on which keys are heavy.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.session import shuffle_partitions


# Keys a sketch tracks for each fair task, and what it may count too high, in fair shares (the
# sketch's bound is 3.5 / its size, and its size is at least 4 / 3 of the tracked keys).
TRACKED = 8
SKETCH_ERROR = 0.33
# Most keys Spark's sketch can track, and report. Beyond 50,000 tasks the error grows in proportion.
MOST_TRACKED = 1_000_000
MOST_KEYS = 100_000


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """(_hash, _salts) of the keys that hold more than 1/``tasks`` of the rows (default: shuffle
    partitions); _salts is their share in fair tasks.

    A sketch counts a key too high by at most ``SKETCH_ERROR`` fair shares, and that much is taken off
    before the share is rounded up: a key may get one salt less than its exact share, and one of up to
    ``1 + SKETCH_ERROR`` shares may stay whole. Fewer than 2 * ``tasks`` rows, whatever the data, so it
    may be broadcast.
    """
    tasks = tasks or shuffle_partitions(df.sparkSession)
    tracked = min(TRACKED * tasks, MOST_TRACKED)
    # Sketches of some map tasks each are merged before the last step.
    some = F.pmod(F.spark_partition_id(), F.lit(math.isqrt(tasks) + 1)).alias("_some")
    taken = df.groupBy(some).agg(
        F.call_function("approx_top_k_accumulate", key_hash(keys), F.lit(tracked)).alias("_sketch"),
        F.count("*").alias("_rows"),
    )
    # Grouped, since a merge of no sketches has no value.
    merged = taken.groupBy(F.lit(0).alias("_all")).agg(
        F.call_function("approx_top_k_combine", F.col("_sketch"), F.lit(tracked)).alias("_sketch"),
        F.sum("_rows").alias("_rows"),
    )
    most = F.call_function("approx_top_k_estimate", F.col("_sketch"), F.lit(min(2 * tasks, MOST_KEYS, tracked)))
    top = merged.select("_rows", F.explode(most).alias("_top"))
    share = F.col("_top.count") * F.lit(float(tasks)) / F.col("_rows")
    salts = F.ceil(share - SKETCH_ERROR).cast("int")
    return top.select(F.col("_top.item").alias("_hash"), salts.alias("_salts")).filter("_salts > 1")


def with_salts(df: DataFrame, keys: Sequence[str], heavy: DataFrame) -> DataFrame:
    """Add ``_salts`` to the rows of heavy keys, NULL to all others."""
    return df.withColumn("_hash", key_hash(keys)).join(F.broadcast(heavy), "_hash", "left").drop("_hash")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    spread: Sequence[str] | None = None,
    condition: Callable[[], Column] | None = None,
    sketch: DataFrame | None = None,
    null_safe: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Equi join on ``keys`` with the heavy left keys spread over several tasks.

    ``how`` is inner, left, left_semi or left_anti. ``spread`` names left columns that tell
    rows of one key apart (default: all of them); the salt is a hash of them and so stays the
    same when a task runs again. ``condition`` adds a non-equi test on the other columns.

    Frequent keys are looked for in ``sketch`` (default: the left side). Pass a table that is cheap to
    read when the left side is the end of a long plan. ``tasks`` stands for the number of shuffle
    partitions. With ``null_safe`` NULL keys match each other.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if condition is not None:
        shared = (set(left.columns) & set(right.columns)) - set(keys)
        if shared:
            raise ValueError(f"columns on both sides: {sorted(shared)}")
    on = list(keys)
    heavy = heavy_keys(left if sketch is None else sketch, keys, tasks)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread or left.columns]), F.coalesce("_salts", F.lit(1)))
    left = with_salts(left, keys, heavy).withColumn("_salt", salt.cast("int")).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = with_salts(right, keys, heavy).withColumn("_salt", F.explode(every)).drop("_salts")
    on.append("_salt")
    if condition is None and not null_safe:
        return left.join(right, on, how).drop("_salt")
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns]
    )
    test = F.lit(True) if condition is None else condition()
    for key in on:
        mine, theirs = F.col(key), F.col(f"_r_{key}")
        test = (mine.eqNullSafe(theirs) if null_safe else mine == theirs) & test
    return left.join(renamed, test, how).drop("_salt", *[f"_r_{c}" for c in on])
