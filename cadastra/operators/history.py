"""Type-2 history: merge a new delivery, read the current, past or full state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_END = "9999-12-31"
PREFIX = T.StructType(
    [
        T.StructField("surrogate_key", T.StringType()),
        T.StructField("effective_date", T.DateType()),
        T.StructField("expiry_date", T.DateType()),
        T.StructField("is_current", T.BooleanType()),
        T.StructField("inserted_at", T.TimestampType()),
    ]
)


def empty_history(spark: SparkSession, business: T.StructType) -> DataFrame:
    """The table before its first load: history columns and the business columns."""
    return spark.createDataFrame([], T.StructType([*PREFIX.fields, *business.fields]))


def business_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Columns whose change opens a new version."""
    skip = {f.name for f in PREFIX.fields} | set(keys)
    return [c for c in df.columns if c not in skip]


def stored_geometry(df: DataFrame, srid: int = 4326) -> DataFrame:
    """Replace each geometry column by its binary form and reference system, as history tables
    keep it. Geometries are recognised by their type, points by their ``x`` and ``y``."""
    from cadastra.functions import geo, wkb

    columns: list[Column] = []
    for name, kind in df.dtypes:
        if kind == geo.GEOMETRY:
            binary = wkb.to_wkb(F.col(name))
        elif kind == "struct<x:double,y:double>":
            binary = wkb.point_wkb(F.col(name).x, F.col(name).y)
        else:
            columns.append(F.col(name))
            continue
        columns += [binary.alias(f"{name}_wkb"), F.lit(srid).alias(f"{name}_srid")]
    return df.select(*columns)


def check_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key is NULL or occurs twice: either would leave several current rows."""
    null = df.filter(~F.array_min(F.array(*[F.col(k).isNotNull() for k in keys])))
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    if not null.isEmpty():
        raise ValueError(f"NULL in key {list(keys)}")
    if not twice.isEmpty():
        raise ValueError(f"duplicate key {list(keys)}")


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    as_of: str | Column,
    loaded_at: str | Column,
    tracked: Sequence[str] | None = None,
) -> DataFrame:
    """The whole history after loading ``incoming``, as one plan.

    Current rows meet incoming ones in a full outer join on the complete key. Gone or changed
    rows are closed at ``as_of``; new or changed ones open. Versions are compared field by field
    and NULL-safe, so a value that moves between two columns counts as a change. Dates are
    parameters, and the surrogate key is derived from key and date: a repeated task writes the
    same rows.
    """
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    now = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at).cast("timestamp")
    keys = list(keys)
    columns = [*keys, *business_columns(incoming, keys)]
    compared = list(tracked) if tracked is not None else columns[len(keys):]
    prefix = [f.name for f in PREFIX.fields]

    open_rows = history.filter("is_current").select(
        *keys, F.struct(*prefix, *columns).alias("old")
    )
    fresh = incoming.select(*keys, F.struct(*columns).alias("new"))
    met = open_rows.join(fresh, keys, "full")
    old, new = F.col("old"), F.col("new")

    same = F.lit(True)
    for c in compared:
        same = same & old[c].eqNullSafe(new[c])
    gone = old.isNotNull() & new.isNull()
    changed = old.isNotNull() & new.isNotNull() & ~same
    added = old.isNull() & new.isNotNull()

    def version(source: Column, meta: list[Column]) -> Column:
        return F.struct(
            *[m.alias(n) for m, n in zip(meta, prefix)], *[source[c].alias(c) for c in columns]
        )

    keep = version(old, [old[p] for p in prefix])
    closed = version(
        old,
        [old["surrogate_key"], old["effective_date"], day, F.lit(False), old["inserted_at"]],
    )
    surrogate = F.md5(
        F.concat_ws("|", *[new[k].cast("string") for k in keys], day.cast("string"))
    )
    opened = version(
        new,
        [surrogate, day, F.lit(OPEN_END).cast("date"), F.lit(True), now.cast("timestamp")],
    )
    rows = F.when(added, F.array(opened)).when(changed, F.array(closed, opened)).when(
        gone, F.array(closed)
    ).otherwise(F.array(keep))
    merged = met.select(F.inline(rows))
    past = history.filter(~F.col("is_current")).select(*prefix, *columns)
    return past.unionByName(merged)


def merge_counts(history: DataFrame, merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a merge adds to the table (what a load reports)."""
    before = history.agg(F.count("*")).scalar()
    return merged.agg(F.count("*").alias("n")).select((F.col("n") - before).alias("inserted"))


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current"))


def as_of(df: DataFrame, day: str | Column) -> DataFrame:
    """The versions valid on a day."""
    at = day if isinstance(day, Column) else F.lit(day).cast("date")
    return df.filter((F.col("effective_date") <= at) & (at < F.col("expiry_date")))


def versions_of(df: DataFrame, **key: object) -> DataFrame:
    """All versions of one key, oldest first."""
    for column, value in key.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df.orderBy("effective_date")
