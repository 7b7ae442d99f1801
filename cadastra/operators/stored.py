"""Loads into stored tables that read and write only what changes.

The rows of a table are dealt to hash buckets of its key. ``rows/version=N`` holds the buckets that the
load of day N wrote, and is never touched again; ``current/version=N`` lists, after that load, each bucket
with the digest of what was delivered and the load that wrote its open rows. A delivery is digested per
bucket (one pass, combined on the map side); only buckets whose digest differs meet the stored rows. A load
counts once its list is written: one that broke off is invisible, and running it again gives the same
rows. One load at a time may write a table.

Choose ``buckets`` at the first load so that a bucket fits a few tasks; the list has one row for each, and
it is all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.operators import history, loads
from cadastra.session import pin
from cadastra.sources.readers import read_table, versions
from cadastra.sources.writers import create_if_missing

BUCKETS = 64
LIST = "bucket int, load int, blank long, rows long, one decimal(30,0), two decimal(30,0)"
# Partition columns of the stored rows.
PLACE = T.StructType([T.StructField(n, T.IntegerType()) for n in ("version", "_open", "_bucket")])


def _number(day: str) -> int:
    return int(day.replace("-", ""))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The hash bucket of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _digests(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per ``_bucket``: rows, rows with a NULL in the key, and two sums of hashes of ``columns``, which do
    not depend on the order of rows. Hashes leave NULLs out, so each value is told with its presence."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    values = [
        F.to_json(f.name, {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in (rows.schema[c] for c in columns)
    ]
    told = [part for value in values for part in (value, value.isNull())]
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), *told).cast("decimal(20,0)"))
    blank = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda b: b)
    return rows.groupBy("_bucket").agg(
        F.count_if(blank).alias("blank"), F.count("*").alias("rows"), total(1).alias("one"), total(2).alias("two")
    )


def _list(spark: SparkSession, path: str, number: int, buckets: int) -> list[Row]:
    """The bucket list of a load, one row per bucket; before the first load all are empty."""
    if number:
        return read_table(spark, f"{path}/current", number).orderBy("bucket").collect()
    return [Row(bucket=b, load=0, blank=0, rows=0, one=None, two=None) for b in range(buckets)]


def _compare(before: list[Row], delivered: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> dict[int, Row]:
    """The digests of the buckets that differ from the list, by bucket."""
    now = {r["_bucket"]: r for r in _digests(delivered, keys, columns).collect()}
    none = Row(blank=0, rows=0, one=None, two=None)
    told = lambda r: (r["blank"], r["rows"], r["one"], r["two"])
    found = {r["bucket"]: now.get(r["bucket"], none) for r in before}
    # A key with a NULL is never known, so its bucket is always looked at.
    return {r["bucket"]: found[r["bucket"]] for r in before if told(found[r["bucket"]]) != told(r) or r["blank"]}


def _write(rows: DataFrame, path: str, number: int) -> None:
    """Rows with ``_open`` and ``_bucket``; a large bucket is split over tasks, small ones share one."""
    dealt = rows.hint("rebalance", "_open", "_bucket")
    dealt.write.mode("overwrite").partitionBy("_open", "_bucket").parquet(f"{path}/rows/version={number}")


def _commit(spark: SparkSession, path: str, number: int, before: list[Row], changed: dict[int, Row]) -> None:
    lines = []
    for r in before:
        d = changed.get(r["bucket"])
        lines.append(tuple(r) if d is None else (r["bucket"], number, d["blank"], d["rows"], d["one"], d["two"]))
    table = spark.createDataFrame(lines, LIST)
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/current/version={number}")


def _rows(spark: SparkSession, path: str, numbers: Sequence[int]) -> DataFrame:
    """The rows that some loads wrote, with their place; folders are pruned by filters on it."""
    schema = T.StructType([*read_table(spark, f"{path}/schema").schema.fields, *PLACE.fields])
    written = [f"{path}/rows/version={n}" for n in versions(spark, f"{path}/rows") if n in set(numbers)]
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*written)


def _start(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep the columns of a table; a delivery must bring the same ones with the same types."""
    create_if_missing(spark, f"{path}/schema", schema)
    kept = {f.name: f.dataType.simpleString() for f in read_table(spark, f"{path}/schema").schema}
    brought = {f.name: f.dataType.simpleString() for f in schema}
    if kept != brought:
        raise ValueError(f"{path}: columns {sorted(kept.items())} expected, {sorted(brought.items())} delivered")


def _is_open(listed: list[Row]) -> Column:
    """Of the stored open rows, those that the list names."""
    place = [f"{r['load']}/{r['bucket']}" for r in listed if r["rows"]]
    return (F.col("_open") == 1) & F.concat_ws("/", "version", "_bucket").isin(place)


def load_history(
    spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], as_of: str, loaded_at: str,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge a delivery into the stored history at ``path``; returns the buckets it changed. Days of loads
    must go up; NULL or repeated keys are refused. ``buckets`` holds from the first load on."""
    number = _number(as_of)
    known = versions(spark, f"{path}/current")
    if known and number <= known[-1]:
        raise ValueError(f"{path}: a load of {known[-1]} is there, {number} is not after it")
    _start(spark, path, history.empty_history(spark, incoming.schema).schema)
    before = _list(spark, path, known[-1] if known else 0, buckets)
    place = bucket_of(keys, len(before))
    columns = [*keys, *sorted(history.business_columns(incoming, keys))]
    delivered = incoming.withColumn("_bucket", place)
    changed = _compare(before, delivered, keys, columns)
    if changed:
        part = pin(delivered.filter(F.col("_bucket").isin(list(changed))).drop("_bucket"))
        history.check_keys(part, keys)
        state = _rows(spark, path, known).filter(_is_open([r for r in before if r["bucket"] in changed]))
        merged = history.scd2_merge(state.drop(*PLACE.names), part, keys, as_of, loaded_at)
        _write(merged.withColumns({"_open": F.col("is_current").cast("int"), "_bucket": place}), path, number)
    _commit(spark, path, number, before, changed)
    return sorted(changed)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions of all rows."""
    known = versions(spark, f"{path}/current")
    if not known:
        raise FileNotFoundError(f"{path}: no load")
    rows = _rows(spark, path, known)
    return rows.filter((F.col("_open") == 0) | _is_open(_list(spark, path, known[-1], 0))).drop(*PLACE.names)


def load_new(
    spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], as_of: str, loaded_at: str,
    buckets: int = BUCKETS,
) -> list[int]:
    """Add the rows whose key no earlier load brought; returns the buckets that were looked at: those with
    rows whose keys are not the ones delivered last time. Files of earlier loads stay as they are."""
    number = _number(as_of)
    earlier = [n for n in versions(spark, f"{path}/current") if n < number]
    _start(spark, path, loads.full_reload(incoming, loaded_at).schema)
    before = _list(spark, path, earlier[-1] if earlier else 0, buckets)
    place = bucket_of(keys, len(before))
    changed = _compare(before, incoming.withColumn("_bucket", place), keys, keys)
    met = sorted(b for b, digest in changed.items() if digest["rows"])
    part = incoming.filter(place.isin(met))
    if earlier:
        seen = _rows(spark, path, earlier).filter(F.col("_bucket").isin(met))
        rows = loads.append_new(seen, part, keys, loaded_at)
    else:
        rows = loads.full_reload(part, loaded_at)
    _write(rows.withColumns({"_open": F.lit(1), "_bucket": place}), path, number)
    _commit(spark, path, number, before, changed)
    return met


def read_loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all loads."""
    return _rows(spark, path, versions(spark, f"{path}/current")).drop(*PLACE.names)


def load_whole(spark: SparkSession, path: str, incoming: DataFrame, as_of: str, loaded_at: str) -> None:
    """The delivery as the new content; earlier contents stay readable by their number."""
    loads.full_reload(incoming, loaded_at).write.mode("overwrite").parquet(f"{path}/version={_number(as_of)}")


def load(
    spark: SparkSession, table: str, path: str, incoming: DataFrame, as_of: str, loaded_at: str, buckets: int = BUCKETS
) -> None:
    """Load a delivery into the stored table by its registered strategy."""
    plan = loads.LOADS[table]
    if plan.strategy == "history":
        load_history(spark, path, incoming, plan.keys, as_of, loaded_at, buckets)
    elif plan.strategy == "append":
        load_new(spark, path, incoming, plan.keys, as_of, loaded_at, buckets)
    else:
        load_whole(spark, path, incoming, as_of, loaded_at)


def read(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The stored table: all versions of a history, all appended rows, or the newest content."""
    how = {"history": read_history, "append": read_loaded, "reload": read_table}
    return how[loads.LOADS[table].strategy](spark, path)
