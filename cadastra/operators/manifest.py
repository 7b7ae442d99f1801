"""File manifests: hashes, change detection, run ledger, input checks, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions.columns import choose, round_exact
from cadastra.operators.skew import skew_join
from cadastra.operators.windows import flag_extreme, latest_per_key
from cadastra.session import shuffle_partitions

# Bytes of a file that are read at once to hash it.
HASH_BLOCK = 8 << 20


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files under a folder with their size; contents are not read. Spark lists no empty files."""
    return _listed(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path))


def _listed(files: DataFrame, *more: Column) -> DataFrame:
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        F.col("length").alias("bytes"),
        round_exact(F.col("length") / F.lit(1048576.0), 2).alias("size_mb"),
        F.col("modificationTime").alias("modified_at"),
        *more,
    )


def hash_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """List files with the MD5 of their bytes. A task opens a listed file where it lies and folds it block
    by block, so files of any size are hashed in constant memory; a file that cannot be opened stops
    the job. Local folders and the object stores and file systems that Arrow knows can be read."""
    files = listing(spark, path, pattern)

    def digests(batches):
        import hashlib
        import re
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for uri in batch.column("path").to_pylist():
                # Listed paths are not escaped, and local ones may have one slash.
                escaped = quote(re.sub("^file:/(?!/)", "file:///", uri), safe="/:@=,+")
                system, place = fs.FileSystem.from_uri(escaped)
                digest = hashlib.md5()
                with system.open_input_stream(place) as stream:
                    while block := stream.read(HASH_BLOCK):
                        digest.update(block)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "md5"])

    # Names only, dealt evenly: the listing may lie in one partition.
    dealt = files.repartition(shuffle_partitions(spark), "path")
    return dealt.mapInArrow(digests, T.StructType([*files.schema.fields, T.StructField("md5", T.StringType())]))


def classify(scan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Label each scanned file new, changed or unchanged against the latest manifest rows."""
    last = manifest.filter("is_latest").select("filename", F.col("md5").alias("_known"))
    state = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_known") == F.col("md5"), "unchanged")
        .otherwise("changed")
    )
    return scan.join(last, "filename", "left").withColumn("status", state).drop("_known")


def with_latest(manifest: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Derive ``is_latest`` from upload times instead of updating rows."""
    return flag_extreme(manifest.drop("is_latest"), keys, order, "is_latest", last=True)


def latest_files(files: DataFrame, base: Column, stamp: Column) -> DataFrame:
    """Newest stamped version of each base name."""
    named = files.withColumn("_base", base).withColumn("_stamp", stamp)
    return latest_per_key(named, ["_base"], [F.col("_stamp").desc()]).drop("_base", "_stamp")


def archive_list(files: DataFrame, base: Column, stamp: Column, keep: int = 1) -> DataFrame:
    """Versions past the newest ``keep`` of each base name: the ones to archive. Files of one stamp
    follow their other columns, which tell them apart.

    Only the newest of each base are ranked, which map tasks cut before the shuffle; the others are
    found by comparing them with the oldest one that stays.
    """
    named = files.withColumn("_base", base).withColumn("_at", F.struct(stamp.alias("stamp"), *files.columns))
    rank = F.row_number().over(Window.partitionBy("_base").orderBy(F.col("_at").desc()))
    newest = named.select("_base", "_at", rank.alias("_rank")).filter(F.col("_rank") <= keep)
    oldest = newest.groupBy("_base").agg(F.min("_at").alias("_oldest"), F.count("*").alias("_kept"))
    limits = oldest.filter(F.col("_kept") == keep).drop("_kept")
    past = skew_join(
        named, limits, ["_base"], "inner", spread=files.columns, null_safe=True,
        condition=lambda: F.col("_at") < F.col("_oldest"),
    )
    return past.select(*files.columns)


def run_states(events: DataFrame) -> DataFrame:
    """Latest state of each run from its append-only event rows, with file counts."""
    return events.groupBy("run_id", "domain").agg(
        F.min("at").alias("started_at"),
        F.max("at").alias("ended_at"),
        F.max_by("status", "at").alias("status"),
        F.sum("files").cast("bigint").alias("files"),
    )


def latest_success(runs: DataFrame) -> DataFrame:
    """Last successful run of each domain."""
    return (
        runs.filter(F.col("status") == "SUCCESS")
        .groupBy("domain")
        .agg(F.max_by("run_id", F.struct("ended_at", "run_id")).alias("run_id"), F.max("ended_at").alias("ended_at"))
    )


def missing_inputs(
    expected: DataFrame, listed: DataFrame, manifest: DataFrame
) -> DataFrame:
    """Sources with fewer files than expected, in the listing or in the manifest.

    ``expected(source, minimum)``; both others carry ``source``.
    """
    seen = listed.groupBy("source").agg(F.count("*").alias("listed"))
    known = manifest.groupBy("source").agg(F.count("*").alias("recorded"))
    table = expected.join(seen, "source", "left").join(known, "source", "left")
    filled = table.select(
        "source",
        "minimum",
        F.coalesce("listed", F.lit(0)).alias("listed"),
        F.coalesce("recorded", F.lit(0)).alias("recorded"),
    )
    return filled.filter((F.col("listed") < F.col("minimum")) | (F.col("recorded") < F.col("minimum")))


def unchanged_since(inputs: DataFrame, last_inputs: DataFrame) -> DataFrame:
    """One row telling whether the input hashes equal those of the last run, so that it can be
    skipped."""
    both = (
        inputs.select("md5", F.lit(1).alias("now"), F.lit(0).alias("then"))
        .unionByName(last_inputs.select("md5", F.lit(0).alias("now"), F.lit(1).alias("then")))
        .groupBy("md5")
        .agg(F.max("now").alias("now"), F.max("then").alias("then"))
    )
    return both.agg(
        (F.coalesce(F.bool_and(F.col("now") == F.col("then")), F.lit(False))).alias("skip")
    )


def route(files: DataFrame, patterns: Mapping[str, str], name: str = "filename") -> DataFrame:
    """Target of each file by the first pattern its name matches; unmatched files are dropped."""
    target = choose([(F.col(name).rlike(p), F.lit(label)) for p, label in patterns.items()])
    return files.withColumn("target", target).filter("target is not null")


def unmatched_patterns(files: DataFrame, patterns: Mapping[str, str], name: str = "filename") -> DataFrame:
    """Patterns no file matches (a delivery error)."""
    from cadastra.operators.aggregates import pattern_tally

    tally = pattern_tally(files, F.col(name), {p: p for p in patterns})
    return tally.filter("n = 0").select(F.col("label").alias("pattern"))


def main_file(files: DataFrame, delivery: str, name: str = "filename", size: str = "bytes") -> DataFrame:
    """The data file of each delivery: the largest table file that is not documentation."""
    is_table = F.lower(F.col(name)).rlike(r"\.(csv|xls|xlsx)$")
    is_note = F.lower(F.col(name)).rlike("^(doc|note|dict|nomen|meta)")
    candidates = files.filter(is_table & ~is_note)
    return candidates.groupBy(delivery).agg(
        F.max_by(name, F.struct(F.col(size), F.col(name))).alias(name), F.max(size).alias(size)
    )


def sidecar(files: DataFrame, **facts: Column) -> DataFrame:
    """Provenance of each file as JSON text, to be written next to it."""
    body = F.struct(
        F.col("filename"), F.col("md5"), *[value.alias(key) for key, value in facts.items()]
    )
    return files.select(
        F.concat(F.col("filename"), F.lit(".meta.json")).alias("key"), F.to_json(body).alias("json")
    )
