"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints that differ in at most
two bits have a segment that differs in at most one bit, so they share a variant of that segment
with the differing bit blanked out. Equal variants meet in an equality join; the bit distance is
verified. A bucket of more than ``SMALL_BUCKET`` fingerprints is never paired: its members are
dealt once more by blanked variants of the other segment, where all members of a bucket are within
the distance of each other, and each is linked to the smallest only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import KEY, keep_marked, map_slices, sized
from cadastra.llm.components import connected
from cadastra.session import pin, shuffle_partitions

SHINGLE = 3
DISTANCE = 2
SMALL_BUCKET = 256
LOW = 0xFFFFFFFF


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number; texts without words have 0."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp: long) for every row of ``docs``; fp holds the 64 bits, so it may be
    negative. A null text counts as empty in fp. text_hash tells rows of one id apart."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary())
        values = [fingerprint(t.as_py() or b"", shingle) for t in texts]
        found = np.array(values, dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(found)], ["doc_id", "text_hash", "fp"]
        )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_slices(rows, run, "doc_id long, text_hash long, fp long")


def _part(value: Column, segment: int) -> Column:
    return F.shiftrightunsigned(value, 32) if segment == 0 else value.bitwiseAND(F.lit(LOW))


def _blank(value: Column, bit: Column) -> Column:
    """``value`` with one bit set to zero."""
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def _key(value: Column, segment: int, blank: Column | int) -> Column:
    """Segment number, blanked bit (32: none) and the other bits of the segment in one long."""
    what = (F.lit(blank) if isinstance(blank, int) else blank) + 33 * segment
    return value.bitwiseOR(F.call_function("shiftleft", what.cast("long"), F.lit(32)))


def _variants(segment: int) -> Column:
    """The whole segment, and its 32 variants with one bit blanked; ``bit`` is that bit."""
    part = _part(F.col("fp"), segment)
    whole = F.struct(_key(part, segment, 32).alias("key"), F.lit(-1).alias("bit"))
    blanked = F.transform(
        F.sequence(F.lit(0), F.lit(31)),
        lambda i: F.struct(
            _key(_blank(part, i), segment, i).alias("key"),
            F.call_function("shiftright", part, i).bitwiseAND(F.lit(1)).cast("int").alias("bit"),
        ),
    )
    return F.concat(F.array(whole), blanked)


def _rest(segment: int, blanks: int) -> Column:
    """Keys of the other segment with ``blanks`` bits blanked."""
    other = _part(F.col("fp"), 1 - segment)
    if blanks == 0:
        return F.array(F.struct(other.alias("bits"), F.lit(-1).alias("what")))
    one = F.transform(
        F.sequence(F.lit(0), F.lit(31)), lambda j: F.struct(_blank(other, j).alias("bits"), j.alias("what"))
    )
    if blanks == 1:
        return one
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(30)),
            lambda j: F.transform(
                F.sequence(j + 1, F.lit(31)),
                lambda k: F.struct(_blank(_blank(other, j), k).alias("bits"), (32 + j * 32 + k).alias("what")),
            ),
        )
    )


def links(prints: DataFrame, distance: int = DISTANCE, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """(u, v) links that connect the distinct fingerprints ``prints`` (fp) that differ in at most
    ``distance`` (1 or 2) bits.

    A bucket of a whole segment pairs its members, one of a blanked segment those that differ in
    the blanked bit, so a pair meets in two buckets at most. Buckets above ``small_bucket`` give
    stars over the blanked variants of the other segment: fewer links, the same components.
    """
    if distance not in (1, 2):
        raise ValueError("two segments with one blanked bit serve a distance of 1 or 2 bits")
    # Each fingerprint gives 66 rows: deal the narrow table before it grows.
    dealt_prints = prints.repartition(shuffle_partitions(prints.sparkSession), "fp")
    keyed = dealt_prints.select("fp", F.explode(F.concat(_variants(0), _variants(1))).alias("s")).select(
        "fp", "s.key", "s.bit"
    )
    # Tables that are joined with what they count are written apart: both sides of the join are
    # dealt anew, and a hot key can be split.
    shared = pin(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
    members = pin(keyed.join(sized(shared, shared.count()), "key"))
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    small = members.filter(F.col("n") <= small_bucket)
    left = small.filter("bit < 1").select("key", "bit", F.col("fp").alias("u"))
    right = small.filter("bit <> 0").select(
        F.col("key").alias("_key"), F.abs("bit").alias("_bit"), F.col("fp").alias("v")
    )
    # bit -1 marks whole segments (paired once, u < v); 0 meets 1 in blanked ones.
    meets = (F.col("key") == F.col("_key")) & ((F.col("bit") == 0) | (F.col("u") < F.col("v")))
    pairs = left.join(right, meets & (apart <= distance)).select("u", "v")
    large = members.filter(F.col("n") > small_bucket).select("key", "fp", F.col("bit") < 0)
    large = large.toDF("key", "fp", "whole")
    first = F.col("key") < (33 << 32)
    keys = F.when(F.col("whole") & first, _rest(0, distance))
    keys = keys.when(F.col("whole"), _rest(1, distance)).when(first, _rest(0, distance - 1))
    dealt = large.select("key", "fp", F.explode(keys.otherwise(_rest(1, distance - 1))).alias("s")).select(
        "key", "fp", "s.bits", "s.what"
    )
    by = ["key", "bits", "what"]
    centre = dealt.groupBy(*by).agg(F.min("fp").alias("v"), F.max("fp").alias("most")).filter("v < most")
    stars = dealt.join(centre.drop("most"), by).select(F.col("fp").alias("u"), "v")
    return pairs.union(stars.filter("u <> v").filter(apart <= distance))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Texts are lower-cased in A-Z only and cut at ASCII white space. root is a
    fingerprint that names the component, component_id the smallest doc_id reachable over links of at most ``distance`` bits. Null and empty texts have
    fingerprint 0, which links like any other; repeated rows stay as they are; a null doc_id gets
    the component of its fingerprint (null if only null ids share it). Empty table: no rows.
    """
    marked = pin(fingerprints(docs, shingle))
    prints = pin(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected(links(prints.select("fp"), distance))
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = pin(placed.join(least, "root").select("fp", "root", "component_id"))
    return marked.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row (all columns) of each component: the smallest doc_id, a null id last; of several rows
    with that id one stays."""
    found = pin(near_duplicates(docs, shingle, distance))
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")
    first = pin(found.groupBy("root").agg(F.min(order).alias("first")))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    marked = found.join(first, "root").select("doc_id", F.col("text_hash").alias(KEY), same.alias("kept"))
    return keep_marked(docs, F.xxhash64("text"), marked)
