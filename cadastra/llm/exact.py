"""Exact deduplication of incoming documents against an immutable snapshot.

The snapshot is kept as exact buckets: one row per SHA-256 of the normalised text. For each range
of digests a static binary-fuse filter (three probes of 8 bits, about 9 bits a key) is built once.
Incoming digests are first folded to one row each, then screened by the filter of their range; only
positives are joined with the exact buckets. What the filter rejects is new, and is grouped among
the incoming rows themselves. Equality is decided on bytes: the normalised texts behind every
digest that occurs more than once are grouped by their whole text, and a digest with two texts
stops the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import KEY, bucket_of, keep_marked, sized
from cadastra.session import pin

# Digests of one filter; the number of filters follows the number of digests.
FILTER_KEYS = 1 << 16
DIGEST = "__llm_digest"


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def _shape(count: int) -> tuple[int, int]:
    """Length of a segment (a power of two) and the number of starting segments."""
    if count <= 1:
        return 4, 1
    length = 1 << max(2, min(18, int(np.floor(np.log(count) / np.log(3.33) + 2.25))))
    cells = int(count * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(count, 2))))
    return length, max(1, -(-cells // length) - 2)


def _places(mixed: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three cells in neighbouring segments for each key."""
    first = ((mixed >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    low = np.int64(length - 1)
    part = mixed.astype(np.int64)
    return np.stack([(first + i) * length + ((part >> np.int64(18 * i)) & low) for i in range(3)])


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, cells) of a filter over distinct unsigned keys.

    Cells that hold one key are peeled in rounds, all of a round at once; the cells are filled in
    the opposite order. An unlucky seed is replaced by the next.
    """
    keys = np.unique(keys.astype(np.uint64))
    length, segments = _shape(len(keys))
    for seed in range(1, 200):
        mixed = _mix(keys, seed)
        places = _places(mixed, length, segments)
        cells = (segments + 2) * length
        alive = np.ones(len(keys), bool)
        degree = np.bincount(places.ravel(), minlength=cells)
        owner = np.zeros(cells, np.int64)
        for row in places:
            np.add.at(owner, row, np.arange(len(keys)))
        rounds = []
        while True:
            single = np.flatnonzero(degree == 1)
            if not len(single):
                break
            found, at = np.unique(owner[single], return_index=True)
            rounds.append((found, single[at]))
            alive[found] = False
            for row in places:
                np.subtract.at(degree, row[found], 1)
                np.subtract.at(owner, row[found], found)
        if alive.any():
            if seed % 20 == 0:
                segments += 1
            continue
        table = np.zeros(cells, np.uint8)
        mark = (mixed ^ (mixed >> np.uint64(32))).astype(np.uint8)
        for found, cell in reversed(rounds):
            others = mark[found]
            for row in places:
                others = others ^ np.where(row[found] == cell, 0, table[row[found]]).astype(np.uint8)
            table[cell] = others
        return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed gives a filter")


def probe_filter(keys: np.ndarray, seed: int, length: int, segments: int, cells: bytes) -> np.ndarray:
    """True for every key of the filter, and for about one other key in 256."""
    table = np.frombuffer(cells, np.uint8)
    mixed = _mix(keys.astype(np.uint64), seed)
    a, b, c = _places(mixed, length, segments)
    mark = (mixed ^ (mixed >> np.uint64(32))).astype(np.uint8)
    return (table[a] ^ table[b] ^ table[c]) == mark


def _key64(column: pa.Array) -> np.ndarray:
    """The last 8 bytes of each digest (the first ones choose the filter)."""
    joined = b"".join(x[-8:] for x in column.to_pylist())
    return np.frombuffer(joined, ">u8").astype(np.uint64)


def normalised(text: Column) -> Column:
    """Text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _range(parts: int) -> Column:
    """The range of a digest: its first four bytes scaled to ``parts``."""
    head = F.conv(F.hex(F.substring(DIGEST, 1, 4)), 16, 10).cast("long")
    return F.shiftright(head * parts, 32).cast("int")


def snapshot_filters(buckets: DataFrame, parts: int) -> DataFrame:
    """One filter row per range of the snapshot's digests. Digests are distinct and uniform, so a
    group holds about ``FILTER_KEYS`` of them whatever the texts are."""

    def build(table: pa.Table) -> pa.Table:
        seed, length, segments, cells = build_filter(_key64(table.column(DIGEST)))
        columns = {"part": table.column("part")[:1], "seed": [seed], "length": [length]}
        return pa.table(columns | {"segments": [segments], "cells": pa.array([cells], pa.binary())})

    return (
        buckets.select(DIGEST, _range(parts).alias("part"))
        .groupBy("part").applyInArrow(build, "part int, seed long, length long, segments long, cells binary")
    )


def screen(incoming: DataFrame, filters: DataFrame, parts: int) -> DataFrame:
    """Add ``maybe`` to distinct incoming digests: false only if the snapshot lacks the digest."""
    schema = f"{DIGEST} binary, maybe boolean"

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        hit = np.zeros(left.num_rows, bool)
        if right.num_rows and left.num_rows:
            row = right.to_pylist()[0]
            hit = probe_filter(_key64(left.column(DIGEST)), row["seed"], row["length"], row["segments"], row["cells"])
        return pa.table({DIGEST: left.column(DIGEST), "maybe": pa.array(hit)})

    dealt = incoming.select(DIGEST, _range(parts).alias("part"))
    return dealt.groupBy("part").cogroup(filters.groupBy("part")).applyInArrow(probe, schema)


def _fold(rows: DataFrame) -> DataFrame:
    """One row per digest: rows, and the row that stays (most code points, smallest id; of equal
    rows the one numbered first)."""
    best = F.max(F.struct("n", F.bitwise_not("doc_id").alias("id"), F.bitwise_not("row").alias("row")))
    return rows.groupBy(DIGEST).agg(F.count("*").alias("size"), best.alias("best"))


def _merge(one: DataFrame, other: DataFrame) -> DataFrame:
    return one.unionByName(other).groupBy(DIGEST).agg(F.sum("size").alias("size"), F.max("best").alias("best"))


def check_bytes(docs: DataFrame, repeated: DataFrame, count: int) -> DataFrame:
    """Group the texts behind repeated digests by their whole normalised text: (digest, texts).
    Copies are combined on the map side, so a group of copies sends one row per task."""
    texts = docs.select(digest(F.col("text")).alias(DIGEST), normalised(F.col("text")).alias("__llm_norm"))
    chosen = texts.join(sized(repeated.select(DIGEST), count), DIGEST, "left_semi")
    distinct = chosen.groupBy(DIGEST, "__llm_norm").agg(F.count("*").alias("rows"))
    one = distinct.groupBy(DIGEST).agg(F.count("*").alias("texts"), F.sum("rows").alias("rows"))
    clash = F.raise_error(F.lit("two texts have one SHA-256 digest"))
    return one.select(DIGEST, F.when(F.col("texts") > 1, clash.cast("long")).otherwise(F.col("rows")).alias("rows"))


def dedup(docs: DataFrame, in_snapshot: Column | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row of ``docs`` (doc_id, text).

    ``in_snapshot`` tells the rows of the immutable snapshot (default: three quarters, by id hash);
    the answer does not depend on it. Texts are equal when they are without ASCII white space; null
    counts as empty. Of equal texts the one with most code points stays, then the smallest doc_id,
    a null id last; of identical rows exactly one stays. Other columns are ignored. Empty: no rows.
    """
    known = bucket_of("doc_id", 4) != 0 if in_snapshot is None else in_snapshot
    base = pin(
        docs.select(
            "doc_id",
            F.coalesce(F.length("text"), F.lit(0)).alias("n"),
            digest(F.col("text")).alias(DIGEST),
            known.alias("known"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    buckets = pin(_fold(base.filter("known")))
    batch = pin(_fold(base.filter("not known")))
    # Ranges follow the larger side, so neither has more than about FILTER_KEYS digests in one.
    parts = max(1, -(-max(buckets.count(), batch.count()) // FILTER_KEYS))
    filters = pin(snapshot_filters(buckets, parts))
    screened = screen(batch, filters, parts).filter("maybe").select(DIGEST)
    # Positives meet their exact buckets; the rest of the batch is grouped already.
    groups = pin(_merge(buckets, batch.join(screened, DIGEST, "left_semi")).unionByName(
        batch.join(screened, DIGEST, "left_anti")
    ))
    repeated = groups.filter("size > 1")
    checked = check_bytes(docs, repeated, repeated.count())
    # Written apart, so that the join deals both sides anew and a hot group can be split.
    groups = pin(groups.join(checked, DIGEST, "left").withColumn("size", F.coalesce("rows", "size")))
    placed = base.join(groups.select(DIGEST, "size", "best"), DIGEST)
    return placed.select(
        "doc_id",
        F.bitwise_not("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.bitwise_not("best.row") == F.col("row")).alias("kept"),
        DIGEST,
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay (all columns); see ``dedup``. Of rows that share id and
    normalised text exactly one stays, the longest original."""
    found = pin(dedup(docs).withColumnRenamed(DIGEST, KEY))
    return keep_marked(docs, digest(F.col("text")), found, longest=True)
