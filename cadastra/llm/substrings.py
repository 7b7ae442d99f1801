"""Removal of passages that repeat across documents, with a count-min prefilter.

A window is ``WINDOW`` consecutive words. Documents with the same words throughout are settled
first: all but the smallest id lose every word. In the rest each window is represented by the
least hash among its runs of ``ANCHOR`` words; equal windows have equal anchors, and neighbouring
windows mostly share one, so there is one anchor for about 13 words.

A count-min sketch of the anchors is as wide as their counted number asks for, so that it stays as
sparse on a large corpus as on a small one. No task holds it: blocks of documents send the cells they
use to slices of it, a slice adds up what it gets and tells each block which of its cells count two or
more. The counts are never too low, so a window whose anchor is estimated once is unique. Anchors
estimated repeated are grouped exactly, and a second pass over the documents that hold them groups
their windows exactly, by two independent hashes of the words (96 bits). Nothing is lost: the sketch
only spares work.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm import words as W
from cadastra.llm.common import bounded, map_slices, sized, slices
from cadastra.llm.hashed import among, edges, pack_keys, summed, unpack_keys
from cadastra.session import pin, shuffle_partitions

WINDOW = 50
# Rows of the sketch, and the bits of a row's cells beyond those that number the anchors: of the anchors
# that occur once, (1 / 2 ** SPARE_BITS) ** DEPTH or fewer are taken for repeated ones.
DEPTH = 2
SPARE_BITS = 4
# Anchors of a block.
BLOCK_ANCHORS = 1 << 20
ROW_WINDOWS = 4096
EMPTY = hashlib.sha256(b"").hexdigest()
SLICE = 1 << 20


def _spans(count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    first = np.arange(max(0, count - width + 1))
    return first, first + width


def _anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchor of the window that starts at each word (windows may cross texts here)."""
    width = (window + 1) // 2
    parts = W.mix(W.span_hashes(hashes, *_spans(len(hashes), width), W.ODD[1]))
    return W.sliding_min(parts, window - width + 1)


def _sequence_hashes(data, starts, stops, first, last) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of all words of each text (words first..last)."""
    out = []
    for odd, over in ((W.ODD[0], W.ODD[1]), (W.ODD[2], W.ODD[3])):
        hashes = W.word_hashes(data, starts, stops, odd)
        out.append(W.mix(W.span_hashes(hashes, first, last, over) + (last - first).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def heads(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, key and other (hashes of its words), n_words, sha256 of its words joined by
    one space, and the distinct anchors of its windows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, ends = W.text_bytes(batch.column("text"))
        starts, stops, doc = W.words(data, ends)
        last = np.searchsorted(doc, np.arange(len(ends)), side="right")
        first = np.concatenate(([0], last[:-1])).astype(last.dtype) if len(last) else last
        key, other = _sequence_hashes(data, starts, stops, first, last)
        anchors = _anchors(W.word_hashes(data, starts, stops), window)
        lists, shas = [], []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for text, a, b in zip(texts, first.tolist(), last.tolist(), strict=True):
            lists.append(np.unique(anchors[a : max(a, b - window + 1)]).view(np.int64))
            shas.append(hashlib.sha256(b" ".join((text or b"").split())).hexdigest())
        sizes = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(key), pa.array(other), pa.array((last - first).astype(np.int64)),
                pa.array(shas, pa.string()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)),
            ],
            ["doc_id", "key", "other", "n_words", "sha256", "anchors"],
        )

    schema = "doc_id long, key long, other long, n_words long, sha256 string, anchors array<long>"

    def sliced(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield run(part)

    return bounded(docs.select("doc_id", "text")).mapInArrow(sliced, schema)


def _cells(anchors: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each anchor in a row of the sketch, numbered through all rows."""
    cells = W.mix(anchors.view(np.uint64) ^ np.uint64(W.ODD[row] >> 1)) >> np.uint64(64 - bits)
    return cells | np.uint64(row << bits)


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def repeated_cells(blocked: DataFrame, blocks: int, bits: int) -> DataFrame:
    """(block, cells): of the cells each block's anchors use those that the merged sketch counts at least
    twice. ``blocked``: block, anchors."""

    def partial(batches):
        cells, block = [], None
        for batch in batches:
            if batch.num_rows:
                block = batch.column("block")[0].as_py()
                values = _flat(batch.column("anchors"))
                cells += [_cells(values, row, bits) for row in range(DEPTH)]
        if block is None:
            return
        keys, counts = np.unique(np.concatenate(cells), return_counts=True)
        cuts = np.append(np.searchsorted(keys, edges(blocks, bits, DEPTH)), len(keys))
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            some = slice(cuts[part], cuts[part + 1])
            yield pa.RecordBatch.from_pydict(
                {
                    "slice": pa.array([part], pa.int32()), "block": pa.array([block], pa.int32()),
                    "cells": pa.array([pack_keys(keys[some])], pa.binary()),
                    "counts": pa.array([np.minimum(counts[some], 2).astype(np.uint8).tobytes()], pa.binary()),
                }
            )

    def merge(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        if not rows:
            return
        cells = [unpack_keys(row["cells"]) for row in rows]
        counts = [np.frombuffer(row["counts"], np.uint8).astype(np.int64) for row in rows]
        keys, total = summed(np.concatenate(cells), np.concatenate(counts))
        often = keys[total > 1]
        for row, mine in zip(rows, cells, strict=True):
            mine = mine[among(mine, often)]
            if len(mine):
                yield pa.RecordBatch.from_pydict(
                    {"block": pa.array([row["block"]], pa.int32()), "cells": pa.array([pack_keys(mine)], pa.binary())}
                )

    placed = bounded(blocked.select("block", "anchors").repartitionById(blocks, F.col("block")))
    parts = placed.mapInArrow(partial, "slice int, block int, cells binary, counts binary")
    return parts.repartitionById(blocks, F.col("slice")).mapInArrow(merge, "block int, cells binary")


def screened(originals: DataFrame) -> DataFrame:
    """(anchor, doc_id, key) of the anchors that the sketch estimates to repeat. ``originals`` (stored):
    doc_id, key, anchors."""
    count = originals.agg(F.sum(F.size("anchors"))).first()[0] or 0
    bits = min(62, int(count).bit_length() + SPARE_BITS)
    blocks = max(shuffle_partitions(originals.sparkSession), -(-count // BLOCK_ANCHORS))
    block = F.pmod(F.xxhash64("key", "doc_id"), F.lit(blocks)).cast("int").alias("block")
    blocked = originals.select(block, "doc_id", "key", "anchors")
    often = repeated_cells(blocked, blocks, bits)

    def run(batches):
        lists: list[np.ndarray] = []
        cells = None
        for batch in batches:
            lists += [unpack_keys(c) for c in batch.column("cells").drop_null().to_pylist()]
            rest = batch.filter(batch.column("cells").is_null())
            if rest.num_rows == 0:
                continue
            if cells is None:
                cells = np.sort(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
            anchors = rest.column("anchors")
            values = _flat(anchors)
            maybe = np.ones(len(values), bool)
            for row in range(DEPTH):
                maybe[maybe] = among(_cells(values[maybe], row, bits), cells)
            owner = np.repeat(np.arange(rest.num_rows), anchors.value_lengths().to_numpy())[maybe]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[maybe]), rest.column("doc_id").take(owner), rest.column("key").take(owner)],
                ["anchor", "doc_id", "key"],
            )

    # A block's cells come before its documents.
    flags = often.select("block", "cells", *[F.lit(None).cast(t).alias(n) for n, t in (("doc_id", "long"), ("key", "long"), ("anchors", "array<long>"))])
    rows = blocked.select("block", F.lit(None).cast("binary").alias("cells"), "doc_id", "key", "anchors")
    placed = flags.unionByName(rows).repartitionById(blocks, F.col("block")).sortWithinPartitions(F.col("cells").isNull())
    return bounded(placed).mapInArrow(run, "anchor long, doc_id long, key long")


def _windows(texts: DataFrame, window: int) -> DataFrame:
    """The windows with repeated anchors of each text: their start, two hashes, and whether some
    smaller document has the anchor. ``texts``: doc_id, text, key, known (list of anchor, low)."""

    def run(batch: pa.RecordBatch):
        data, ends = W.text_bytes(batch.column("text"))
        starts, stops, doc = W.words(data, ends)
        hashes = W.word_hashes(data, starts, stops)
        last = np.searchsorted(doc, np.arange(len(ends)), side="right")
        first = np.concatenate(([0], last[:-1])).astype(last.dtype)
        anchors = _anchors(hashes, window).view(np.int64)
        whole, _ = _sequence_hashes(data, starts, stops, first, last)
        places = _spans(len(hashes), window)
        one = W.mix(W.span_hashes(hashes, *places, W.ODD[2])).view(np.int64)
        others = W.word_hashes(data, starts, stops, W.ODD[3])
        two = (W.mix(W.span_hashes(others, *places, W.ODD[1])) >> np.uint64(33)).astype(np.int32)
        out = []
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
        known = batch.column("known")
        for i, (doc_id, key) in enumerate(zip(ids, keys, strict=True)):
            if key != whole[i]:
                continue
            entry = known[i].values
            found, low = entry.field("anchor").to_numpy(), entry.field("low").to_numpy()
            order = np.argsort(found)
            found, low = found[order], low[order]
            a, b = int(first[i]), max(int(first[i]), int(last[i]) - window + 1)
            spot = np.minimum(np.searchsorted(found, anchors[a:b]), len(found) - 1)
            at = np.flatnonzero(found[spot] == anchors[a:b])
            for cut in range(0, len(at), ROW_WINDOWS):
                some = at[cut : cut + ROW_WINDOWS]
                out.append((doc_id, key, some.astype(np.int32), one[a + some], two[a + some], low[spot[some]] < doc_id))
        rows = list(zip(*out, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.list_(pa.int32())),
                pa.array(rows[3], pa.list_(pa.int64())), pa.array(rows[4], pa.list_(pa.int32())),
                pa.array(rows[5], pa.list_(pa.bool_())),
            ],
            ["doc_id", "key", "at", "one", "two", "later"],
        )

    def sliced(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                yield run(part)

    schema = "doc_id long, key long, at array<int>, one array<long>, two array<int>, later array<boolean>"
    return bounded(texts.select("doc_id", "text", "key", "known")).mapInArrow(sliced, schema)


def _of_documents(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Join the texts of ``docs`` with ``rows`` (pinned, with doc_id). The texts of other documents
    are left out before the shuffle if the ids are few enough to be broadcast."""
    ids = rows.select("doc_id").distinct()
    some = docs.select("doc_id", "text").join(sized(ids, ids.count()), "doc_id", "left_semi")
    return some.join(rows, "doc_id")


def find(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(heads with ``copy``, removed). copy: the same words throughout are in a document with a
    smaller id. removed: doc_id, key, and the starts of windows that a smaller document has."""
    if window < 4:
        raise ValueError("a window has at least 4 words")
    head = pin(heads(docs, window))
    long = head.filter((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    originals = pin(
        long.groupBy("key", "other").agg(F.min("doc_id").alias("doc_id"), F.any_value("anchors").alias("anchors"))
    )
    firsts = originals.select("key", "other", F.col("doc_id").alias("first"))
    marked = head.drop("anchors").join(firsts, ["key", "other"], "left").withColumn(
        "copy", F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    ).drop("first")
    maybe = pin(screened(originals))
    repeated = pin(
        maybe.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high").drop("high")
    )
    known = pin(
        maybe.join(repeated, "anchor").groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("anchor", "low")).alias("known"))
    )
    windows = pin(_windows(_of_documents(docs, known), window)).select(
        "doc_id", "key", F.explode(F.arrays_zip("at", "one", "two", "later")).alias("w")
    ).select("doc_id", "key", "w.at", "w.one", "w.two", "w.later")
    # Written apart, so that the join deals both sides anew and a hot window can be split.
    least = pin(
        windows.groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .filter("low < high").drop("high")
    )
    hits = windows.filter("later").drop("later").join(least, ["one", "two"]).filter("low < doc_id")
    removed = pin(hits.groupBy("doc_id", "key").agg(F.collect_set("at").alias("starts")))
    return marked, removed


def _kept(text: bytes, starts: np.ndarray, window: int) -> tuple[list[bytes], int]:
    """(words outside the windows, number of words inside)."""
    found = text.split()
    edge = np.zeros(len(found) + 1, np.int64)
    edge[starts] += 1
    np.subtract.at(edge, np.minimum(starts + window, len(found)), 1)
    inside = np.cumsum(edge[:-1]) > 0
    return [w for w, gone in zip(found, inside.tolist(), strict=True) if not gone], int(inside.sum())


def _key_of(text: bytes) -> int:
    data, ends = W.text_bytes(pa.array([text], pa.large_binary()))
    starts, stops, _ = W.words(data, ends)
    first, last = np.zeros(1, np.int64), np.full(1, len(starts), np.int64)
    return int(_sequence_hashes(data, starts, stops, first, last)[0][0])


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for every row of ``docs`` (doc_id, text).

    Words are runs of bytes other than ASCII white space, compared as they are. A word goes if a
    window over it also starts in a document with a smaller id. Null text has no words; texts
    shorter than a window lose nothing; rows that share an id never remove each other's words; a
    null id neither removes nor loses. Other columns are ignored. Empty table: no rows.
    """
    marked, removed = find(docs, window)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for row in batch.to_pylist():
            text = (row["text"] or "").encode()
            if _key_of(text) == row["key"]:
                left, gone = _kept(text, np.array(row["starts"]), window)
                out.append((row["doc_id"], row["key"], gone, hashlib.sha256(b" ".join(left)).hexdigest()))
        rows = list(zip(*out, strict=True)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "key", "gone", "left"]
        return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names)

    cleaned = map_slices(_of_documents(docs, removed), run, "doc_id long, key long, gone long, left string")
    joined = marked.join(cleaned.dropDuplicates(["doc_id", "key"]), ["doc_id", "key"], "left")
    gone = F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0)))
    sha = F.when(F.col("copy"), F.lit(EMPTY)).otherwise(F.coalesce("left", "sha256"))
    return joined.select("doc_id", "n_words", gone.alias("n_removed"), sha.alias("kept_sha256"))


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text`` (all columns are kept; ``n_chars`` is
    counted again if there is one). A text that loses words has the others joined by one space; it
    may become empty. All other rows are unchanged."""
    marked, removed = find(docs, window)
    copies = marked.filter("copy").select(
        "doc_id", F.struct("key", F.array().cast("array<int>").alias("starts")).alias("e")
    )
    parts = removed.select("doc_id", F.struct("key", "starts").alias("e"))
    # Entries of one id: one for each different text under it.
    changes = pin(copies.union(parts).distinct().groupBy("doc_id").agg(F.collect_list("e").alias("__llm_entries")))
    ids = changes.select(F.col("doc_id").alias("__llm_id"))
    few = sized(ids, changes.count())
    same = F.col("doc_id") == F.col("__llm_id")

    @F.pandas_udf("string")
    def clean(text: pd.Series, entries: pd.Series) -> pd.Series:
        out = []
        for whole, choices in zip(text, entries, strict=True):
            body = (whole or "").encode()
            key = _key_of(body)
            mine = next((e for e in choices if e["key"] == key), None)
            if mine is None:
                out.append(whole)
            elif not len(mine["starts"]):
                out.append("")
            else:
                out.append(b" ".join(_kept(body, np.array(mine["starts"]), window)[0]).decode())
        return pd.Series(out, dtype=object)

    untouched = bounded(docs).join(few, same, "left_anti")
    touched = bounded(docs).join(few, same, "left_semi").join(
        changes.withColumnRenamed("doc_id", "__llm_id"), same
    ).withColumn("text", clean("text", "__llm_entries"))
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        touched = touched.withColumn("n_chars", F.when(F.col("text").isNotNull(), count).otherwise(F.col("n_chars")))
    return untouched.unionByName(touched.select(*docs.columns))
