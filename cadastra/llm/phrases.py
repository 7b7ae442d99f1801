"""Phrase collocation mining in two passes over a corpus.

Which n-grams occur ``least`` times or more in a language is found in two passes, none of which ships
all n-grams as text:

1. Blocks of documents are read apart. Each n-gram becomes a hash of 64 bits or, in a small corpus, so many
   that few n-grams share one, and a block's counts go to
   hash partitions, as one sorted summary per block and partition, each count cut at ``least`` (an n-gram
   is frequent by the cut counts exactly if it is by the full ones). A partition merges its summaries
   by Misra and Gries: more counters than its mass divided by ``least``, and whenever there are too
   many, the largest surplus counter is taken off all. So less than ``least`` is taken off in all, and
   every frequent n-gram is left. The partition sends each block the hashes of its n-grams that are left.
2. Each block is read again beside its own list, and the n-grams on it are counted as words, not as
   hashes. Hashes that collide or were only nearly frequent are dropped by these counts.

Blocks and hash partitions grow in number with the bytes of text, not in size, so what a task holds
stays the same. Nothing is broadcast or sent to the driver but the number of bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm import words as W
from cadastra.llm.common import bounded, slices
from cadastra.llm.hashed import among, edges, pack_keys, summed, unpack_keys
from cadastra.operators.skew import skew_join
from cadastra.session import pin, shuffle_partitions

LEAST = 10
LONGEST = 3
COVERED = 50
TOP = 2000
SCALE = 1_000_000
UNKNOWN = "und"
# Bytes of text in a block and in the n-grams of a hash partition.
BLOCK_BYTES = 16 << 20
# Bits of a hash beyond those that number the n-grams of the corpus.
SPARE_BITS = 12
# Counters of a summary, in multiples of its mass divided by the least count.
ROOM = 2
# Words that are counted as words at once; below 2 ** 21, so that three numbers fit a long.
CHUNK = 1 << 20
# Words that are hashed at once.
HASHED = 1 << 18

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"]] = True
BREAK[0x0A:0x0E] = True
SPACE = BREAK.copy()
SPACE[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BLANK = pa.scalar(" ", pa.large_string())
SUMMARY = "part int, block int, size long, keys binary, counts binary"


class Text:
    """Words of some texts of one language: places, and how many further words of a piece follow each."""

    def __init__(self, texts: pa.Array, longest: int = LONGEST):
        data, ends = W.text_bytes(texts)
        self.data = LOWER[data]
        self.starts, self.stops, owner = W.words(self.data, ends, ~SPACE)
        count = len(self.starts)
        breaks = np.flatnonzero(BREAK[self.data])
        joined = np.zeros(count, bool)
        if count:
            between = np.searchsorted(breaks, self.starts[1:]) > np.searchsorted(breaks, self.stops[:-1])
            joined[:-1] = ~between & (owner[1:] == owner[:-1])
        # reach[n][i]: n + 1 words from i on lie in one piece.
        self.reach = [np.ones(count, bool)]
        for n in range(1, longest):
            more = np.zeros(count, bool)
            if count > n:
                more[: count - n] = self.reach[-1][: count - n] & joined[n - 1 : count - 1]
            self.reach.append(more)

    def hashes(self, language: str, bits: int = 64) -> list[np.ndarray]:
        """Hashes of the n-grams from each word on, by n; only those in reach mean something."""
        name = np.frombuffer(b"\0" + language.encode(), np.uint8)
        words = np.zeros(len(self.starts), np.uint64)
        for begin in range(0, len(words), HASHED):
            some = slice(begin, begin + HASHED)
            starts, stops = self.starts[some], self.stops[some]
            words[some] = W.word_hashes(self.data[starts[0] : stops[-1]], starts - starts[0], stops - starts[0])
        words = W.mix(words ^ W.word_hashes(name, np.zeros(1, np.int64), np.array([len(name)])))
        out = [words]
        for n in range(1, len(self.reach)):
            longer = out[-1].copy()
            count = max(0, len(words) - n)
            longer[:count] = W.mix(out[-1][:count] * np.uint64(W.ODD[0]) + words[n : n + count])
            out.append(longer)
        return [h >> np.uint64(64 - bits) for h in out] if bits < 64 else out

    def numbers(self, begin: int, end: int) -> tuple[np.ndarray, pa.Array]:
        """(number of each word from begin to end, the distinct words) by the words themselves."""
        starts, stops = self.starts[begin:end], self.stops[begin:end]
        offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(stops - starts)))
        # What lies between words is all space.
        letters = self.data[starts[0] : stops[-1]]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters[~SPACE[letters]])]
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        return column.indices.to_numpy(zero_copy_only=False).astype(np.int64), column.dictionary


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """The texts of a batch, in slices of bounded size, language by language."""
    for part in slices(batch, "text"):
        languages = part.column("lang").dictionary_encode()
        for number, language in enumerate(languages.dictionary.to_pylist()):
            yield language, part.column("text").filter(pc.equal(languages.indices, number))


class Summary:
    """Misra-Gries counters of weighted keys; summaries are merged by adding one to another.

    ``mass`` bounds the sum of all counts that will be added. There are more than ``ROOM`` times as many
    counters as mass divided by ``least``, so that less than ``least`` / ``ROOM`` is ever taken off a counter:
    a frequent key keeps one, and a key is left only if it has most of what makes it frequent."""

    def __init__(self, mass: int, least: int):
        self.least = least
        self.capacity = ROOM * mass // least + 1
        self.taken = 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts.astype(np.int64)))
        self.held += len(keys)
        if self.held > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        keys, counts = summed(keys, counts)
        surplus = len(keys) - self.capacity
        if surplus > 0:
            # The largest counter beyond the capacity; at least capacity + 1 counters lose that much.
            cut = np.partition(counts, surplus - 1)[surplus - 1]
            self.taken += int(cut)
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
        self.keys, self.counts = keys, counts

    def candidates(self) -> np.ndarray:
        """Sorted keys that may have reached ``least``: every one that has is among them."""
        self.merge()
        return self.keys[self.counts + self.taken >= self.least]


def block_summaries(
    docs: DataFrame, blocks: int, parts: int, least: int, longest: int, bits: int = 64
) -> DataFrame:
    """The n-gram counts of every block, cut at ``least``, by hash partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        block = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block = batch.column("block")[0].as_py()
            for language, texts in by_language(batch):
                text = Text(texts, longest)
                found += [h[r] for h, r in zip(text.hashes(language, bits), text.reach, strict=True)]
        if block is None:
            return
        keys = np.concatenate(found)
        found.clear()
        keys.sort()
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        counts = np.minimum(np.diff(np.append(first, len(keys))), least).astype(np.uint32)
        keys = keys[first]
        cuts = np.append(np.searchsorted(keys, edges(parts, bits)), len(keys))
        for part in np.flatnonzero(np.diff(cuts)):
            some = slice(cuts[part], cuts[part + 1])
            values = [int(part)], [block], [int(counts[some].sum())], [pack_keys(keys[some])], [counts[some].astype("<u4").tobytes()]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()
            arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "block", "size", "keys", "counts"])

    placed = docs.repartitionById(blocks, F.col("block"))
    return bounded(placed).mapInArrow(run, SUMMARY)


def candidates(summaries: DataFrame, parts: int, least: int) -> DataFrame:
    """(block, keys): of each block's n-grams those that a hash partition's merged summary has left."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        summary = Summary(sum(row["size"] for row in rows), least)
        for row in rows:
            summary.add(unpack_keys(row["keys"]), np.frombuffer(row["counts"], "<u4"))
        left = summary.candidates()
        for row in rows:
            keys = unpack_keys(row["keys"])
            keys = keys[among(keys, left)]
            if len(keys):
                arrays = [pa.array([row["block"]], pa.int32()), pa.array([pack_keys(keys)], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "keys"])

    placed = summaries.repartitionById(parts, F.col("part"))
    return bounded(placed).mapInArrow(run, "block int, keys binary")


def counted(text: Text, hashes: list[np.ndarray], wanted: np.ndarray) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(n, phrases, counts) of the n-grams whose hash is wanted, told apart by their words."""
    for begin in range(0, len(text.starts), CHUNK):
        end = min(begin + CHUNK, len(text.starts))
        number, names = text.numbers(begin, min(end + len(hashes) - 1, len(text.starts)))
        for n, (hash_, reach) in enumerate(zip(hashes, text.reach, strict=True), 1):
            at = np.flatnonzero(reach[begin:end])
            at = at[among(hash_[begin:end][at], wanted)]
            if not len(at):
                continue
            columns = np.stack([number[at + i] for i in range(n)])
            if n <= 3:
                code = columns[0].copy()
                for column in columns[1:]:
                    code = code << 21 | column
                _, which, times = np.unique(code, return_index=True, return_counts=True)
            else:
                _, which, times = np.unique(columns, axis=1, return_index=True, return_counts=True)
            parts = [names.take(pa.array(columns[i][which])).cast(pa.large_string()) for i in range(n)]
            yield n, pc.binary_join_element_wise(*parts, BLANK) if n > 1 else parts[0], times


def exact_counts(docs: DataFrame, wanted: DataFrame, blocks: int, longest: int, bits: int = 64) -> DataFrame:
    """(lang, words, phrase, times) of the n-grams on each block's list, one row for each batch of texts
    they occur in; and, with null phrase and words 0, the number of all words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: list[np.ndarray] = []
        keys = None
        for batch in batches:
            mine = batch.column("keys")
            lists += [unpack_keys(k) for k in mine.drop_null().to_pylist()]
            rest = batch.filter(pc.is_null(mine))
            if rest.num_rows == 0:
                continue
            if keys is None:
                keys = np.sort(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
            for language, texts in by_language(rest):
                text = Text(texts, longest)
                rows = [(0, pa.nulls(1, pa.large_string()), np.array([len(text.starts)]))]
                for n, phrases, times in (*rows, *counted(text, text.hashes(language, bits), keys)):
                    arrays = [pa.array([language] * len(times)), pa.array(np.full(len(times), n, np.int32)), phrases.cast(pa.string()), pa.array(times.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "words", "phrase", "times"])

    # A block's list comes before its texts; texts of one language stand together.
    lists = wanted.select("block", "keys", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("text"))
    texts = docs.select("block", F.lit(None).cast("binary").alias("keys"), "lang", "text")
    placed = lists.unionByName(texts).repartitionById(blocks, F.col("block"))
    placed = placed.sortWithinPartitions(F.col("keys").isNull(), "lang")
    return bounded(placed).mapInArrow(run, "lang string, words int, phrase string, times long")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, words, phrase, f) of all phrases of 1 to ``longest`` words that occur ``least`` times or more
    in a language, with exact counts; and a row (lang, 0, null, number of words) per language. Written to
    the shared folder.

    docs: text, lang and doc_id. Null text counts as empty, null lang as ``und``. Repeated rows count
    each time. Empty table: no rows.
    """
    if least < 1 or longest < 1:
        raise ValueError("least and longest must be at least 1")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(shuffle_partitions(docs.sparkSession), -(-size // block_bytes))
    # No more n-grams than bytes (for three words): about one in 2 ** SPARE_BITS shares its hash.
    bits = min(64, int(size).bit_length() + SPARE_BITS)
    # Rows are dealt by id and text: copies with ids of their own do not meet in one block.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    slim = docs.select(block.alias("block"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    wanted = candidates(block_summaries(slim, blocks, blocks, least, longest, bits), blocks, least)
    every = exact_counts(slim, wanted, blocks, longest, bits)
    sums = every.groupBy("lang", "words", "phrase").agg(F.sum("times").alias("f"))
    return pin(sums.filter((F.col("words") == 0) | (F.col("f") >= least)))


def cut_score(a: Column, one: Column, two: Column) -> Column:
    """floor(SCALE * a * a / (one * two)) without rounding: at most 38 digits on the way."""
    big = lambda c: c.cast("decimal(19,0)")
    upper = (big(a) * big(a)).cast("decimal(32,0)") * F.lit(SCALE).cast("decimal(7,0)")
    lower = (big(one) * big(two)).cast("decimal(38,0)")
    return F.call_function("div", upper.cast("decimal(38,0)"), lower)


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    a: how often the phrase occurs (``least`` times or more); the cut into two parts with the lowest score
    floor(1000000 * a * a / (l * r)), of equal ones the first, gives l, r and score. A phrase is dropped if
    a longer one of such phrases contains it and has at least ``covered`` percent of its occurrences. n:
    all words of the language. Order: score, a (both descending), phrase. Nulls, repeated rows and empty
    tables as in ``frequent_phrases``; a language without such phrases gives no row.
    """
    known = frequent_phrases(docs, least, longest, block_bytes)
    phrases = known.filter("words > 0").select("lang", "words", "phrase", "f")
    long = phrases.filter("words > 1").withColumn("parts", F.split("phrase", " ")).withColumnRenamed("f", "a")
    # The words at either end left out: any longer phrase that covers one does so through these.
    words = F.col("words")
    inner = F.explode(F.array(
        F.array_join(F.slice("parts", F.lit(1), words - 1), " "), F.array_join(F.slice("parts", F.lit(2), words - 1), " ")
    ))
    around = long.filter(words > 2).select("lang", inner.alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("over"))
    left = long.join(around, ["lang", "phrase"], "left")
    left = left.filter(F.col("over").isNull() | (100 * F.col("over") < covered * F.col("a"))).drop("over")

    k = F.explode(F.sequence(F.lit(1), words - 1)).alias("k")
    one = F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ")
    two = F.array_join(F.slice("parts", F.col("k") + 1, words - F.col("k")), " ")
    cuts = left.select("lang", "phrase", "words", "a", "parts", k)
    sides = F.explode(F.array(F.struct(F.lit(1).alias("side"), one.alias("part")), F.struct(F.lit(2).alias("side"), two.alias("part"))))
    halves = cuts.select("lang", "phrase", "a", "k", sides.alias("half")).select("lang", "phrase", "a", "k", "half.*")
    known_parts = phrases.select("lang", F.col("phrase").alias("part"), "f")
    # Some words are part of very many phrases.
    halves = skew_join(pin(halves), known_parts, ["lang", "part"], "inner", spread=["phrase", "k"])
    of = lambda side: F.max(F.when(F.col("side") == side, F.col("f")))
    cut = halves.groupBy("lang", "phrase", "a", "k").agg(of(1).alias("l"), of(2).alias("r"))
    scored = cut.withColumn("score", cut_score(F.col("a"), F.col("l"), F.col("r")))
    # The least of (score, k) leads.
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
    best = best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")
    # First within ever fewer slices of a language, so that no task sorts all phrases of one.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = best
    slices_ = shuffle_partitions(docs.sparkSession)
    while slices_ > 1:
        place = F.pmod(F.xxhash64("phrase"), F.lit(slices_))
        window = Window.partitionBy("lang", place).orderBy(*order)
        first = first.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= top)
        slices_ //= 16
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    first = first.filter(F.col("rank") <= top)
    totals = known.filter("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
