"""Phrase mining against plain Python counts, and the guarantee of the merged summaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadastra.llm import phrases as P


def counts(docs, longest=3):
    """({lang: Counter of phrases as word tuples}, {lang: number of words})."""
    found, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        tongue = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.lower(text)):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[tongue] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    found[tongue][tuple(words[i : i + n])] += 1
    return found, total


def mined(docs, least, longest=3, covered=50, top=2000):
    out = []
    for lang, f in counts(docs, longest)[0].items():
        n = counts(docs, longest)[1][lang]
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in some.items():
            inside = any(
                len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in some.items()
            )
            if not inside:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, name, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, name.decode(), -a, left, right, n, -score))
    return sorted(out)


def frame(spark, rows):
    clash = {c: F.lit("x") for c in ("block", "phrase", "a", "f", "words", "k", "side", "part", "score", "keys")}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(clash)


def corpus(seed, count=120):
    r = random.Random(seed)
    names = ["The", "of", "New", "York", "été", "straße", "漢字", "x" * 40, "a|b", "-", " ", "z"]
    rows = []
    for i in range(count):
        words = [r.choice(names[: r.choice([3, 5, 12])]) + r.choice(["", "", "", ".", ",", "\t", "  ", "\n", "!?"]) for _ in range(r.randint(0, 60))]
        rows.append((i % 90, " ".join(words), r.choice(["en", "fr", None, "und", ""])))
    rows += [(1, None, "en"), (2, "", None), (None, "New York " * 200, "en"), (None, "New York " * 200, "en"), (None, None, None),
             (500, " \t ", "de"), (501, ".,;:!?", "de"), (502, "one", "es"), (503, "ab." * 5000, "nl"), (504, "the of " * 3, "en")]
    return rows


@pytest.mark.parametrize(("least", "longest", "top"), [(10, 3, 2000), (2, 3, 7), (3, 2, 50), (4, 4, 2000), (1, 3, 2000)])
def test_collocations_equal_brute_force(spark, least, longest, top):
    rows = corpus(least)
    found = P.collocations(frame(spark, rows), least=least, longest=longest, top=top, block_bytes=2000)
    assert sorted(tuple(x) for x in found.collect()) == mined(rows, least, longest, top=top)


def test_counts_are_exact_and_whole(spark):
    rows = corpus(9)
    words, totals = counts(rows)
    found = P.frequent_phrases(frame(spark, rows), least=5, block_bytes=1000).collect()
    want = {(lang, " ".join(p)): n for lang, f in words.items() for p, n in f.items() if n >= 5}
    assert {(x.lang, x.phrase): x.f for x in found if x.words} == want
    assert {x.lang: x.f for x in found if not x.words} == dict(totals)


@pytest.mark.parametrize("spare", [-8, 0, 40])
def test_shared_hashes_change_nothing(spark, monkeypatch, spare):
    rows = corpus(12)
    monkeypatch.setattr(P, "SPARE_BITS", spare)
    found = P.collocations(frame(spark, rows), least=3, block_bytes=1500)
    assert sorted(tuple(x) for x in found.collect()) == mined(rows, 3)


def test_empty_tables_and_texts_without_phrases(spark):
    assert P.collocations(frame(spark, [])).count() == 0
    assert P.collocations(frame(spark, [(1, None, None), (2, "", "en"), (3, "a b c", "en")])).count() == 0


def test_equal_texts_under_one_id(spark):
    rows = [(7, "to be or not to be", "en")] * 400
    found = P.collocations(frame(spark, rows), block_bytes=500).collect()
    assert sorted(tuple(x) for x in found) == mined(rows, 10)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), max_size=30), max_size=12), st.integers(1, 12))
def test_no_frequent_key_is_lost_by_merging(parts, least):
    mass = sum(n for part in parts for _, n in part)
    summary, total = P.Summary(mass, least), Counter()
    for part in parts:
        keys, times = P.summed(np.array([k for k, _ in part], np.uint64), np.array([n for _, n in part], np.int64))
        summary.add(keys, times)
        for k, n in part:
            total[k] += n
    left = set(summary.candidates().tolist())
    assert {k for k, n in total.items() if n >= least} <= left
    assert P.ROOM * summary.taken < least and len(summary.keys) <= summary.capacity and summary.capacity > mass / least


def test_summary_drops_most_rare_keys():
    r = np.random.default_rng(1)
    summary = P.Summary(200_000, 10)
    for _ in range(100):
        keys = np.unique(r.integers(0, 2**63, 1980).astype(np.uint64))
        summary.add(np.concatenate((np.arange(20, dtype=np.uint64), keys)), np.ones(20 + len(keys), np.int64))
    left = summary.candidates()
    assert set(range(20)) <= set(left.tolist()) and len(left) < 100


@given(st.lists(st.integers(0, 2**64 - 1), unique=True))
def test_keys_travel_unchanged(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert (P.unpack_keys(P.pack_keys(keys)) == keys).all()


def test_hash_ranges_cover_all_keys():
    for parts in (1, 3, 8, 1000):
        least = P.edges(parts)
        assert least[0] == 0 and (np.diff(least) > 0).all() if parts > 1 else least[0] == 0


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    """All n-grams of one size get one of three hashes: counts are still those of the words."""
    real = P.Text.hashes
    monkeypatch.setattr(P.Text, "hashes", lambda self, lang, bits=64: [h % np.uint64(3) for h in real(self, lang)])
    import pyarrow as pa

    rows = ["a b a b a c", "b a. b a c c"]
    text = P.Text(pa.array(rows))
    found = Counter()
    for _, names, times in P.counted(text, text.hashes("en"), np.arange(3, dtype=np.uint64)):
        found.update(dict(zip(names.to_pylist(), times.tolist(), strict=True)))
    want = counts([(0, t, "en") for t in rows])[0]["en"]
    assert found == {" ".join(p): n for p, n in want.items()}


def test_scores_are_exact_beyond_64_bits(spark):
    r = random.Random(4)
    rows = []
    for _ in range(500):
        a = r.randint(1, 10 ** r.randint(1, 15))
        rows.append((a, a + r.randint(0, a), a + r.randint(0, 10**r.randint(0, 15))))
    rows += [(3_037_000_500, 3_037_000_500, 3_037_000_501), (10**15, 10**15, 10**15), (10**15 - 1, 10**15, 10**15)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    for x in df.withColumn("score", P.cut_score(F.col("a"), F.col("l"), F.col("r"))).collect():
        assert x.score == 1_000_000 * x.a * x.a // (x.l * x.r)
