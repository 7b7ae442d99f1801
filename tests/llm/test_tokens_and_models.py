"""The byte-level codec against its library, and the trained models by gradient and accuracy."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from cadastra.llm import bpe, language, toxicity
from cadastra.llm import queries as Q
from cadastra.llm import recurrent as R
from cadastra.llm.words import text_bytes


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(Q.RANKS, Q.PATTERN)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(Q.RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=Q.PATTERN, mergeable_ranks=ranks, special_tokens={})


SIGNS = ["a", "e", "th", "ing", "er", "é", "ß", "漢", "😀", " ", "  ", "\n", "'s", "'", "1", "23", ".", "!!", "\u0300", "\u00a0", "<|endoftext|>", "\x85"]


def test_encoding_equals_the_library(codec, library):
    r = random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice(SIGNS) for _ in range(r.randint(0, 40)))
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert "".join(codec.decode(ids)) == text
    assert codec.encode("") == [] and "".join(codec.decode([])) == ""


def test_transducer_equals_the_defining_merges(codec):
    r = random.Random(2)
    machine = codec.pieces.transducer
    for _ in range(3000):
        piece = bytes(r.choice(b"abcdehinrst \xc3\xa9\xe2\x80\x99") for _ in range(r.randint(1, 24)))
        want = [machine.ranks[piece]] if piece in machine.ranks else bpe.merge(piece, machine.ranks)
        assert list(machine.encode(piece)) == want


def test_lookahead_is_bounded(codec):
    """No state holds back more bytes than the longest entry has."""
    machine = codec.pieces.transducer
    machine.encode(b"abcdefgh" * 500)
    longest = max(map(len, machine.ranks))
    assert max(len(body) for body, _, _ in machine.rows) <= longest


def test_utf8_machine_waits_for_whole_characters():
    text = "aé漢😀\u07ff\uffff\U0010ffff"
    data = text.encode()
    for size in (1, 2, 3, 5):
        machine = bpe.Utf8()
        parts = [machine.feed(data[i : i + size]) for i in range(0, len(data), size)]
        assert "".join(parts) + machine.finish() == text
    for bad in (b"\xff", b"\xe2\x82", b"\xed\xa0\x80x", b"\xf4\x90\x80\x80", b"\xc0\x80", b"a\x80b", b"\xf0\x9f\x98"):
        machine = bpe.Utf8()
        streamed = "".join(machine.feed(bad[i : i + 1]) for i in range(len(bad))) + machine.finish()
        assert streamed == bad.decode("utf-8", "replace")


def test_codec_on_tables(spark, codec):
    rows = [(1, "Hello world"), (2, None), (2, ""), (None, "x" * 100_000), (3, "été " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' AS ids", "1 AS n_tokens")
    got = sorted(((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, Q.RANKS, Q.PATTERN).collect()))
    want = []
    for i, text in rows:
        ids = codec.encode(text or "")
        joined = " ".join(map(str, ids))
        want.append((i or 0, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = bpe.decode_ids(bpe.encode_texts(df, Q.RANKS, Q.PATTERN), Q.RANKS, Q.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in rows)
    assert bpe.round_trip(df.limit(0), Q.RANKS, Q.PATTERN).count() == 0


def check_gradients(params, step, names):
    _, grads = step()
    rng = np.random.default_rng(0)
    for name in names:
        for _ in range(4):
            spot = tuple(rng.integers(0, n) for n in params[name].shape)
            if name.startswith(("T", "E")):
                spot = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
            old = params[name][spot]
            sides = []
            for delta in (1e-3, -1e-3):
                params[name][spot] = old + delta
                sides.append(step()[0])
            params[name][spot] = old
            slope = (sides[0] - sides[1]) / 2e-3
            assert grads[name][spot] == pytest.approx(slope, rel=0.05, abs=2e-4), name


def test_backpropagation_through_time_of_the_language_network():
    rng = np.random.default_rng(4)
    network = language.Network(["a", "b", "c"], units=5)
    for key in network.params:
        network.params[key] = network.params[key].astype(np.float64)
    symbols = rng.integers(97, 101, (9, 6)).astype(np.uint8)
    mask = (np.arange(9)[:, None] < np.array([9, 9, 4, 1, 7, 9])[None, :]).astype(np.float32)
    target = np.array([0, 1, 2, 0, 1, 2])
    check_gradients(network.params, lambda: network.step(symbols, mask, target), ["Tf", "Tb", "Uf", "Ub", "V", "c"])


def test_backpropagation_through_time_of_the_toxicity_network():
    texts = ["you fool and clown " * 3, "nice day in the park", "clown", "a nice fool day " * 30]
    words = toxicity.Words(*text_bytes(pa.array(texts)))
    network = toxicity.Network(np.unique(words.word), np.unique(words.group), seed=2)
    spans = R.windows(words.ends, toxicity.STEPS, toxicity.STRIDE)
    step = lambda: network.step(words, spans, np.array([1, 0, 1, 0]))
    check_gradients(network.params, step, ["Uf", "Ub", "A", "q", "w", "b", "Wf", "Wb", "Ew", "Ec"])


def test_windows_cover_every_unit():
    ends = np.array([0, 5, 5, 70, 300])
    starts, lengths, text = R.windows(ends, 64, 32)
    for t, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        seen = {u for s, n, x in zip(starts, lengths, text, strict=True) if x == t for u in range(s, s + n)}
        assert seen == set(range(a, b))


SYLLABLES = {"aa": ["ba", "be", "bi"], "zz": ["zu", "zo", "çé"]}


def phrase(r, label, count):
    return " ".join("".join(r.choice(SYLLABLES[label]) for _ in range(r.randint(1, 4))) for _ in range(count))


def test_language_on_tables(spark):
    r = random.Random(6)
    rows = [(i, phrase(r, lang, r.randint(1, 60)), lang) for i in range(160) for lang in [r.choice(["aa", "zz"])]]
    rows += [(500, None, "aa"), (501, "", "aa"), (502, "12 34 !?", "zz"), (None, "ba be", None), (503, "zu", None), (0, rows[0][1], rows[0][2])]
    rows += [(504, "ba " * 90000, "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1D AS score", "'p' AS piece")
    got = language.predict(df, language.fit(df)).collect()
    assert len(got) == len(rows)
    truth = {i: lang for i, _, lang in rows}
    held = [x for x in got if x.held_out and x.doc_id is not None and truth[x.doc_id] and x.doc_id < 500]
    assert held and sum(x.lang_pred == truth[x.doc_id] for x in held) >= 0.9 * len(held)
    assert all(x.lang_pred == "und" for x in got if x.doc_id in (500, 501, 502))
    assert all(0 <= x.score <= 1 for x in got)
    unlabelled = df.withColumn("lang", df.lang.substr(1, 0)).filter("false")
    assert {x.lang_pred for x in language.predict(df, language.fit(unlabelled)).collect()} == {"und"}
    assert language.predict(df.limit(0), None).count() == 0


def test_toxicity_on_tables(spark):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        text = phrase(r, "aa", r.randint(5, 150)).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(max(1, len(text) // 40)):
                text[r.randrange(len(text))] = "grr" + r.choice(SYLLABLES["aa"])
        rows.append((i, " ".join(text)))
        labels.append((i, None, int(bad)))
    rows += [(900, None), (901, ""), (902, "?!"), (None, "ba be"), (0, rows[0][1]), (903, "ba " * 60000 + "grrba"), (904, "ba " * 60000)]
    labels += [(0, 1, 1), (5000, 0, 1), (None, 0, 1), (1, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1D AS score", "'t' AS toxic", "0 AS predicted")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    network = toxicity.fit(docs, marks)
    got = toxicity.predict(docs, network).collect()
    assert len(got) == len(rows)
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 240]
    right = sum(x.predicted == int(x.doc_id % 4 == 0) for x in held)
    assert held and right >= 0.9 * len(held)
    by_id = {x.doc_id: x for x in got}
    assert by_id[903].score > by_id[904].score
    assert all(x.predicted == (x.score >= 0.7) and 0 <= x.score <= 1 for x in got)
    assert all(by_id[i].predicted == 0 for i in (900, 901, 902))
    kept = toxicity.keep_clean(docs, network)
    assert kept.columns == docs.columns
    assert kept.count() == sum(x.predicted == 0 for x in got)
    one_label = toxicity.fit(docs, marks.filter("toxic = 1"))
    assert {x.score for x in toxicity.predict(docs, one_label).collect()} == {1.0}
    assert {x.score for x in toxicity.predict(docs, toxicity.fit(docs, marks.limit(0))).collect()} == {0.0}
    assert toxicity.predict(docs.limit(0), network).count() == 0


def test_toxicity_learns_from_long_texts(spark):
    """A label that only long texts have, or few of the documents at hand, is in the sample."""
    clean, toxic = "ba be bi " * 4000, "grrba grrbe " * 3000
    rows = [(i, toxic if i % 2 else "ba be " * (i + 1)) for i in range(60)]
    docs = spark.createDataFrame([*rows, (0, clean), (0, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, None, i % 2) for i in [*range(60), *range(10**6, 10**6 + 4000)]], "doc_id long, quality int, toxic int")
    found = toxicity.sample(docs, marks, per_class=100)
    wanted = [i for i in range(60) if i % 2 and i in set(docs.filter(toxicity.bucket_of("doc_id", toxicity.FOLDS) != toxicity.HELD_OUT).toPandas()["doc_id"])]
    assert (found["toxic"] == 1).sum() == len(wanted) > 0 and (found["toxic"] == 0).sum() > 0
    assert found["text"].str.len().max() == toxicity.MOST_CHARS
    assert all(("grr" in t) == bool(x) for t, x in zip(found["text"], found["toxic"], strict=True))
    assert isinstance(toxicity.fit(docs, marks), toxicity.Network)
    short = toxicity.sample(docs.filter("length(text) <= 8000"), marks, per_class=100)
    assert set(short["toxic"]) == {0}


def test_every_language_is_learned(spark, monkeypatch):
    """More than 64 languages, the rarest with few rows, and a bound on the whole sample."""
    names = [f"l{k:02d}" for k in range(90)]
    rows = [(1000 * k + i, chr(0x100 + k) * 30 + f" {i}", name) for k, name in enumerate(names) for i in range(100 - k)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(language.sample(df)["lang"]) == set(names)
    monkeypatch.setattr(language, "MOST_ROWS", 180)
    few = language.sample(df)
    assert set(few["lang"]) == set(names) and len(few) < 1000
    network = language.train([p.encode() for p in few["piece"]], list(few["lang"]), rounds=2)
    assert network.labels == names
    assert len(language.predict(df.limit(50), network).collect()) == 50
