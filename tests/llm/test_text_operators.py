"""The text operators against plain Python, with nulls, empty and long texts, ties, repeated rows,
empty tables and clashing columns."""

from __future__ import annotations

import random
import re

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadastra.llm import exact, packing, sharding, simhash, spots, substrings, urls
from cadastra.llm import queries as Q

CLASH = ["kept", "key", "fp", "start", "ids", "n", "row", "size", "shard", "score", "copy", "r", "guest", "mine",
         "known", "at", "one", "two", "body", "part", "bit", "class_id", "host", "path", "rule", "verdict", "Sha256"]


def table(spark, rows):
    """(doc_id, text) rows with the other columns of documents and many clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, schema)
    return df.withColumns({c: F.lit("x") for c in CLASH})


def random_docs(seed=5, count=60, vocabulary=12):
    r = random.Random(seed)
    names = ["the", "of", "Alpha", "beta", "ÉTÉ", "x", "y1", "la", "straße", "zz", "und", "q"][:vocabulary]
    shared = [" ".join(r.choice(names) for _ in range(40)) for _ in range(4)]
    docs = []
    for i in range(count):
        kind = i % 6
        text = " ".join(r.choice(names) + r.choice(["", "", ",", "é"]) for _ in range(r.randint(0, 90)))
        if kind == 1 and docs:
            text = docs[r.randrange(len(docs))][1]
        elif kind == 2 and docs:
            text = (docs[r.randrange(len(docs))][1] or "").replace(" ", "\t ", 3)
        elif kind == 3:
            text += "\n" + r.choice(shared) + "\x0b" + r.choice(shared)
        elif kind == 4:
            text = (docs[r.randrange(len(docs))][1] or "") + " tail" + str(i)
        docs.append((i * 7 % 997, text))
    docs += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "a"), (2004, "A"), (2005, "one two"), (2006, "ONE  two"),
             (2007, "long " * 30000), (2008, "long " * 30001), (-5, "\u00a0"), (-(2**63), "least id")]
    return docs


@pytest.fixture(scope="module")
def docs():
    return random_docs()


@pytest.fixture(scope="module")
def df(spark, docs):
    return table(spark, docs).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, one id with two texts."""
    long = " ".join(f"w{i % 23}" for i in range(120))
    return table(spark, [(None, long), (None, None), (1, long), (1, long), (1, "other"), (3, long + " end"), (3, long + " end")])


# packing -----------------------------------------------------------------------------------


@pytest.mark.parametrize("count", [0, 1, 2, 7, 2047, 2048, 2049, 5000])
def test_cut_covers_every_id_once(count):
    pieces = packing.cut(count)
    assert all(n & (n - 1) == 0 and n <= 2048 for _, n in pieces)
    assert [s for s, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
    assert sum(n for _, n in pieces) == count


def test_pack_gives_the_ids_back(df, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(Q.TOKENIZER)
    tokenizer.encode_special_tokens = True
    rows = packing.pack(df, Q.TOKENIZER, 64).collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and r.offset == 0 and r.length <= 64
        assert r.start == len(by_doc.setdefault(r.doc_id, []))
        by_doc[r.doc_id] += ids
        assert r.length & (r.length - 1) == 0
    assert len({r.sequence_id for r in rows}) == len(rows)
    for doc_id, text in docs:
        assert by_doc[doc_id] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_both_tokenizer_libraries_agree():
    encode = packing.Encoder(Q.TOKENIZER)
    r = random.Random(3)
    signs = [chr(c) for c in range(0x250)] + ["the ", "ing", "  ", "\n\n", "'s", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 40)))
        assert encode(text).tolist() == encode.full.encode(text, add_special_tokens=False).ids
    mixed = "漢字 и текст 😀 the end"
    assert encode(mixed).tolist() == encode.full.encode(mixed, add_special_tokens=False).ids


def test_pack_of_very_long_runs(spark):
    """Runs of millions of one sign, alone and inside a text, give the ids of the tokenizers library."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(Q.TOKENIZER)
    tokenizer.encode_special_tokens = True
    many = 2_000_000
    texts = [" " * many, "\n" * many, "a" * many, "é" * many, " \t\u00a0" * (many // 3), f"word{' ' * many}word\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {i: [] for i in range(len(texts))}
    for r in packing.pack(df, Q.TOKENIZER).select("doc_id", "start", "ids").orderBy("doc_id", "start").collect():
        found[r.doc_id].append(r.ids)
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert b"".join(found[i]) == np.array(ids, "<u4").tobytes()


def test_pack_of_odd_rows(odd):
    rows = packing.pack(odd, Q.TOKENIZER).collect()
    assert sum(r.start == 0 for r in rows) == 7
    with pytest.raises(ValueError):
        packing.pack(odd, Q.TOKENIZER, 100)


# SimHash -----------------------------------------------------------------------------------


def test_simhash_matches_brute_force(df, docs):
    prints = {i: brute.simhash(t) for i, t in docs}
    roots = brute.components(prints)
    for r in simhash.near_duplicates(df).collect():
        assert r.fp % 2**64 == prints[r.doc_id]
        assert r.component_id == roots[r.doc_id]


@pytest.mark.parametrize("small_bucket", [1, 3, 256])
@pytest.mark.parametrize("distance", [1, 2])
def test_links_join_the_same_components(spark, small_bucket, distance):
    r = random.Random(small_bucket)
    prints = set()
    for _ in range(6):
        centre = r.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
    prints |= {0, 2**64 - 1, 1 << 63, 3}
    signed = {p - 2**64 if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.connected(simhash.links(frame, distance, small_bucket)).collect()
    got = {p: p for p in signed} | {row.node: row.root for row in found}
    want = brute.components(signed, distance)
    assert got == want


def test_simhash_of_odd_rows(odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 7
    assert {r.component_id for r in rows if r.doc_id == 1 and r.fp != 0} >= {1}
    with pytest.raises(ValueError):
        simhash.links(odd.select(F.lit(1).alias("fp")), 3)


def test_simhash_keeps_one_row_of_each_component(df, docs, odd):
    roots = brute.components({i: brute.simhash(t) for i, t in docs})
    left = simhash.keep_first(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(roots.values()))
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    prints = {t: brute.simhash(t) for _, t in rows}
    kept = [(r.doc_id, r.text) for r in simhash.keep_first(odd).collect()]
    assert all(k in rows for k in kept)
    # The long texts are one component, the empty one and "other" stand alone.
    assert len(kept) == len({brute.components(dict(enumerate(sorted(set(prints.values())))))[i] for i in range(len(set(prints.values())))})
    assert (None, None) in kept and (1, "other") in kept


# exact dedup -------------------------------------------------------------------------------


def test_exact_matches_brute_force(df, docs):
    want = sorted(brute.exact(docs))
    for in_snapshot in (None, F.lit(True), F.lit(False), F.col("doc_id") > 100):
        rows = exact.dedup(df, in_snapshot).collect()
        got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r[exact.DIGEST].hex()) for r in rows)
        assert got == want


def test_exact_keeps_one_row_of_each_group(odd):
    rows = exact.dedup(odd).collect()
    assert len(rows) == 7
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({bytes(r[exact.DIGEST]) for r in rows}) == 4
    left = exact.keep_first(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, len(r.text or "")) for r in left.collect()) == sorted(
        (r.doc_id is None, r.doc_id or 0, len(t or ""))
        for r, t in ((r, next(x.text for x in odd.collect() if exact_digest(x.text) == bytes(r[exact.DIGEST]))) for r in kept)
    )


def exact_digest(text):
    import hashlib
    import re

    return hashlib.sha256(re.sub(brute.SPACES, "", text or "").encode()).digest()


@pytest.mark.parametrize("count", [0, 1, 2, 3, 10, 1000, 40000])
def test_fuse_filter_knows_all_its_keys(count):
    rng = np.random.default_rng(count)
    keys = rng.integers(0, 2**63, count, dtype=np.int64).astype(np.uint64)
    made = exact.build_filter(keys)
    assert exact.probe_filter(keys, *made).all()
    others = rng.integers(0, 2**63, 20000, dtype=np.int64).astype(np.uint64)
    if count >= 1000:
        assert exact.probe_filter(others, *made).mean() < 0.01
        assert len(made[3]) < (1.5 if count < 5000 else 1.25) * count


# URL filters -------------------------------------------------------------------------------

RULES = [*Q.URL_RULES, ("allow", "net", "/open"), ("block", "net", "/open"), ("block", "a.b.example.org", "/x/y/z"), ("allow", "b.example.org", "/")]
URLS = [
    None, "", "no scheme", "http://", "http://net/", "HTTP://Example.NET/en/1?x", "https://x.example.net/en/", "https://x.example.net/english",
    "http://notnet/", "http://a.net", "http://a.net?x=/en/", "http://a.net/open-door", "http://a.net/Open", "ftp://a.b.example.org/x/y/zed#f",
    "http://q.a.b.example.org/x/y/", "http://example.com/de/#a", "http://example.com/de", "x://y://net/", "http://org/fr/", "http://.net/", "http://net./",
    "http://a.net:80/", "http://é.net/ä/" + "s/" * 500, "http://a\nb.net/x\ny?z", "http://a.net//open",
]


def test_urls_match_brute_force_on_both_paths(spark):
    pages = spark.createDataFrame([(i, u, "c") for i, u in enumerate([*URLS, *URLS[5:9]])], "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    want = {}
    for i, u in enumerate([*URLS, *URLS[5:9]]):
        (rule, verdict), host, path = brute.url_rule(u, RULES)
        want[i] = (host, path, rule, verdict)
    for given, most in ((RULES, 100), (rules, 100), (rules, 2)):
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, given, most=most).collect()}
        assert got == want


def test_urls_by_shards_match_one_trie(spark):
    """Many rules, one host with a third of them, hosts of many depths, paths that end within a segment."""
    r = random.Random(2)
    label = lambda: r.choice(["a", "b", "cc", "d1", "example", "x-y"])
    host = lambda: ".".join([label() for _ in range(r.randint(1, 5))] + [r.choice(["net", "org"])])
    path = lambda: "".join("/" + r.choice(["de", "en", "e", "fr", "page1", ""]) for _ in range(r.randint(0, 3)))
    rules = [(r.choice(["allow", "block"]), host(), path()) for _ in range(300)]
    rules += [("block", "hot.example.net", f"/u{r.randrange(400)}{path()}") for _ in range(150)] + [("allow", "net", "")]
    known = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls_ = [f"http://{host()}{path()}/{r.choice(['', 'de', 'english', 'q?x'])}" for _ in range(500)]
    urls_ += [f"https://www.hot.example.net/u{r.randrange(400)}/en" for _ in range(300)] + [None, "", "x://", "x://a..net/"]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    table_ = spark.createDataFrame([*known, (None, "net", "/"), ("block", None, "/"), ("block", "org", None)], "verdict string, host string, path string")
    trie = urls.build_trie(known)
    for most_bytes in (600, 5000):
        got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in urls.judge(pages, table_, most=10, most_bytes=most_bytes).collect()}
        assert len(got) == len(urls_)
        for host_, path_, rule, verdict in got.values():
            assert (rule, verdict) == (urls.match(trie, host_, path_) or (None, "allow"))
    for i, u in list(enumerate(urls_))[::40]:
        (rule, verdict), h, p = brute.url_rule(u, known)
        assert got[i] == (h, p, rule, verdict)
    assert sum(x[2] is not None for x in got.values()) > 500


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert urls.judge(pages, [], default="block").first().verdict == "block"
    assert urls.judge(pages.limit(0), RULES).count() == 0


# sharding ----------------------------------------------------------------------------------


def test_shards_are_numbered_and_growth_moves_into_the_new_one(df, docs, odd):
    for frame, count in ((df, len(docs)), (odd, 7)):
        rows = sharding.assign(frame, 5).collect()
        assert len(rows) == count
        for s in {r.shard for r in rows}:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
        assert all(r.grown_shard in (r.shard, 5) for r in rows)
    sizes = {r.doc_id: (r["size"], r.text_crc32) for r in sharding.assign(df, 5).collect()}
    assert sizes == {i: (len((t or "").encode()) + 16, brute.crc(t or "")) for i, t in docs}


def descended(key, tree, weights=None):
    """The descent by plain Python: the least draw of each level."""
    import math

    import xxhash

    weights = weights or {}
    live = {p: weights.get(p[2], 1.0) for p in tree if weights.get(p[2], 1.0) > 0}
    path = ()
    for level in (1, 2, 3):
        draws = []
        for name in sorted({p[:level] for p in live if p[: level - 1] == path}):
            # Spark hashes several values by seeding each with the hash before.
            h = xxhash.xxh64_intdigest(level.to_bytes(4, "little", signed=True), 42)
            h = xxhash.xxh64_intdigest(name[-1].to_bytes(4, "little", signed=True), h)
            h = xxhash.xxh64_intdigest(key.encode(), h)
            weight = sum(w for p, w in live.items() if p[:level] == name)
            draws.append((-math.log(((h >> 11) + 0.5) / 2**53) / weight, name))
        path = min(draws)[1]
    return path[2]


def test_shards_equal_a_descent_by_plain_python(df, spark):
    tree, weights = sharding.layout(11, 2), {3: 2.5, 7: 0.25, 4: 0}
    ids = spark.range(600).select(F.col("id").cast("string").alias("k"))
    for w in (None, weights):
        for r in ids.select("k", sharding.shard_of(F.col("k"), tree, w).alias("s")).collect():
            assert r.s == descended(r.k, tree, w)
    for r in sharding.assign(df, 40).collect():
        key = str(r.doc_id)
        assert (r.shard, r.grown_shard) == (descended(key, sharding.layout(40)), descended(key, sharding.layout(40, 1)))


def test_weights_confine_movement(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("k"))
    tree = sharding.layout(12)
    place = {p[2]: p for p in tree}
    columns = {
        "even": sharding.shard_of(F.col("k"), tree), "more": sharding.shard_of(F.col("k"), tree, {3: 2.0}),
        "gone": sharding.shard_of(F.col("k"), tree, {3: 0}), "grown": sharding.shard_of(F.col("k"), sharding.layout(12, 1)),
        "swapped": sharding.shard_of(F.col("k"), tree, {3: 1.5, 11: 0.5}),
    }
    rows = ids.select(*[c.alias(n) for n, c in columns.items()]).collect()
    region, rack = (lambda s: place[s][0]), (lambda s: place[s][:2])
    # Rows come into the region that gained, and there into the rack and the shard; all others stay.
    assert all(r.more == r.even or region(r.more) == region(3) for r in rows)
    assert all(r.more in (r.even, 3) for r in rows if rack(r.more) == rack(r.even) == rack(3))
    assert all(rack(r.more) in (rack(r.even), rack(3)) for r in rows if region(r.even) == region(3))
    assert all(r.gone == r.even or region(r.even) == region(3) for r in rows)
    assert all(r.gone != 3 for r in rows)
    # Weight that moves within a rack moves rows within it only: the level above decides for itself.
    assert rack(3) == rack(11) and all(r.swapped == r.even or (r.even, r.swapped) == (11, 3) for r in rows)
    assert any(r.swapped != r.even for r in rows)
    assert all(r.grown in (r.even, 12) for r in rows)
    assert abs(sum(r.more == 3 for r in rows) / 20000 - 2 / 13) < 0.01
    assert abs(sum(r.grown == 12 for r in rows) / 20000 - 1 / 13) < 0.01
    for s in range(12):
        assert abs(sum(r.even == s for r in rows) / 20000 - 1 / 12) < 0.01
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("k"), [(0, 0, 0)], {0: 0})


# substring dedup ---------------------------------------------------------------------------


@pytest.mark.parametrize("window", [5, 50])
def test_substrings_match_brute_force(df, docs, window):
    want = sorted(brute.substrings(docs, window))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.report(df, window).collect())
    assert got == want
    cleaned = substrings.remove(df, window)
    assert cleaned.columns == df.columns
    shas = {r.doc_id: (brute.sha(" ".join(brute.words(r.text))), r.n_chars) for r in cleaned.collect()}
    assert {i: s for i, (s, _) in shas.items()} == {w[0]: w[3] for w in want}
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    untouched = {w[0] for w in want if w[2] == 0}
    assert all(texts[i] == t for i, t in docs if i in untouched)
    assert all(n is None or n == len(texts[i]) for i, (_, n) in shas.items())


def test_substrings_of_odd_rows(odd):
    rows = substrings.report(odd).collect()
    assert len(rows) == 7
    gone = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in rows)
    # Equal ids and null ids remove nothing from each other; id 3 repeats what id 1 has.
    assert gone == sorted([(True, 0, 120, 0), (True, 0, 0, 0), (False, 1, 120, 0), (False, 1, 120, 0), (False, 1, 1, 0), (False, 3, 121, 120), (False, 3, 121, 120)])
    assert sorted(r.text or "" for r in substrings.remove(odd).collect())[1:4] != []


@pytest.mark.parametrize("spare", [-6, 0, 4])
def test_the_sketch_never_counts_too_little(spark, monkeypatch, spare):
    """Whatever its width, every anchor of two rows passes; narrow ones let more of the others through."""
    monkeypatch.setattr(substrings, "SPARE_BITS", spare)
    r = random.Random(8)
    rows = [(i, r.getrandbits(63), [r.getrandbits(64) - 2**63 for _ in range(r.randint(0, 40))]) for i in range(200)]
    shared = [r.getrandbits(64) - 2**63 for _ in range(30)]
    for a in shared:
        for i in r.sample(range(200), 2):
            rows[i][2].append(a)
    df = spark.createDataFrame(rows, "doc_id long, key long, anchors array<long>")
    found = [(x.anchor, x.doc_id, x.key) for x in substrings.screened(df).collect()]
    assert {(a, i, k) for i, k, own in rows for a in own if a in shared} <= set(found)
    assert set(found) <= {(a, i, k) for i, k, own in rows for a in own} and len(found) == len(set(found))
    assert substrings.screened(df.limit(0)).count() == 0


def test_the_sketch_grows_with_the_anchors(spark):
    """At ten times the anchors of the largest test table, and at a hundredth of that, it lets the same small
    share of unique anchors through."""
    from cadastra.llm import hashed

    for docs, each in ((100, 250), (2500, 1000)):
        ids = F.sequence(F.lit(1), F.lit(each))
        anchors = F.transform(ids, lambda i: F.xxhash64(F.col("id"), i)).alias("anchors")
        df = spark.range(docs).select(F.col("id").alias("doc_id"), F.col("id").alias("key"), anchors)
        let_through = substrings.screened(df).count() / (docs * each)
        assert let_through <= 0.01
    keys = np.array([0, 5, 2**62, 2**63 + 1], np.uint64)
    assert (hashed.unpack_keys(hashed.pack_keys(keys)) == keys).all()



# SpotSigs ----------------------------------------------------------------------------------


def test_spots_match_brute_force(df, docs):
    after = brute.edited(docs)
    texts = dict(docs)
    sets = {i: brute.spot_set(t, spots.COMMON) for i, t in docs}
    prints = {}
    for r in spots.compare_edits(df).collect():
        changed, following = after[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(texts[r.doc_id] or ""), brute.sha(changed))
        assert r.near_edited == pytest.approx(brute.likeness(sets[r.doc_id], brute.spot_set(changed, spots.COMMON)))
        assert r.near_next == pytest.approx(brute.likeness(sets[r.doc_id], sets[following]))
        prints[r.doc_id] = r.fingerprint
    assert all((sets[a] == sets[b]) == (prints[a] == prints[b]) for a in texts for b in texts)


def test_spots_of_odd_rows(odd, spark):
    assert spots.compare_edits(odd).count() == 7
    one = spots.compare_edits(table(spark, [(1, "the big cat")])).first()
    assert (one.near_next, one.edited_sha256) == (1.0, brute.sha("the big " + "the"))


@pytest.mark.parametrize("least", [0.5, 0.8])
def test_near_pairs_match_brute_force(df, docs, least):
    members, pairs = spots.near_pairs(df, least)
    classes = {r.doc_id: r.class_id for r in members.collect()}
    sets = {i: brute.spot_set(t, spots.COMMON) for i, t in docs}
    assert all((classes[a] == classes[b]) == (sets[a] == sets[b]) for a in sets for b in sets)
    heads = sorted(set(classes.values()))
    want = {
        (a, b): brute.likeness(sets[a], sets[b])
        for a in heads for b in heads
        if a < b and sets[a] and sets[b] and brute.likeness(sets[a], sets[b]) >= least
    }
    assert {(r.a, r.b): r.likeness for r in pairs.collect()} == pytest.approx(want)


def test_linked_classes_match_brute_force(spark):
    """Near texts of many lengths, a signature that all share, copies, null ids and texts, an id with two texts."""
    r = random.Random(11)
    name = lambda: "".join(r.choice("kolamiseru") for _ in range(5))
    prose = lambda n: " ".join(("the " if r.random() < 0.4 else "") + name() for _ in range(n))
    shared = "the same old words of every single page the"
    docs = []
    for base in range(12):
        words = prose(r.choice([4, 15, 40, 120])).split()
        for copy in range(6):
            changed = [name() if r.random() < 0.01 * copy else w for w in words]
            docs.append((len(docs) + 1, shared + " " + " ".join(changed)))
    docs += [(len(docs) + 1, docs[3][1]), (len(docs) + 2, None), (len(docs) + 3, ""), (len(docs) + 4, shared)]
    frame = table(spark, docs)
    common = ["the", "of"]
    sets = {i: spot_runs(t, common) for i, t in docs}
    heads = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    links = {
        i: sum(bool(sets[i] and sets[j]) and brute.likeness(sets[i], sets[j]) >= 0.8 for j in set(heads.values()) - {heads[i]})
        for i in sets
    }
    got = spots.compare_and_link(frame, common, run=3).collect()
    assert {x.doc_id: (x.class_id, x.links) for x in got} == {i: (heads[i], links[i]) for i in sets}
    assert sum(links.values()) > 20 and len(got) == len(docs)
    asked = {heads[i] for i in sets if i % 3 == 0}
    some = spots.compare_and_link(frame, common, run=3, asked=F.col("doc_id") % 3 == 0).collect()
    assert {x.doc_id: x.links for x in some} == {i: links[i] if heads[i] in asked else None for i in sets}

    first, second, third = (prose(30) for _ in range(3))
    odd = [(1, first), (2, second), (2, third), (2, second), (3, f"{second} end"), (None, first), (None, "the lonely words of one")]
    rows = spots.compare_and_link(table(spark, odd), common, run=3).collect()
    assert len(rows) == len(odd)
    assert {x.class_id for x in rows if x.doc_id is None} == {1, None}
    assert [x.class_id for x in rows if x.doc_id == 2] == [2] * 3
    assert [(x.class_id, x.links) for x in rows if x.doc_id == 3] == [(3, 1)]
    assert spots.compare_and_link(frame.limit(0), common, run=3).count() == 0


def spot_runs(text, common, run=3, gap=20, chain=2):
    """Chains, and runs of words where no chain begins, by plain Python."""
    found = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    begins, out = [-1], set()
    for i, w in enumerate(found):
        after = [x for x in found[i + 1 :] if x not in common][:chain]
        if w in common and len(after) == chain:
            out.add((w, *after))
            begins.append(i)
    for a, b in zip(begins, [*begins[1:], len(found)], strict=True):
        if found and (b - a - 1 >= gap or len(begins) == 1):
            out |= {("run", *found[i : min(i + run, len(found))]) for i in range(a + 1, max(a + 2, b - run + 1))}
    return out


def test_spots_with_runs_match_brute_force(spark, docs):
    # Long runs of one word would take plain Python too long.
    short = [(i, t) for i, t in docs if len(t or "") < 10000]
    common = ["the", "of", "la"]
    after, sets = brute.edited(short), {i: spot_runs(t, common) for i, t in short}
    prints = {}
    for r in spots.compare_edits(table(spark, short), common, run=3).collect():
        changed, following = after[r.doc_id]
        assert r.near_edited == pytest.approx(brute.likeness(sets[r.doc_id], spot_runs(changed, common)))
        assert r.near_next == pytest.approx(brute.likeness(sets[r.doc_id], sets[following]))
        prints[r.doc_id] = r.fingerprint
    assert all((sets[a] == sets[b]) == (prints[a] == prints[b]) for a in sets for b in sets)


def test_spots_of_other_languages(spark):
    """Words are counted, not listed: an unknown language has anchors, and word lists have runs."""
    r = random.Random(3)
    name = lambda: "".join(r.choice("kolamiseru") for _ in range(6))
    prose = [(i, " ".join(r.choice(["ja", "ei", "on"]) if r.random() < 0.3 else name() for _ in range(90))) for i in range(40)]
    lists = [(100 + i, " ".join(name() for _ in range(90))) for i in range(40)]
    docs = table(spark, prose + lists).withColumn("lang", F.when(F.col("doc_id") < 100, "fi").otherwise(F.lit(None)))
    common = spots.frequent_words(docs)
    assert common == ["ei", "ja", "on"]
    got = spots.compare_edits(docs, common, run=spots.RUN).collect()
    assert all(x.near_edited > 0.2 for x in got)
    sets = {i: spots.spot_signatures(F.lit(t), ["the", "of"], run=spots.RUN).alias(f"s{i}") for i, t in enumerate(["the cat", "cat of", "the of", ""])}
    row = spark.range(1).select(*sets.values()).first()
    assert len({tuple(x) for x in row}) == 4 and row[3] == []
    assert spots.frequent_words(docs.limit(0)) == []


# empty tables ------------------------------------------------------------------------------


def test_empty_tables(spark, df):
    none = df.limit(0)
    frames = [
        packing.pack(none, Q.TOKENIZER), simhash.near_duplicates(none), exact.dedup(none), exact.keep_first(none),
        sharding.assign(none, 4), substrings.report(none), substrings.remove(none), spots.compare_edits(none), spots.near_pairs(none)[1],
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
    assert pa.__version__ and public_tokenizers.PATTERN
