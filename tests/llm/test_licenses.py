"""The license scan against plain Python: base places by word lists, rules one by one, overlaps pair by pair."""

from __future__ import annotations

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from cadastra.llm import licenses as L
from cadastra.llm.license_rules import RULES

KNOWN = L.Rules(RULES)


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text or "")) if w]


def base(text):
    """(number of words, places, first, last, labels) by comparing lists of words."""
    found = words(text)
    spots = sorted(
        (i, label) for phrase, label in L.PHRASES.items() for i in range(len(found))
        if found[i : i + len(phrase.split())] == phrase.split()
    )
    ends = (spots[0][0], spots[-1][0]) if spots else (None, None)
    return len(found), len(spots), *ends, sorted({label for _, label in spots})


def detections(text):
    """All rules on all texts without a gate, then every pair of detections looked at."""
    found = words(text)
    found = ["license" + w[7:] if w.startswith("licence") else w for w in found]
    body = " " + " ".join(found) + " "
    every = []
    for number, (label, kind, _, pattern) in enumerate(RULES):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", body):
            first = body[: m.start()].count(" ") - 1
            every.append((L.ORDER[kind], number, label, kind, first, first + m[0].count(" ")))
    kept = []
    for one in sorted(every, key=lambda d: (d[0], d[4] - d[5], d[4], d[1])):
        inside = any(k[4] <= one[4] and one[5] <= k[5] for k in kept)
        around = any(one[4] <= k[4] and k[5] <= one[5] for k in kept)
        if not inside and not around:
            kept.append(one)
    return sorted((d[4], d[5], d[2], d[3]) for d in kept)


@pytest.mark.parametrize(("text", "labels"), [
    ("Released under the MIT license.", ["mit"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache-2"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc", "cc-by-nc-4"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3"]),
    ("the GNU Lesser General Public Licence v2.1", ["lgpl-2.1"]),
    ("SPDX-License-Identifier: GPL-3.0-or-later", ["gpl-3-or-later"]),
    ("see https://creativecommons.org/licenses/by-sa/4.0/ for it", ["cc-by-sa"]),
    ("Redistribution and use in source and binary forms, with or without\n modification, are permitted", ["bsd"]),
    ("the new BSD license (3-clause BSD)", ["bsd-3"]),
    ("licensed under a house license", ["unnamed"]),
    ("tous droits réservés", ["proprietary"]),
    ("der Mann mit dem Hut, by and large", []),
    ("smitten apachelicense version 2", []),
])
def test_labels(text, labels):
    assert L.scan_text(text, KNOWN, L.PHRASES)[5] == labels


def test_every_rule_finds_its_own_words_and_has_its_keywords():
    assert len(RULES) >= 200 and len({r[3] for r in RULES}) == len(RULES)
    for label, kind, keywords, pattern in RULES:
        assert kind in L.WEIGHTS and "," not in label
        # The shortest text of the pattern: options left out, first alternatives, gaps empty.
        plain = pattern
        plain = re.sub(r"\(\?: \[\^ \]\+\)\{(\d),\d\}", lambda m: " filler" * int(m[1]), plain)
        plain = re.sub(r"\[(.)[^\]]*\]", r"\1", plain)
        while "(?:" in plain:
            plain = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(\??)", lambda m: "" if m[2] else m[1], plain)
        plain = re.sub(r".\?", "", plain).strip()
        assert re.fullmatch(pattern, plain), pattern
        # Keywords that only an optional part holds would close the gate wrongly.
        assert set(keywords.split()) <= set(plain.split()), (pattern, plain)
        assert any(f.label == label for f in KNOWN.detect(L.normalised(plain)))


PARTS = ["under the mit license", "MIT Licence", "apache license version 2", "2.0", "Apache", "CC BY-NC", "4.0", "cc by nc nd 4 0",
         "gnu general public license", "version 3", "lesser", "license", "public domain", "all rights reserved", "see the license file",
         "licensed under the", "GPL", "spdx license identifier", "bsd 3 clause", "the", "mit", "by", "x", "é", "released under a",
         "creative commons attribution", "sharealike", "4 0", "international", "\n", ",", "under the mit license"]


def test_scan_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(PARTS) for _ in range(r.randint(0, 30)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "under the MIT license " * 20_000), (None, "mit license"),
             (1004, "same cc by nc"), (1004, "same cc by nc"), (1005, "é" * 300_000), (1006, "\x00mit\x7flicense")]
    clash = {c: F.lit("x") for c in ("n_words", "labels", "score", "label", "detections")}
    found = L.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash)).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t in rows:
        texts[i] = t
    for x in found:
        text = texts[x.doc_id]
        count, places, first, last, labels = base(text)
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == (count, places, first, last, labels)
        if x.doc_id != 1003:
            spans = detections(text)
            assert [(d.first, d.last, d.label, d.kind) for d in x.detections] == spans
        else:
            spans = [(d.first, d.last, d.label, d.kind) for d in x.detections]
            assert len(spans) == 20_000 and {s[2] for s in spans} == {"mit"}
        assert x.labels == sorted({*labels, *(s[2] for s in spans)})
        assert x.score == max([L.WEIGHTS[s[3]] for s in spans] + [0.7] * bool(labels), default=0.0)
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registered_query(spark, folder):
    from cadastra.llm import queries as Q

    docs = {x.doc_id: x.text for x in Q.table(spark, folder, "documents").select("doc_id", "text").collect()}
    rows = Q.op12_licenses(spark, folder).collect()
    assert sorted(x.doc_id for x in rows) == sorted(docs)
    assert sum(x.n_base for x in rows) > 0
    for x in rows:
        count, places, first, last, labels = base(docs[x.doc_id])
        assert (x.n_words, x.n_base, x.first_word, x.last_word) == (count, places, first, last)
        assert x.base_labels == ",".join(labels)
        spans = detections(docs[x.doc_id])
        assert x.labels == ",".join(sorted({*labels, *(s[2] for s in spans)}))
