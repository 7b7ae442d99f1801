"""The fill-in-the-middle transformation against plain Python and as a round trip."""

from __future__ import annotations

import hashlib
import random
import re

import brute
import pytest
import regex
from pyspark.sql import functions as F

from cadastra.llm import infilling

SIGNS = ["a", "é", "漢", "😀", " ", "  ", "\n", "\t", "\x0b", " ", "\x85", "<", "P", ">", "<P", "S>", "M"]


def plain_version(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by findall."""
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_units_are_those_found_left_to_right():
    units = regex.compile(infilling.UNITS)
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(SIGNS) for _ in range(r.randint(0, 30)))
        found = re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        assert units.fullmatch(text).ends(1) == [m.end() for m in found]


@pytest.mark.parametrize("text", [" " * 3_000_000, "a" * 3_000_000, "a " * 1_500_000, "\n" * 1_000_000 + "end"])
def test_very_long_texts(text):
    n, low, high = infilling.split(text, regex.compile(infilling.UNITS), 7, 2**32 - 1)
    assert n == (1_500_001 if text.startswith("a a") else 1) and 0 <= low <= high <= len(text)


def test_transform_and_restore(spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choice(SIGNS) for _ in range(r.randint(0, 60)))) for i in range(-300, 300)]
    rows += [(1000, None), (1001, ""), (1002, " "), (None, "no id at all"), (None, None), (1003, "x <M> y"),
             (1004, "word " * 100_000), (1005, "same"), (1005, "same"), (2**63 - 1, "a b c"), (-(2**63), "a b c")]
    clash = {c: F.lit("x") for c in ("n", "form", "output", "prefix_chars", "parts")}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash)
    whole = infilling.restore(F.col("form"), F.col("output")).alias("whole")
    found = [tuple(x) for x in infilling.transform(df).select("*", whole).collect()]
    want = [(i, *plain_version(i, t), t or "") for i, t in rows]
    key = lambda row: tuple(map(str, row))
    assert sorted(found, key=key) == sorted(want, key=key)
    assert {row[2] for row in found} == {"plain", "spm", "psm"}
    assert infilling.transform(df.limit(0)).count() == 0


def test_every_text_or_none(spark):
    df = spark.createDataFrame([(i, f"one two {i}") for i in range(50)], "doc_id long, text string")
    assert {x.form for x in infilling.transform(df, rate=100, suffix_first=0).collect()} == {"psm"}
    assert {x.form for x in infilling.transform(df, rate=100, suffix_first=100).collect()} == {"spm"}
    assert {x.form for x in infilling.transform(df, rate=0).collect()} == {"plain"}


def test_registered_query(spark, folder):
    from cadastra.llm import queries as Q

    docs = {x.doc_id: x.text for x in Q.table(spark, folder, "documents").select("doc_id", "text").collect()}
    for x in Q.op13_infilling(spark, folder).collect():
        n, form, prefix, middle, output = plain_version(x.doc_id, docs[x.doc_id])
        assert (x.n, x.form, x.prefix_chars, x.middle_chars) == (n, form, prefix, middle)
        assert x.output_sha256 == brute.sha(output) and x.restored_sha256 == brute.sha(docs[x.doc_id] or "")
