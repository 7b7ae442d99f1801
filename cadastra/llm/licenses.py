"""License scan: ordered signature rules behind a keyword gate, overlaps resolved by containment.

A text is read as words (runs of ASCII letters, digits and signs beyond ASCII; letters in lower case). Two
readers run over it. The base reader finds every place where the words of a given phrase stand one after
the other. The rule reader tries the hand-written patterns of ``license_rules`` whose keywords all
stand in the text; the others, nearly all in most texts, are never run. Of two detections one of which
lies inside the other, the less certain kind goes, of one kind the inner one, of one place the later rule.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Mapping
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadastra.llm.common import map_slices
from cadastra.llm.license_rules import RULES

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Certainty of the kinds of rules; a phrase of the base reader counts as a name.
WEIGHTS = {"tag": 1.0, "text": 0.95, "version": 0.9, "name": 0.7, "hint": 0.4}
ORDER = {kind: number for number, kind in enumerate(WEIGHTS)}
# Every byte outside words as a blank, A-Z as a-z.
READ = bytes(
    b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
DETECTION = "struct<label:string,kind:string,first:long,last:long>"
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    f"labels array<string>, detections array<{DETECTION}>, score double"
)


class Rule(NamedTuple):
    number: int
    label: str
    kind: str
    needs: frozenset[bytes]
    pattern: re.Pattern


class Found(NamedTuple):
    """A detection: first and last byte of its words, kind and number of its rule, label."""

    start: int
    stop: int
    kind: str
    number: int
    label: str


def normalised(text: str) -> bytes:
    """The words of a text, each between single blanks."""
    return b" " + b" ".join(text.encode().translate(READ).split()) + b" "


class Rules:
    """Compiled rules, reached by the first of their keywords."""

    def __init__(self, rules: Iterable[tuple[str, str, str, str]]):
        self.by_keyword: dict[bytes, list[Rule]] = {}
        for number, (label, kind, keywords, pattern) in enumerate(rules):
            first, *others = keywords.encode().split()
            whole = re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )")
            rule = Rule(number, label, kind, frozenset(others), whole)
            self.by_keyword.setdefault(first, []).append(rule)

    def gated(self, words: set[bytes]) -> list[Rule]:
        """The rules all of whose keywords are among the words, in order."""
        open_ = [r for k in self.by_keyword.keys() & words for r in self.by_keyword[k] if r.needs <= words]
        return sorted(open_, key=lambda rule: rule.number)

    def detect(self, body: bytes) -> list[Found]:
        """What the rules find in a normalised text, overlaps resolved, by place."""
        body = body.replace(b" licence", b" license")
        found = [
            Found(m.start(), m.end(), rule.kind, rule.number, rule.label)
            for rule in self.gated(set(body.split()))
            for m in rule.pattern.finditer(body)
        ]
        return resolved(found)


def resolved(found: list[Found]) -> list[Found]:
    """Detections none of which lies inside another. A kind yields to all more certain kinds, inside or
    around them; of one kind the outer one stays, of one place the earlier rule."""
    kept: list[Found] = []
    for kind in WEIGHTS:
        kept.sort()
        starts = [f.start for f in kept]
        farthest = list(accumulate((f.stop for f in kept), max))
        nearest = list(accumulate((f.stop for f in reversed(kept)), min))[::-1]
        reach = -1
        fresh = []
        for one in sorted((f for f in found if f.kind == kind), key=lambda f: (f.start, -f.stop, f.number)):
            before = bisect_right(starts, one.start)
            after = bisect_left(starts, one.start)
            inside = before > 0 and farthest[before - 1] >= one.stop
            around = after < len(kept) and nearest[after] <= one.stop
            if not inside and not around and one.stop > reach:
                fresh.append(one)
                reach = one.stop
        kept += fresh
    return sorted(kept)


def places(body: bytes, phrase: bytes) -> list[int]:
    """Byte places in a normalised text where the words of the phrase stand."""
    out, at = [], body.find(b" " + phrase + b" ")
    while at >= 0:
        out.append(at + 1)
        at = body.find(b" " + phrase + b" ", at + 1)
    return out


@lru_cache(maxsize=2)
def shared_rules(rules: tuple) -> Rules:
    """The compiled rules of a Python worker."""
    return Rules(rules)


def scan_text(text: str | None, rules: Rules, phrases: Mapping[str, str]) -> tuple:
    """The values of ``scan`` for one text, in the order of its columns."""
    body = normalised(text or "")
    base = [(at, label) for phrase, label in phrases.items() for at in places(body, phrase.encode())]
    found = rules.detect(body)
    n_words = body.count(b" ") - 1 if len(body) > 2 else 0
    if not base and not found:
        return n_words, 0, None, None, [], [], [], 0.0
    blanks = np.flatnonzero(np.frombuffer(body, np.uint8) == 32)
    word = lambda at: int(np.searchsorted(blanks, at)) - 1
    spans = [
        {"label": f.label, "kind": f.kind, "first": word(f.start), "last": word(f.stop)} for f in found
    ]
    base_labels = sorted({label for _, label in base})
    labels = sorted({*base_labels, *(f.label for f in found)})
    score = max([WEIGHTS[f.kind] for f in found] + [WEIGHTS["name"]] * bool(base))
    first, last = (word(min(base)[0]), word(max(base)[0])) if base else (None, None)
    return n_words, len(base), first, last, base_labels, labels, spans, score


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    rules: Iterable[tuple[str, str, str, str]] = RULES,
) -> DataFrame:
    """Licenses of every row of ``docs`` (doc_id, text): doc_id, n_words, n_base (places of phrases),
    first_word and last_word (their smallest and largest first word, from 0; null without any),
    base_labels, labels (of phrases and rules; distinct, sorted), detections (label, kind, first and
    last word of what the rules found) and score (certainty of the surest finding, 0 without one).

    A null or empty text has no words and no label. Places are all kept, also those that repeat or
    overlap. Rows that share an id, or have none, are read one by one; other columns are ignored.
    Texts of any length are read whole. Empty table: no rows.
    """
    phrases, rules = dict(phrases), tuple(rules)
    kinds = [pa.int64()] * 5 + [pa.list_(pa.string())] * 2
    spans = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
    kinds += [spans, pa.float64()]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "detections", "score"]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        compiled = shared_rules(rules)
        texts = part.column("text").to_pylist()
        columns = list(zip(*(scan_text(text, compiled, phrases) for text in texts), strict=True))
        if not columns:
            columns = [()] * 8
        arrays = [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds[1:], strict=True))]
        return pa.RecordBatch.from_arrays(arrays, names)

    return map_slices(docs.select("doc_id", "text"), run, SCHEMA)
