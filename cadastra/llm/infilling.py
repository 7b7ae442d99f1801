"""Fill-in-the-middle transformation by one match with a repeated capture.

A text is a sequence of units: blanks with the word after them, or blanks at the end. One ``fullmatch``
of ``(unit)*`` by the regex library keeps every repetition of the group: ``match.ends(1)`` holds the
end of each unit, so its length is the number of units and its entries are the places where the
text can be cut. Where to cut, and in which order the parts are given, follows from a hash of
the document's id, so a repeated task gives the same rows.

plain: the text as it is; psm: prefix, suffix, middle; spm: suffix, prefix, middle, each part after its
marker. A text that contains a marker stays plain, so markers tell the parts apart again (``restore``).
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import map_slices

# Possessive, so a long text leaves no trail of states to go back to.
UNITS = r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
# Percentages: documents that are transformed, and transformed ones given suffix first.
RATE, SUFFIX_FIRST = 50, 80
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits for an id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def split(text: str, units, one: int, two: int) -> tuple[int, int, int]:
    """(number of units, end of the prefix, end of the middle) for two draws."""
    ends = units.fullmatch(text).ends(1)
    low, high = sorted((one % (len(ends) + 1), two % (len(ends) + 1)))
    return len(ends), ends[low - 1] if low else 0, ends[high - 1] if high else 0


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain) and output of every
    row of ``docs`` (doc_id, text).

    A null text counts as empty; empty texts, texts that contain a marker and all but ``rate`` percent of the
    others stay plain. A null id is drawn for as empty text. Repeated rows give equal rows; texts of any
    length are taken whole; other columns are ignored. Empty table: no rows.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        import regex

        units = regex.compile(UNITS)
        out: list[list] = [[] for _ in range(6)]
        for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
            text = text or ""
            one, two, three, four = draws(doc_id, seed)
            n, low, high = split(text, units, one, two)
            marked = PREFIX in text or SUFFIX in text or MIDDLE in text
            if not text or marked or three % 100 >= rate:
                row = (doc_id, n, "plain", None, None, text)
            else:
                prefix, middle, suffix = text[:low], text[low:high], text[high:]
                if four % 100 < suffix_first:
                    form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
                else:
                    form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
                row = (doc_id, n, form, low, high - low, output)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return map_slices(docs.select("doc_id", "text"), run, SCHEMA)


def restore(form: Column, output: Column) -> Column:
    """The text that ``transform`` was given, from form and output alone."""
    # Before the first marker nothing stands, so the parts are 1 to 3.
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )
