"""Packing by power-of-two decomposition.

A document of n ids is cut into whole sequences of ``length`` ids and the binary digits of the
rest, longest first. Every piece is a sequence of its own of a power-of-two length, so no sequence
crosses documents and nothing is padded; equal lengths form a bucket.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cadastra.llm.common import bounded, slices

LENGTH = 2048
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
# Letters and spaces below this code point have been the same in every Unicode version in use, so
# both tokenizer libraries split such texts alike.
STABLE = r"[^\x00-ɏ]"
# tiktoken's regular expressions keep a stack entry for each sign of a run of white space and end
# the process when there are too many (300,000 pass); runs from here on go through tokenizers.
LONG_RUN = r"(?<!\s)\s{10000}"


def cut(count: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` ids: each length a power of two up to ``length``."""
    pieces = [(at, length) for at in range(0, count - length + 1, length)]
    at = len(pieces) * length
    rest = count - at
    for bit in range(length.bit_length() - 2, -1, -1):
        if rest >> bit & 1:
            pieces.append((at, 1 << bit))
            at += 1 << bit
    return pieces


class Encoder:
    """Ids of a text by the vocabulary of a tokenizers file, as unsigned 32-bit numbers.

    The tokenizers library needs more CPU than the packing budget allows, so texts of plain Latin
    characters and without very long runs of white space go through tiktoken with the ranks of the
    same file, which gives the same ids; any other text goes through tokenizers. Strings of special
    tokens are ordinary text.
    """

    def __init__(self, path: str):
        import json
        import re

        import public_tokenizers
        import tiktoken

        self.path = path
        self.other = re.compile(f"{STABLE}|{LONG_RUN}")
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in vocabulary.items()}
        self.fast = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    @cached_property
    def full(self):
        """The tokenizers library's own tokenizer, loaded when a text needs it."""
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def __call__(self, text: str) -> np.ndarray:
        if self.other.search(text) is None:
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=2)
def shared_encoder(path: str) -> Encoder:
    """The encoder of a Python worker."""
    return Encoder(path)


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    bytes for themselves, the others in order from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1) -> DataFrame:
    """One row per piece of every row of ``docs`` (doc_id, text): doc_id, start, length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A null text counts as empty and gives the single id ``end_id``. offset is always 0, as each
    piece is a sequence. sequence_id is unique: the exponent of the length, the task, and a running
    number of that length in the task; a repeated task gives the same numbers. Texts of any length
    and make, such as millions of blanks, are encoded whole. Rows that share a doc_id are packed one by one. Other columns are ignored. Empty table: no rows.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("the sequence length must be a power of two")

    def run(batches):
        encode = shared_encoder(tokenizer)
        task = TaskContext.get().partitionId()
        made: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                out: dict[str, list] = {name: [] for name in ("doc", "start", "length", "ids", "all", "seq")}
                docs_, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                for doc, text in zip(docs_, texts, strict=True):
                    ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                    body = ids.tobytes()
                    for start, size in cut(len(ids), length):
                        number = made.get(size, 0)
                        made[size] = number + 1
                        out["doc"].append(doc)
                        out["start"].append(start)
                        out["length"].append(size)
                        out["ids"].append(body[4 * start : 4 * (start + size)])
                        out["all"].append(len(ids))
                        out["seq"].append((size.bit_length() - 1) << 58 | task << 34 | number)
                arrays = [pa.array(out[k], pa.int64()) for k in ("doc", "start", "length")]
                arrays += [pa.array(out["ids"], pa.binary()), pa.array(out["all"], pa.int64())]
                arrays += [pa.array(out["seq"], pa.int64()), pa.array(np.zeros(len(out["seq"]), np.int64))]
                names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return bounded(docs.select("doc_id", "text")).mapInArrow(run, SCHEMA)
