"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

The ids of a string are those whose neighbouring pairs are all stable (the pair, encoded alone,
gives itself back), so the last id of every prefix follows from the ids that end before it. After
some bytes only those boundaries matter from which a longer id may still grow. The transducer's
state is exactly that: the open boundaries with their ids since the last boundary common to all,
relative to it. Moving by one byte emits the ids that all open boundaries now share, which happens
within the length of the longest id. States and moves are made when first needed and kept in a
table of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from cadastra.llm.common import bounded, slices

MOST_MOVES = 800_000
MOST_PIECES = 600_000
CHUNK = 4096
# Keys of a state's row beside the bytes.
STATE, REST = -1, -2


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The defining procedure: merge the neighbours of lowest rank, leftmost first."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, len(ranks) + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank > len(ranks):
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes byte strings by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.prefixes = {token[:i] for token in ranks for i in range(1, len(token))}
        # Ids the merges never give back (if any) can't be the last id of a prefix.
        self.stable_pairs: dict[tuple[int, int], bool] = {}
        self.reached: dict[int, bool] = {}
        # A state: bytes since the first open boundary, the id before the common boundary (-1: none,
        # -2: it no longer matters), and for each open boundary its offset in the bytes and the ids
        # from the common boundary to it. Its row maps a byte to (row, ids to emit), and also holds
        # the state itself and the ids that are left if the input ends there.
        self._reset()

    def _reset(self) -> None:
        self.rows: dict[tuple, dict] = {}
        self.count = 0
        self.start = self._row((b"", -1, ((0, ()),)))

    def _row(self, state: tuple) -> dict:
        row = self.rows.get(state)
        if row is None:
            row = self.rows[state] = {STATE: state, REST: state[2][-1][1]}
        return row

    def _own(self, token: int) -> bool:
        known = self.reached.get(token)
        if known is None:
            known = self.reached[token] = merge(self.bytes_of[token], self.ranks) == [token]
        return known

    def _stable(self, one: int, two: int) -> bool:
        if one < 0:
            return True
        known = self.stable_pairs.get((one, two))
        if known is None:
            joined = self.bytes_of[one] + self.bytes_of[two]
            known = self.stable_pairs[one, two] = merge(joined, self.ranks) == [one, two]
        return known

    def _move(self, row: dict, byte: int) -> tuple[dict, tuple[int, ...]]:
        body, before, opened = row[STATE]
        body += bytes([byte])
        path = None
        for offset, ids in opened:
            token = self.ranks.get(body[offset:])
            if token is not None and self._own(token) and self._stable(ids[-1] if ids else before, token):
                path = (*ids, token)
                break
        still = [(offset, ids) for offset, ids in opened if body[offset:] in self.prefixes]
        if path is None:
            raise ValueError("the vocabulary does not cover all bytes")
        still.append((len(body), path))
        shared = 0
        shortest = min(len(ids) for _, ids in still)
        while shared < shortest and len({ids[shared] for _, ids in still}) == 1:
            shared += 1
        done = path[:shared]
        low = still[0][0]
        still = tuple((offset - low, ids[shared:]) for offset, ids in still)
        before = done[-1] if done else before
        state = (body[low:], before if any(not ids for _, ids in still) else -2, still)
        self.count += 1
        step = row[byte] = (self._row(state), done)
        return step

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece; a piece that is an entry of the vocabulary is that entry."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if self.count > MOST_MOVES:
            self._reset()
        out: list[int] = []
        row = self.start
        for byte in piece:
            row, done = row.get(byte) or self._move(row, byte)
            if done:
                out += done
        return (*out, *row[REST])


class Pieces(dict):
    """Ids of the pieces met so far; forgets all when it has grown to ``MOST_PIECES``."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MOST_PIECES:
            self.clear()
        ids = self.transducer.encode(piece.encode())
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Codec:
    """Text to ids and back, for the ranks of a file and a pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(Transducer(ranks))
        self.bytes_of = [self.pieces.transducer.bytes_of[i] for i in range(len(ranks))]
        self.decimal = [str(i) for i in range(len(ranks))]

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Text of a stream of ids in order; characters cut between ids wait for their rest."""
        machine, held = Utf8(), []
        for i in ids:
            held.append(self.bytes_of[i])
            if len(held) == CHUNK:
                yield machine.feed(b"".join(held))
                held = []
        yield machine.feed(b"".join(held)) + machine.finish()


@lru_cache(maxsize=2)
def shared_codec(path: str, pattern: str) -> Codec:
    """The codec of a Python worker; its tables serve all tasks that run there."""
    return Codec(path, pattern)


class Utf8:
    """Incremental UTF-8: states are the lower and upper bound of the next byte and how many follow.

    Only the end of what arrives can be incomplete, so the machine runs over its last three bytes;
    what precedes is decoded at once. Bytes that are not UTF-8 become U+FFFD.
    """

    def __init__(self):
        self.rest = b""

    @staticmethod
    def first(byte: int) -> tuple[int, int, int]:
        """(bytes to come, lowest, highest next byte) after a leading byte; none for others."""
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0, 0

    def _open(self, data: bytes) -> int:
        """Length of an incomplete character at the end of ``data``."""
        for back in range(1, min(3, len(data)) + 1):
            need, low, high = self.first(data[-back])
            if not need:
                if 0x80 <= data[-back] <= 0xBF:
                    continue
                return 0
            for byte in data[len(data) - back + 1 :]:
                if not low <= byte <= high:
                    return 0
                need, low, high = need - 1, 0x80, 0xBF
            return back if need else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        held = self._open(data)
        self.rest = data[len(data) - held :]
        return data[: len(data) - held].decode("utf-8", "replace")

    def finish(self) -> str:
        """What is left at the end of the stream."""
        text, self.rest = self.rest.decode("utf-8", "replace"), b""
        return text


def encode_texts(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, ids) for every row of ``docs`` (doc_id, text), ids as a list of int. A null text
    counts as empty and has no ids; repeated rows stay; other columns are ignored."""
    return _run(docs, ranks, pattern, "doc_id long, ids array<int>", lambda codec, ids: [ids], [pa.list_(pa.int32())])


def decode_ids(rows: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, text) for rows of (doc_id, ids). A null list gives empty text, a null id in a list is
    skipped."""

    def run(batches):
        codec = shared_codec(ranks, pattern)
        for batch in batches:
            texts = [
                "".join(codec.decode(i for i in ids or [] if i is not None)) for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return bounded(rows.select("doc_id", "ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space) and decoded_sha256 (of
    the text decoded from the ids) for every row of ``docs``; rules as in ``encode_texts``."""

    def digests(codec: Codec, ids: list[int]) -> list:
        text = " ".join(map(codec.decimal.__getitem__, ids))
        back = hashlib.sha256()
        for part in codec.decode(ids):
            back.update(part.encode())
        return [len(ids), hashlib.sha256(text.encode()).hexdigest(), back.hexdigest()]

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _run(docs, ranks, pattern, schema, digests, [pa.int64(), pa.string(), pa.string()])


def _run(docs: DataFrame, ranks: str, pattern: str, schema: str, outputs, types: list) -> DataFrame:
    names = [part.split()[0] for part in schema.replace("array<int>", "ids").split(",")]

    def run(batches):
        codec = shared_codec(ranks, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [outputs(codec, codec.encode(t or "")) for t in part.column("text").to_pylist()]
                columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    return bounded(docs.select("doc_id", "text")).mapInArrow(run, schema)
