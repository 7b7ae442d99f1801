"""Words of whole texts as numpy arrays: positions and hashes, for a slice of rows at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts joined, end of each text); null counts as empty."""
    texts = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or len(ends) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts), np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], (ends[1:] - ends[0]).astype(np.int64)


def words(data: np.ndarray, ends: np.ndarray, inside: np.ndarray | None = None):
    """(start, end, text number) of every run of non-space bytes; none crosses two texts.
    ``inside`` tells other bytes that belong to words (256 flags)."""
    solid = (~SPACE if inside is None else inside)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = True
    edge[ends] = True
    before = np.concatenate(([False], solid))
    after = np.concatenate((solid, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    stops = np.flatnonzero(before & (~after | edge))
    return starts, stops, np.searchsorted(ends, starts, side="right")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(ODD[2])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(ODD[3])
    return x ^ (x >> np.uint64(32))


def _powers(count: int, odd: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    inverse = pow(odd, -1, 1 << 64)
    out = []
    for base in (odd, inverse):
        row = np.full(count, base, np.uint64)
        row[:1] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def span_hashes(values: np.ndarray, starts: np.ndarray, stops: np.ndarray, odd: int) -> np.ndarray:
    """Polynomial hash of values[start:stop] for each span, independent of where it lies."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(values) + 1, odd)
    sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(values * up[:-1])))
    return (sums[stops] - sums[starts]) * down[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, odd: int = ODD[0]) -> np.ndarray:
    found = span_hashes(data.astype(np.uint64) + np.uint64(1), starts, stops, odd)
    return mix(found + (stops - starts).astype(np.uint64) * np.uint64(ODD[1]))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours; len(values) - width + 1 results."""
    if len(values) < width:
        return values[:0]
    best, size = values, 1
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    rest = width - size
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best
