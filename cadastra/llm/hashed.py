"""Sorted arrays of hashed keys: summed, looked up, dealt to ranges, and packed for a shuffle."""

from __future__ import annotations

import numpy as np


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts added up."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the planes of bytes of their differences: the high planes are nearly empty, so
    that the shuffle's compression removes them."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_keys(body: bytes) -> np.ndarray:
    planes = np.frombuffer(body, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array ``wanted``."""
    if not len(wanted):
        return np.zeros(len(keys), bool)
    return wanted[np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)] == keys


def edges(parts: int, bits: int = 64, rows: int = 1) -> np.ndarray:
    """Least key of each of ``parts`` even ranges of ``rows`` times 2 ** bits keys."""
    return np.array([-(-(rows * i << bits) // parts) for i in range(parts)], np.uint64)
