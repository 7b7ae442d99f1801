"""Well-known binary at the boundary to stores that keep geometry as bytes.

Spark has no expression for the bytes of a double, so these two run as Arrow batches in Python.
Use them when a table is loaded or unloaded, not in the middle of a query.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPOT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
SHAPE = T.ArrayType(T.ArrayType(T.ArrayType(SPOT)))
POLYGON, MULTIPOLYGON, POINT = 3, 6, 1


def _head(kind: int, count: int) -> bytes:
    return struct.pack("<BII", 1, kind, count)


def _polygon(rings) -> bytes:
    parts = [_head(POLYGON, len(rings))]
    for ring in rings:
        flat = np.array([(p["x"], p["y"]) for p in ring], dtype="<f8")
        parts.append(struct.pack("<I", len(ring)) + flat.tobytes())
    return b"".join(parts)


def _encode(geometry) -> bytes | None:
    if geometry is None:
        return None
    polygons = [_polygon(p) for p in geometry]
    return polygons[0] if len(polygons) == 1 else _head(MULTIPOLYGON, len(polygons)) + b"".join(polygons)


class _Bytes:
    """Reads numbers one after the other in the byte order each part declares."""

    def __init__(self, data: bytes):
        self.data, self.at, self.order = bytes(data), 0, "<"

    def head(self) -> int:
        self.order = "<" if self.data[self.at] else ">"
        self.at += 1
        return self.count()

    def count(self) -> int:
        (value,) = struct.unpack_from(self.order + "I", self.data, self.at)
        self.at += 4
        return value

    def points(self, n: int) -> list[dict]:
        flat = np.frombuffer(self.data, self.order + "f8", 2 * n, self.at)
        self.at += 16 * n
        return [{"x": float(x), "y": float(y)} for x, y in zip(flat[::2], flat[1::2])]


def _decode(data) -> list | None:
    if data is None:
        return None
    source = _Bytes(data)

    def polygon() -> list:
        return [source.points(source.count()) for _ in range(source.count())]

    kind = source.head()
    if kind == POLYGON:
        return [polygon()]
    if kind != MULTIPOLYGON:
        raise ValueError(f"not a polygon: type {kind}")
    out = []
    for _ in range(source.count()):
        source.head()
        out.append(polygon())
    return out


@F.pandas_udf(T.BinaryType())
def to_wkb(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(_encode)


@F.pandas_udf(SHAPE)
def from_wkb(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(_decode)


@F.pandas_udf(T.BinaryType())
def point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    head = struct.pack("<BI", 1, POINT)
    known = x.notna() & y.notna()
    return pd.Series(
        [head + struct.pack("<dd", a, b) if k else None for a, b, k in zip(x, y, known)]
    )
