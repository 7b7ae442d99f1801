"""Planar geometry as column expressions.

A geometry is ``array<polygon>``, a polygon ``array<ring>`` (outer ring first, then
holes), a ring ``array<struct<x:double,y:double>>`` closed by repeating its first point.
This one type holds polygons and multipolygons alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "array<array<array<struct<x:double,y:double>>>>"
EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"

# WGS84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_polygon(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A one-ring rectangle."""
    ring = F.array(
        point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin)
    )
    return F.array(F.array(ring))


def from_geojson(kind: Column, coordinates: Column) -> Column:
    """GeoJSON ``coordinates`` (JSON text) of a Polygon or MultiPolygon."""
    pair = "array<double>"
    single = F.from_json(coordinates, f"array<array<{pair}>>")
    multi = F.from_json(coordinates, f"array<array<array<{pair}>>>")

    def polygon(rings: Column) -> Column:
        return F.transform(
            rings,
            lambda ring: F.transform(
                ring, lambda p: point(F.element_at(p, 1), F.element_at(p, 2))
            ),
        )

    return F.when(kind == "Polygon", F.array(polygon(single))).when(
        kind == "MultiPolygon", F.transform(multi, polygon)
    )


def _points(geometry: Column) -> Column:
    return F.flatten(F.flatten(geometry))


def xmin(geometry: Column) -> Column:
    return F.array_min(F.transform(_points(geometry), lambda p: p.x))


def xmax(geometry: Column) -> Column:
    return F.array_max(F.transform(_points(geometry), lambda p: p.x))


def ymin(geometry: Column) -> Column:
    return F.array_min(F.transform(_points(geometry), lambda p: p.y))


def ymax(geometry: Column) -> Column:
    return F.array_max(F.transform(_points(geometry), lambda p: p.y))


def bbox(geometry: Column, prefix: str = "bbox_") -> list[Column]:
    return [
        xmin(geometry).alias(prefix + "xmin"),
        xmax(geometry).alias(prefix + "xmax"),
        ymin(geometry).alias(prefix + "ymin"),
        ymax(geometry).alias(prefix + "ymax"),
    ]


def ring_edges(ring: Column) -> Column:
    """Consecutive point pairs of a ring."""
    size = F.size(ring)
    return F.zip_with(
        F.slice(ring, F.lit(1), size - 1),
        F.slice(ring, F.lit(2), size - 1),
        lambda a, b: F.struct(
            a.x.alias("ax"), a.y.alias("ay"), b.x.alias("bx"), b.y.alias("by")
        ),
    )


def edges(geometry: Column) -> Column:
    """All edges of all rings, holes included."""
    return F.flatten(F.transform(F.flatten(geometry), ring_edges))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def _ring_moments(ring: Column) -> Column:
    """(twice signed area, x moment, y moment), taken relative to the first point so that
    large coordinates do not cancel."""
    origin = F.element_at(ring, 1)

    def step(acc: Column, e: Column) -> Column:
        ax, ay = e.ax - origin.x, e.ay - origin.y
        bx, by = e.bx - origin.x, e.by - origin.y
        cross = ax * by - bx * ay
        return F.struct(
            (acc.a + cross).alias("a"),
            (acc.mx + (ax + bx) * cross).alias("mx"),
            (acc.my + (ay + by) * cross).alias("my"),
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def finish(acc: Column) -> Column:
        size = F.abs(acc.a) / 2
        divisor = F.nullif(acc.a * 3, F.lit(0.0))
        return F.struct(
            size.alias("area"),
            (origin.x + acc.mx / divisor).alias("cx"),
            (origin.y + acc.my / divisor).alias("cy"),
        )

    return F.aggregate(ring_edges(ring), zero, step, finish)


def _weighted_rings(geometry: Column) -> Column:
    """Area and centre of every ring; holes count negative whatever their winding."""
    return F.flatten(
        F.transform(
            geometry,
            lambda polygon: F.transform(
                polygon,
                lambda ring, i: F.struct(
                    F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("sign"),
                    _ring_moments(ring).alias("m"),
                ),
            ),
        )
    )


def area(geometry: Column) -> Column:
    """Planar area in squared coordinate units (outer rings minus holes)."""
    return _sum(F.transform(_weighted_rings(geometry), lambda r: r.sign * r.m.area))


def centroid(geometry: Column) -> Column:
    """Area-weighted centre as ``struct<x, y>``; NULL for a geometry without area."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(acc: Column, ring: Column) -> Column:
        weight = ring.sign * ring.m.area
        return F.struct(
            (acc.w + weight).alias("w"),
            (acc.x + F.coalesce(weight * ring.m.cx, F.lit(0.0))).alias("x"),
            (acc.y + F.coalesce(weight * ring.m.cy, F.lit(0.0))).alias("y"),
        )

    def finish(acc: Column) -> Column:
        weight = F.nullif(acc.w, F.lit(0.0))
        return F.when(
            weight.isNotNull(), F.struct((acc.x / weight).alias("x"), (acc.y / weight).alias("y"))
        )

    return F.aggregate(_weighted_rings(geometry), zero, step, finish)


def perimeter(geometry: Column) -> Column:
    """Length of all rings in coordinate units."""
    return _sum(
        F.transform(
            edges(geometry),
            lambda e: F.sqrt((e.bx - e.ax) * (e.bx - e.ax) + (e.by - e.ay) * (e.by - e.ay)),
        )
    )


def perimeter_metres(geometry: Column) -> Column:
    """Great-circle length of all rings for longitude/latitude degrees."""

    def length(e: Column) -> Column:
        dlat = F.radians(e.by - e.ay) / 2
        dlon = F.radians(e.bx - e.ax) / 2
        h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(e.ay)) * F.cos(F.radians(e.by)) * F.pow(
            F.sin(dlon), 2
        )
        return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * 2 * SEMI_MAJOR

    return _sum(F.transform(edges(geometry), length))


def equal_area(geometry: Column) -> Column:
    """Project longitude/latitude degrees to metres so that areas are true everywhere
    (cylindrical equal-area on the WGS84 ellipsoid)."""
    e2 = FLATTENING * (2 - FLATTENING)
    e = math.sqrt(e2)

    def project(p: Column) -> Column:
        s = F.sin(F.radians(p.y))
        q = (1 - e2) * (
            s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e)
        )
        return point(F.radians(p.x) * SEMI_MAJOR, q * SEMI_MAJOR / 2)

    return F.transform(
        geometry, lambda poly: F.transform(poly, lambda ring: F.transform(ring, project))
    )


def area_km2(geometry: Column) -> Column:
    return area(equal_area(geometry)) / 1_000_000


def parts(geometry: Column) -> Column:
    return F.size(geometry)


def holes(geometry: Column) -> Column:
    """Number of interior rings over all parts."""
    return F.aggregate(geometry, F.lit(0), lambda acc, polygon: acc + F.size(polygon) - 1)


def on_boundary(edge_list: Column, x: Column, y: Column) -> Column:
    return F.exists(
        edge_list,
        lambda e: ((e.bx - e.ax) * (y - e.ay) == (e.by - e.ay) * (x - e.ax))
        & x.between(F.least(e.ax, e.bx), F.greatest(e.ax, e.bx))
        & y.between(F.least(e.ay, e.by), F.greatest(e.ay, e.by)),
    )


def x_at(e: Column, y: Column) -> Column:
    """Where the line of an edge is at height y; NULL for a level edge."""
    return (e.bx - e.ax) * (y - e.ay) / F.nullif(e.by - e.ay, F.lit(0.0)) + e.ax


def crossings(edge_list: Column, x: Column, y: Column) -> Column:
    """Edges that a ray from the point toward growing x crosses."""
    return F.size(
        F.filter(
            edge_list,
            lambda e: ((e.ay > y) != (e.by > y))
            & (x < x_at(e, y)),
        )
    )


def inside(edge_list: Column, x: Column, y: Column) -> Column:
    """Strictly inside by the even-odd rule; points on an edge are outside."""
    return (crossings(edge_list, x, y) % 2 == 1) & ~on_boundary(edge_list, x, y)


def inside_from(edge_list: Column, known: Column, x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """Strictly inside, given whether (rx, ry) is (``known``) and all edges that touch the box of the
    two points: the way goes level to rx, then upright to ry."""
    level = F.size(F.filter(
        edge_list,
        lambda e: ((e.ay > y) != (e.by > y)) & (x_at(e, y) > F.least(x, rx)) & (x_at(e, y) <= F.greatest(x, rx)),
    ))

    def y_at(e: Column) -> Column:
        return (e.by - e.ay) * (rx - e.ax) / F.nullif(e.bx - e.ax, F.lit(0.0)) + e.ay

    upright = F.size(F.filter(
        edge_list,
        lambda e: ((e.ax > rx) != (e.bx > rx)) & (y_at(e) > F.least(y, ry)) & (y_at(e) <= F.greatest(y, ry)),
    ))
    return (known != ((level + upright) % 2 == 1)) & ~on_boundary(edge_list, x, y)


def segments_meet(p: Column, q: Column) -> Column:
    """Whether two edges share a point (crossing, touching or overlapping)."""

    def turn(ax, ay, bx, by, cx, cy):
        return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    def within(ax, ay, bx, by, cx, cy):
        return cx.between(F.least(ax, bx), F.greatest(ax, bx)) & cy.between(
            F.least(ay, by), F.greatest(ay, by)
        )

    a, b, c, d = (p.ax, p.ay), (p.bx, p.by), (q.ax, q.ay), (q.bx, q.by)
    t1, t2 = turn(*a, *b, *c), turn(*a, *b, *d)
    t3, t4 = turn(*c, *d, *a), turn(*c, *d, *b)
    return (
        ((t1 != t2) & (t3 != t4))
        | ((t1 == 0) & within(*a, *b, *c))
        | ((t2 == 0) & within(*a, *b, *d))
        | ((t3 == 0) & within(*c, *d, *a))
        | ((t4 == 0) & within(*c, *d, *b))
    )


def boxes_meet(p: Column, q: Column) -> Column:
    """Whether the boxes of two edges share a point."""
    return (
        (F.greatest(p.ax, p.bx) >= F.least(q.ax, q.bx)) & (F.greatest(q.ax, q.bx) >= F.least(p.ax, p.bx))
        & (F.greatest(p.ay, p.by) >= F.least(q.ay, q.by)) & (F.greatest(q.ay, q.by) >= F.least(p.ay, p.by))
    )
