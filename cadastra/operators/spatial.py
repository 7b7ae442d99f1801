"""Spatial joins over a hierarchical grid of cells that hold clipped outlines.

A shape is cut up over cells whose side is a power of two: side by side they cover its box with about
as many cells as the outline has edges, so a cell meets few edges whether the shape is a hamlet or a
coast. A cell of a shape holds the edges that touch it and whether its reference point lies inside. A
point is compared with the edges of its own cell only: it is inside if the reference point is, unless
the way there (level, then upright) crosses the outline an odd number of times. Shapes meet if edges of
theirs that share a cell do, or if one holds a vertex of the other.

The joins are equi joins on (level, cell), with exact tests on top; crowded cells are salted, and what is
repeated for a salt is a clipped run of edges, not an outline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.functions.columns import round_exact
from cadastra.operators.skew import skew_join
from cadastra.session import pin, shuffle_partitions

BOX = ["xmin", "ymin", "xmax", "ymax"]
CELL = ["level", "cx", "cy"]
# Edges of an outline for each cell of the grid over its box.
EDGES_PER_CELL = 4
# Place of the reference point in a cell, off any round coordinate.
REFERENCE_X, REFERENCE_Y = 0.3819660112501052, 0.6180339887498949
# Part of a cell's side by which an edge's reach is widened against rounding.
MARGIN = 2.0**-30


def level_of(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """The least power of two that is no less than the longer side."""
    side = F.greatest(xmax - xmin, ymax - ymin, F.lit(2.0**-40))
    return F.ceil(F.log2(side)).cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def outline_edges(shapes: DataFrame, key: str, geometry: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per edge of each shape, with the level of the shape's grid; ``carry`` goes along."""
    g = F.col(geometry)
    sized = shapes.filter(g.isNotNull()).select(
        key, *carry, geo.edges(g).alias("_edges"),
        geo.xmin(g).alias("xmin"), geo.ymin(g).alias("ymin"), geo.xmax(g).alias("xmax"), geo.ymax(g).alias("ymax"),
    )
    # Each halving of the side gives four times the cells.
    halvings = F.greatest(F.ceil(F.log2(F.size("_edges") / F.lit(EDGES_PER_CELL)) / 2), F.lit(0)).cast("int")
    level = level_of(*[F.col(c) for c in BOX]) - halvings
    return sized.filter(F.size("_edges") > 0).select(
        key, *carry, level.alias("level"), F.explode("_edges").alias("edge")
    )


def _strips(edges: DataFrame) -> DataFrame:
    """One row per edge and row of cells it passes: ``cy``, the span of x inside, and where the edge crosses
    the height of the reference points (NULL if it does not)."""
    e, lv = F.col("edge"), F.col("level")
    side = F.pow(F.lit(2.0), lv)
    rows = F.sequence(_cell(F.least(e.ay, e.by), lv), _cell(F.greatest(e.ay, e.by), lv))
    striped = edges.withColumn("cy", F.explode(rows))
    left, right = F.least(e.ax, e.bx), F.greatest(e.ax, e.bx)

    def at(y: Column) -> Column:
        y = F.least(F.greatest(y, F.least(e.ay, e.by)), F.greatest(e.ay, e.by))
        return F.least(F.greatest(geo.x_at(e, y), left), right)

    low, high = at(F.col("cy") * side), at((F.col("cy") + 1) * side)
    flat = e.ay == e.by
    height = (F.col("cy") + F.lit(REFERENCE_Y)) * side
    return striped.select(
        *edges.columns, "cy",
        F.when(flat, left).otherwise(F.least(low, high)).alias("_x0"),
        F.when(flat, right).otherwise(F.greatest(low, high)).alias("_x1"),
        F.when((e.ay > height) != (e.by > height), geo.x_at(e, height)).alias("_crossing"),
    )


def _pieces(strips: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per edge and cell it touches."""
    lv = F.col("level")
    margin = F.pow(F.lit(2.0), lv) * F.lit(MARGIN)
    cells = F.sequence(_cell(F.col("_x0") - margin, lv), _cell(F.col("_x1") + margin, lv))
    return strips.select(*columns, "edge", "level", F.explode(cells).alias("cx"), "cy")


def cell_index(edges: DataFrame, key: str, carry: Sequence[str] = ()) -> DataFrame:
    """(key, carry, level, cx, cy, edges, inside) for each cell a shape touches or holds, of
    ``outline_edges``. A cell that lies whole inside has no edges."""
    own = [key, *carry]
    strips = _strips(edges)
    rows = strips.filter("_crossing is not null").groupBy(*own, "level", "cy").agg(
        F.array_sort(F.collect_list("_crossing")).alias("_xs")
    )
    # A reference point is inside if an odd number of crossings lie beyond it: between the first
    # and the second, the third and the fourth, and so on.
    xs, side = F.col("_xs"), F.pow(F.lit(2.0), F.col("level"))
    first = lambda x: F.ceil(x / side - F.lit(REFERENCE_X)).cast("bigint")
    runs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(xs) / 2).cast("int") - 1),
        lambda i: F.struct(first(F.get(xs, i * 2)).alias("a"), (first(F.get(xs, i * 2 + 1)) - 1).alias("b")),
    )
    held = rows.select(*own, "level", "cy", F.explode(F.filter(runs, lambda r: r.a <= r.b)).alias("_run"))
    held = held.select(*own, "level", F.explode(F.sequence("_run.a", "_run.b")).alias("cx"), "cy")
    touched = _pieces(strips, own)
    parts = touched.withColumn("_held", F.lit(False)).unionByName(
        held.withColumns({"edge": F.lit(None).cast(edges.schema["edge"].dataType), "_held": F.lit(True)})
    )
    return parts.groupBy(*own, *CELL).agg(
        F.collect_list("edge").alias("edges"), F.max("_held").alias("inside")
    )


def levels_of(df: DataFrame) -> list[int]:
    """Levels that occur. They are powers of two of a side length: a few dozen at most."""
    return sorted(r["level"] for r in df.select("level").distinct().collect())


def points_in_index(points: DataFrame, x: str, y: str, index: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join of points to the shapes of a stored ``cell_index`` that strictly contain them (all
    matches kept); ``columns`` of the index go along."""
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    probes = F.array(
        *[
            F.struct(
                F.lit(lv).alias("level"),
                _cell(px, F.lit(lv)).alias("cx"),
                _cell(py, F.lit(lv)).alias("cy"),
            )
            for lv in levels_of(index)
        ]
    ).cast("array<struct<level:int,cx:bigint,cy:bigint>>")
    located = points.filter(px.isNotNull() & py.isNotNull())
    looking = located.select("*", F.inline(probes))
    side = F.pow(F.lit(2.0), F.col("level"))
    rx, ry = (F.col("cx") + F.lit(REFERENCE_X)) * side, (F.col("cy") + F.lit(REFERENCE_Y)) * side
    hits = skew_join(
        looking, index.select(*CELL, *columns, "edges", "inside"), CELL, "inner", spread=points.columns,
        condition=lambda: geo.inside_from(F.col("edges"), F.col("inside"), px, py, rx, ry),
    )
    return hits.select(*points.columns, *columns)


def point_in_polygon(
    points: DataFrame, x: str, y: str, shapes: DataFrame, key: str, geometry: str
) -> DataFrame:
    """Inner join of points to the shapes that strictly contain them (all matches kept)."""
    index = pin(cell_index(outline_edges(shapes, key, geometry), key))
    return points_in_index(points, x, y, index, [key])


def locate(
    points: DataFrame, point_key: str, x: str, y: str,
    shapes: DataFrame, key: str, geometry: str,
) -> DataFrame:
    """One shape per point: the smallest key where shapes overlap."""
    # Kept once: the points are read for heavy cells and for the join.
    spots = pin(points.select(point_key, x, y))
    hits = point_in_polygon(spots, x, y, shapes.select(key, geometry), key, geometry)
    return hits.groupBy(point_key).agg(F.min(key).alias(key))


def zonal_stats(
    pixels: DataFrame, x: str, y: str, value: str, zones: DataFrame, key: str, geometry: str
) -> DataFrame:
    """Integer minimum and maximum and the one-decimal mean of the positive values in each zone.
    Zones without a valid pixel keep NULLs."""
    valid = pixels.filter(F.col(value) > 0).select(x, y, value)
    # Pixels of one position are folded before the join.
    v = F.col(value).cast("decimal(38,6)")
    folded = valid.groupBy(x, y).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        F.sum(v).alias("_sum"), F.count("*").alias("_n"),
    )
    hits = point_in_polygon(pin(folded), x, y, zones.select(key, geometry), key, geometry)
    stats = hits.groupBy(key).agg(
        F.min("_lo").cast("int").alias("altitude_min"),
        F.max("_hi").cast("int").alias("altitude_max"),
        round_exact(F.sum("_sum").cast("double") / F.sum("_n"), 1).alias("altitude_moyenne"),
    )
    return zones.select(key).join(stats, key, "left")


def neighbours(shapes: DataFrame, key: str, geometry: str, same: list[str] | None = None) -> DataFrame:
    """Pairs of shapes that touch or overlap, in both directions: ``(key, neighbour)``.

    ``same`` names columns that must agree (and be known) on both sides. Edges meet in the cells of the
    coarser of two grids; a shape that lies inside another without touching its outline is found by
    a vertex of each of its parts. What is shuffled are single edges and pairs of keys.
    """
    same = list(same or [])
    known = shapes.select(key, geometry, *same)
    for c in same:
        known = known.filter(F.col(c).isNotNull())
    # A small file of shapes is read by one task, and so would be all that is made of it.
    known = known.repartition(shuffle_partitions(shapes.sparkSession), key, geometry)
    # Read for levels, both sides of the join and the index.
    edges = pin(outline_edges(known, key, geometry, same))
    home = _pieces(_strips(edges), [key, *same])
    own = edges.withColumnRenamed("level", "own")
    coarser = F.filter(F.array(*[F.lit(lv) for lv in levels_of(edges)]).cast("array<int>"), lambda lv: lv >= F.col("own"))
    probe = _pieces(_strips(own.withColumn("level", F.explode(coarser))), [key, *same, "own"])
    other = home.select(F.col(key).alias("_b"), F.col("edge").alias("_edge"), *CELL, *same)

    def test() -> Column:
        p, q = F.col("edge"), F.col("_edge")
        # Shapes of one level meet twice; the smaller key leads there.
        lead = F.when(F.col("own") == F.col("level"), F.col(key) < F.col("_b")).otherwise(F.col(key) != F.col("_b"))
        return lead & geo.boxes_meet(p, q) & geo.segments_meet(p, q)

    touching = skew_join(
        probe, other, [*CELL, *same], "inner", spread=[key, "edge"], condition=test
    ).select(F.col(key).alias("_a"), "_b")

    corners = known.filter(F.col(geometry).isNotNull()).select(
        F.col(key).alias("_a"), *[F.col(c).alias(f"_{c}") for c in same],
        F.explode(F.transform(geometry, lambda part: part[0][0])).alias("_at"),
    ).select("*", F.col("_at.x").alias("_x"), F.col("_at.y").alias("_y")).drop("_at")
    index = pin(cell_index(edges, key, same))
    held = points_in_index(corners, "_x", "_y", index, [key, *same]).filter(F.col("_a") != F.col(key))
    for c in same:
        held = held.filter(F.col(c) == F.col(f"_{c}"))
    pairs = touching.unionByName(held.select("_a", F.col(key).alias("_b")))
    found = pairs.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
    both = F.array(
        F.struct(F.col("a").alias(key), F.col("b").alias("neighbour")),
        F.struct(F.col("b").alias(key), F.col("a").alias("neighbour")),
    )
    return found.select(F.inline(both))
