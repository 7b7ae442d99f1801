"""Join shapes and set operations."""

from __future__ import annotations

import string

from pyspark.sql import functions as F

from cadastra.functions import columns as C
from cadastra.functions import geo
from cadastra.operators import joins as J
from cadastra.operators import sets as S
from cadastra.operators import spatial as X
from cadastra.operators.aggregates import reconcile
from cadastra.operators.skew import skew_join
from cadastra.queries.registry import Tables, query

MONEY = "decimal(18,2)"


def revenue(t: Tables):
    """Order value per customer and year: folded before any join."""
    return t.orders.groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("revenue"), F.count("*").alias("n_orders")
    )


@query("dimension_lookups", """
SELECT c_custkey, c_name, n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def dimension_lookups(t: Tables):
    """Left lookups to dimension files; Spark broadcasts them by their file size."""
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"), "n_regionkey")
    region = t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    named = t.customer.join(nation, "c_nationkey", "left").join(region, "n_regionkey", "left")
    return named.select("c_custkey", "c_name", "nation", "region")


@query("order_lines_with_priority", """
SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority AS priority
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def order_lines_with_priority(t: Tables):
    """J1 at scale: fact-to-fact left lookup with heavy keys spread over salts."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    heads = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("priority"))
    return skew_join(lines, heads, ["l_orderkey"], "left")


@query("key_spine_panel", """
WITH o AS (SELECT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders FROM orders GROUP BY 1,2),
e AS (SELECT user_id AS id, CAST(year(ts) AS INTEGER) AS year, count(*) AS n_events FROM events GROUP BY 1,2),
l AS (SELECT l_suppkey AS id, CAST(year(l_shipdate) AS INTEGER) AS year, max(l_quantity) AS top FROM lineitem GROUP BY 1,2),
k AS (SELECT id, year FROM o UNION SELECT id, year FROM e UNION SELECT id, year FROM l)
SELECT k.id, k.year, n_orders, n_events, top FROM k LEFT JOIN o USING (id, year) LEFT JOIN e USING (id, year) LEFT JOIN l USING (id, year)""")
def key_spine_panel(t: Tables):
    """All (id, year) keys of three facts, widened by left joins on one partitioning."""
    keys = ["id", "year"]
    orders = revenue(t).select("id", "year", "n_orders")
    events = t.events.groupBy(F.col("user_id").alias("id"), F.year("ts").alias("year")).agg(
        F.count("*").alias("n_events")
    )
    lines = t.lineitem.groupBy(F.col("l_suppkey").alias("id"), F.year("l_shipdate").alias("year")).agg(
        F.max("l_quantity").alias("top")
    )
    parts = [orders, events, lines]
    return J.left_join_all(S.key_spine(parts, keys), keys, parts)


@query("prior_year", """
WITH y AS (SELECT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders GROUP BY 1,2)
SELECT c.id, c.year, c.revenue, p.revenue AS prev_revenue, (c.revenue - p.revenue) * 100 / nullif(p.revenue, 0) AS growth_pct
FROM y c LEFT JOIN y p ON c.id = p.id AND c.year = p.year + 1""")
def prior_year(t: Tables):
    """Strictly consecutive year, NULL over a gap; one window instead of a self join."""
    yearly = revenue(t).select("id", "year", F.col("revenue").cast("double").alias("revenue"))
    paired = J.prior_period(yearly, ["id"], "year", ["revenue"])
    change = F.col("revenue") - F.col("prev_revenue")
    return paired.withColumn("growth_pct", C.ratio(change * 100, F.col("prev_revenue")))


@query("label_join", """
SELECT i.id AS indicator_id, count(*) AS n FROM part JOIN (VALUES (1,'PROMO'),(2,'ECONOMY'),(3,'NOWHERE')) i(id, label) ON p_type = i.label GROUP BY 1""")
def label_join(t: Tables):
    """Inner join on a natural label; unknown labels drop out."""
    labels = t.spark.createDataFrame([(1, "PROMO"), (2, "ECONOMY"), (3, "NOWHERE")], "indicator_id int, p_type string")
    counts = t.part.groupBy("p_type").agg(F.count("*").alias("n"))
    return counts.join(labels, "p_type").select("indicator_id", "n")


@query("semi_join", """
SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 490000)""")
def semi_join(t: Tables):
    """Rows with a match; the filter reaches the scan of orders."""
    big = t.orders.filter(F.col("o_totalprice") > 490000).select(F.col("o_custkey").alias("c_custkey"))
    return skew_join(t.customer.select("c_custkey"), big.distinct(), ["c_custkey"], "left_semi")


@query("anti_join", """
SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def anti_join(t: Tables):
    """Rows without a match on the whole key."""
    urgent = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    keys = urgent.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.select("c_custkey", "c_mktsegment").join(keys, "c_custkey", "left_anti")


@query("not_in_ignoring_null", """
SELECT s_suppkey AS k FROM supplier WHERE s_suppkey NOT IN (SELECT nullif(o_custkey, 5) FROM orders WHERE o_totalprice < 50000 AND nullif(o_custkey, 5) IS NOT NULL)""")
def not_in_ignoring_null(t: Tables):
    """Absent values, NULLs among them ignored."""
    low = t.orders.filter(F.col("o_totalprice") < 50000).select(F.nullif("o_custkey", F.lit(5)).alias("v"))
    return J.not_in(t.supplier.select(F.col("s_suppkey").alias("k")), "k", low, "v")


@query("not_in_null_aware", """
SELECT 'clean' AS probe, s_suppkey AS k FROM supplier WHERE s_suppkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 50000)
UNION ALL
SELECT 'with_null', s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END FROM orders WHERE o_totalprice < 50000)""")
def not_in_null_aware(t: Tables):
    """SQL NOT IN, where one NULL empties the result."""
    low = t.orders.filter(F.col("o_totalprice") < 50000)
    keys = t.supplier.select(F.col("s_suppkey").alias("k"))
    holes = low.select(F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("v"))
    clean = J.not_in(keys, "k", low, "o_custkey", null_aware=True).select(F.lit("clean").alias("probe"), "k")
    holed = J.not_in(keys, "k", holes, "v", null_aware=True).select(F.lit("with_null").alias("probe"), "k")
    return clean.unionByName(holed)


@query("interval_join", """
WITH f AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1),
i AS (SELECT s_suppkey AS era, DATE '1995-01-01' + CAST(s_suppkey * 24 % 2400 AS INTEGER) AS s, CASE WHEN s_nationkey = 0 THEN NULL ELSE DATE '1995-01-01' + CAST(s_suppkey * 24 % 2400 + s_nationkey * 3 AS INTEGER) END AS e FROM supplier)
SELECT day, n, era FROM f LEFT JOIN i ON day >= s AND (day < e OR e IS NULL)""")
def interval_join(t: Tables):
    """Half-open intervals with open ends and overlaps; equi join on day buckets."""
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    offset = (F.col("s_suppkey") * 24 % 2400).cast("int")
    first = F.lit("1995-01-01").cast("date")
    eras = t.supplier.select(
        F.col("s_suppkey").alias("era"), F.date_add(first, offset).alias("start_date"),
        F.when(F.col("s_nationkey") > 0, F.date_add(first, offset + F.col("s_nationkey") * 3)).alias("end_date"),
    )
    dates = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    return J.interval_join(days, eras, "day", ["era"], sketch=dates)


@query("interval_join_literal_eras", """
SELECT era, count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) LEFT JOIN
 (VALUES (DATE '1995-06-01', DATE '1996-06-01', 'first'), (DATE '1996-06-01', DATE '1998-01-01', 'second'), (DATE '2000-01-01', NULL, 'open')) v(s, e, era)
 ON d >= s AND (d < e OR e IS NULL) GROUP BY era""")
def interval_join_literal_eras(t: Tables):
    """A few adjacent, gapped and open eras; dates are folded to distinct ones first."""
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("c"))
    eras = t.spark.createDataFrame(
        [("1995-06-01", "1996-06-01", "first"), ("1996-06-01", "1998-01-01", "second"), ("2000-01-01", None, "open")],
        "start_date string, end_date string, era string",
    ).select(F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"), "era")
    joined = J.interval_join(days, eras, "d", ["era"])
    return joined.groupBy("era").agg(F.sum("c").alias("n"))


@query("scalar_attach", """
SELECT c_custkey, c_acctbal, top, n FROM customer, (SELECT max(c_acctbal) AS top, count(*) AS n FROM customer)""")
def scalar_attach(t: Tables):
    """One-row statistics on every row, as scalar subqueries."""
    stats = t.customer.agg(F.max("c_acctbal").alias("top"), F.count("*").alias("n"))
    return J.attach_scalars(t.customer.select("c_custkey", "c_acctbal"), stats)


@query("prefiltered_right_side", """
SELECT c_custkey, n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1) ON c_custkey = o_custkey""")
def prefiltered_right_side(t: Tables):
    """The right side is filtered (and folded) before the left join."""
    year = t.orders.filter(F.year("o_orderdate") == 1996).groupBy(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(year.agg(F.count("*").alias("n")), "c_custkey", "left")


@query("mapped_value_join", """
SELECT o_orderkey, r_name AS region FROM orders JOIN (VALUES ('F','ASIA'),('O','EUROPE')) m(s, r) ON o_orderstatus = s JOIN region ON r_name = m.r""")
def mapped_value_join(t: Tables):
    """Join through a literal value map; unmapped values drop out."""
    right = t.region.select("r_name", F.col("r_name").alias("region"))
    joined = J.mapped_join(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "ASIA", "O": "EUROPE"}, right, "r_name")
    return joined.select("o_orderkey", "region")


@query("last_value_lookup", """
SELECT c_custkey, price FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def last_value_lookup(t: Tables):
    """Lookup in which the last of repeated codes counts."""
    last = J.last_wins(t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_totalprice").alias("price")), "c_custkey", "o_orderkey")
    return t.customer.select("c_custkey").join(last.drop("o_orderkey"), "c_custkey", "left")


@query("default_lookup", """
SELECT c_custkey, coalesce(days, 0) AS days, coalesce(grp, '') AS grp FROM customer LEFT JOIN
 (VALUES (3, 4, 'A'), (7, 1, 'B')) v(k, days, grp) ON c_nationkey = k""")
def default_lookup(t: Tables):
    """Lookup with defaults for what is not listed."""
    trips = t.spark.createDataFrame([(3, 4, "A"), (7, 1, "B")], "c_nationkey int, days int, grp string")
    joined = t.customer.join(F.broadcast(trips), "c_nationkey", "left")  # two literal rows
    return joined.select("c_custkey", F.coalesce("days", F.lit(0)).alias("days"), F.coalesce("grp", F.lit("")).alias("grp"))


@query("requested_keys", """
SELECT DISTINCT user_id AS id, EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id) AS known FROM events""")
def requested_keys(t: Tables):
    """Requested keys split into known and missing ones."""
    wanted = t.events.select(F.col("user_id").alias("id")).distinct()
    known, missing = J.requested_keys(wanted, t.supplier.select(F.col("s_suppkey").alias("id")), "id")
    return known.withColumn("known", F.lit(True)).unionByName(missing.withColumn("known", F.lit(False)))


@query("union_all_by_name", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def union_all_by_name(t: Tables):
    """Stacked by name; a missing column is NULL."""
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return S.union_all([customers, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))])


@query("reconciled_sources", """
SELECT id, year, max(v) AS v FROM (
 SELECT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS v FROM orders
 UNION ALL SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER), l_extendedprice FROM lineitem) GROUP BY id, year""")
def reconciled_sources(t: Tables):
    """The highest value per key over two overlapping sources."""
    a = t.orders.select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("v"))
    b = t.lineitem.select(F.col("l_suppkey").alias("id"), F.year("l_shipdate").alias("year"), F.col("l_extendedprice").alias("v"))
    return reconcile([a, b], ["id", "year"], "v")


@query("unused_letters", """
SELECT letter FROM (SELECT unnest(string_split('A,B,C,D,E,F,G,H,I,J,K,L,M,N,O,P,Q,R,S,T,U,V,W,X,Y,Z', ',')) AS letter)
WHERE letter NOT IN (SELECT upper(left(p_name, 1)) FROM part WHERE p_name IS NOT NULL)""")
def unused_letters(t: Tables):
    """Letters no part name starts with."""
    used = t.part.select(F.upper(F.left("p_name", F.lit(1))).alias("letter"))
    return S.unused_values(t.spark, list(string.ascii_uppercase), used, "letter")


@query("set_membership", """
SELECT day, bool_or(s = 'o') AS ordered, bool_or(s = 'l') AS shipped, bool_or(s = 'e') AS visited FROM (
 SELECT CAST(o_orderdate AS DATE) AS day, 'o' AS s FROM orders UNION ALL
 SELECT CAST(l_shipdate AS DATE), 'l' FROM lineitem UNION ALL SELECT CAST(ts AS DATE), 'e' FROM events) GROUP BY day""")
def set_membership(t: Tables):
    """U4: union of date sets with a flag per set."""
    day = lambda df, c: df.select(F.col(c).cast("date").alias("day"))
    return S.membership(
        {"ordered": day(t.orders, "o_orderdate"), "shipped": day(t.lineitem, "l_shipdate"), "visited": day(t.events, "ts")},
        "day",
    )


# -- spatial --------------------------------------------------------------------------------
# Zones: one rectangle per customer on a 40-wide grid, sides 1 to 3 by nation. Points: order lines.

ZONES_SQL = """(SELECT c_custkey AS zone, c_nationkey AS nation, x0, y0, x0 + 1 + c_nationkey % 3 AS x1, y0 + 1 + c_nationkey % 2 AS y1
 FROM (SELECT *, CAST(c_custkey % 40 AS DOUBLE) * 4 AS x0, CAST(c_custkey // 40 AS DOUBLE) * 3 AS y0 FROM customer))"""
POINTS_SQL = """(SELECT o_orderkey AS pt, CAST(o_orderkey % 1600 AS DOUBLE) / 10 + 0.05 AS x, CAST(o_custkey % 1200 AS DOUBLE) / 10 + 0.05 AS y,
  o_totalprice AS v FROM orders)"""


def zones(t: Tables):
    key = F.col("c_custkey")
    x0 = (key % 40).cast("double") * 4
    y0 = F.floor(key / 40).cast("double") * 3
    shape = geo.box_polygon(x0, y0, x0 + 1 + F.col("c_nationkey") % 3, y0 + 1 + F.col("c_nationkey") % 2)
    return t.customer.select(key.alias("zone"), F.col("c_nationkey").alias("nation"), shape.alias("geometry"))


def points(t: Tables):
    coord = lambda c, n: (F.col(c) % n).cast("double") / 10 + 0.05
    return t.orders.select(
        F.col("o_orderkey").alias("pt"), coord("o_orderkey", 1600).alias("x"), coord("o_custkey", 1200).alias("y"),
        F.col("o_totalprice").alias("v"),
    )


@query("zone_geometry", f"""
SELECT zone, x0 AS bbox_xmin, x1 AS bbox_xmax, y0 AS bbox_ymin, y1 AS bbox_ymax, (x1-x0)*(y1-y0) AS area,
 2*(x1-x0)+2*(y1-y0) AS perimeter, (x0+x1)/2 AS cx, (y0+y1)/2 AS cy, false AS is_multi, CAST(0 AS INTEGER) AS n_holes FROM {ZONES_SQL}""")
def zone_geometry(t: Tables):
    """Bounding box, area, perimeter, centre, parts and holes as column expressions."""
    g = F.col("geometry")
    measured = zones(t).select(
        "zone", *geo.bbox(g), geo.area(g).alias("area"), geo.perimeter(g).alias("perimeter"),
        geo.centroid(g).alias("c"), (geo.parts(g) > 1).alias("is_multi"), geo.holes(g).alias("n_holes"),
    )
    return measured.withColumns({"cx": F.col("c.x"), "cy": F.col("c.y")}).drop("c")


@query("binary_geometry", f"""
SELECT zone, CAST(93 AS INTEGER) AS n_bytes, CAST(4326 AS INTEGER) AS srid, (x1-x0)*(y1-y0) AS area FROM {ZONES_SQL}""")
def binary_geometry(t: Tables):
    """Geometry to its stored binary form with reference system, and back."""
    from cadastra.functions.wkb import from_wkb
    from cadastra.operators.history import stored_geometry

    stored = stored_geometry(zones(t).drop("nation"))
    return stored.select(
        "zone", F.octet_length("geometry_wkb").alias("n_bytes"), F.col("geometry_srid").alias("srid"),
        geo.area(from_wkb("geometry_wkb")).alias("area"),
    )


@query("points_in_polygons", f"""
SELECT pt, zone FROM {POINTS_SQL} JOIN {ZONES_SQL} ON x > x0 AND x < x1 AND y > y0 AND y < y1""")
def points_in_polygons(t: Tables):
    """All containing zones of each point by cell equi join, box and exact test."""
    return X.point_in_polygon(points(t).select("pt", "x", "y"), "x", "y", zones(t), "zone", "geometry").select("pt", "zone")


def cut_zones(t: Tables):
    """The zones as triangles: about half of the box, with a triangular hole; odd zones have a second
    part in the opposite corner. No given point lies on an edge."""
    part = lambda u, v: geo.point(
        F.col("x0") + (F.col("x1") - F.col("x0")) * u, F.col("y0") + (F.col("y1") - F.col("y0")) * v
    )
    ring = lambda *spots: F.array(*[part(u, v) for u, v in [*spots, spots[0]]])
    main = F.array(ring((0, 0), (0.97, 0), (0, 0.97)), ring((0.26, 0.26), (0.26, 0.51), (0.51, 0.26)))
    corner = F.array(ring((1, 1), (0.87, 1), (1, 0.87)))
    box = zones(t).select("zone", *[geo.bbox(F.col("geometry"))[i].alias(n) for i, n in enumerate(BOX)])
    shape = F.when(F.col("zone") % 2 == 1, F.array(main, corner)).otherwise(F.array(main))
    return box.select("zone", shape.alias("geometry"))


BOX = ["x0", "x1", "y0", "y1"]


@query("points_in_cut_zones", f"""
WITH p AS (SELECT pt, zone, (x - x0) / (x1 - x0) AS u, (y - y0) / (y1 - y0) AS v FROM {POINTS_SQL} JOIN {ZONES_SQL} ON x > x0 AND x < x1 AND y > y0 AND y < y1)
SELECT pt, zone FROM p WHERE (u + v < 0.97 AND NOT (u >= 0.26 AND v >= 0.26 AND u + v <= 0.77)) OR (zone % 2 = 1 AND u + v > 1.87)""")
def points_in_cut_zones(t: Tables):
    """The containing zones of each point where zones are triangles with a hole."""
    return X.point_in_polygon(points(t).select("pt", "x", "y"), "x", "y", cut_zones(t), "zone", "geometry").select("pt", "zone")


@query("cut_zone_geometry", f"""
SELECT zone, (x1 - x0) * (y1 - y0) * (0.47045 - 0.03125 + CASE WHEN zone % 2 = 1 THEN 0.00845 ELSE 0 END) AS area, zone % 2 = 1 AS is_multi, CAST(1 AS INTEGER) AS n_holes,
 (x1 - x0 + y1 - y0 + sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2)) * (1.22 + CASE WHEN zone % 2 = 1 THEN 0.13 ELSE 0 END) AS perimeter FROM {ZONES_SQL}""")
def cut_zone_geometry(t: Tables):
    """Area, outline, parts and holes of triangles with a hole."""
    g = F.col("geometry")
    return cut_zones(t).select(
        "zone", geo.area(g).alias("area"), (geo.parts(g) > 1).alias("is_multi"), geo.holes(g).alias("n_holes"), geo.perimeter(g).alias("perimeter")
    )


@query("spatial_fallback", f"""
WITH hit AS (SELECT pt, min(zone) AS zone FROM {POINTS_SQL} JOIN {ZONES_SQL} ON x > x0 AND x < x1 AND y > y0 AND y < y1 GROUP BY pt)
SELECT o_orderkey AS pt, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE coalesce(zone, o_custkey) END AS zone, o_orderstatus = 'F' AS by_code
FROM orders LEFT JOIN hit ON pt = o_orderkey""")
def spatial_fallback(t: Tables):
    """Only points without a valid code are located by position."""
    coded = points(t).join(
        t.orders.select(F.col("o_orderkey").alias("pt"), F.col("o_custkey").alias("c"), (F.col("o_orderstatus") == "F").alias("by_code")), "pt"
    )
    placed = X.locate(coded.filter(~F.col("by_code")), "pt", "x", "y", zones(t), "zone", "geometry")
    return coded.join(placed, "pt", "left").select(
        "pt", F.when(F.col("by_code"), F.col("c")).otherwise(F.coalesce("zone", "c")).alias("zone"), "by_code"
    )


TILES_SQL = """(SELECT c_custkey AS tile, CAST(c_nationkey AS VARCHAR) AS scope, c_custkey % 30 AS i, c_custkey // 30 AS j FROM customer)"""


@query("neighbouring_polygons", f"""
SELECT a.tile, b.tile AS neighbour FROM {TILES_SQL} a JOIN {TILES_SQL} b
 ON a.tile <> b.tile AND abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1""")
def neighbouring_polygons(t: Tables):
    """Touching tiles of a grid (edges and corners), both directions."""
    key = F.col("c_custkey")
    i, j = (key % 30).cast("double"), F.floor(key / 30).cast("double")
    tiles = t.customer.select(key.alias("tile"), geo.box_polygon(i, j, i + 1, j + 1).alias("geometry"))
    return X.neighbours(tiles, "tile", "geometry")


@query("neighbouring_triangles", f"""
SELECT a.tile, b.tile AS neighbour FROM {TILES_SQL} a JOIN {TILES_SQL} b
 ON a.tile <> b.tile AND abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1 AND NOT (a.i - b.i = a.j - b.j AND a.i <> b.i)""")
def neighbouring_triangles(t: Tables):
    """Lower halves of the tiles; boxes of diagonal neighbours touch, their triangles only
    along one diagonal."""
    key = F.col("c_custkey")
    i, j = (key % 30).cast("double"), F.floor(key / 30).cast("double")
    ring = F.array(geo.point(i, j), geo.point(i + 1, j), geo.point(i, j + 1), geo.point(i, j))
    tiles = t.customer.select(key.alias("tile"), F.array(F.array(ring)).alias("geometry"))
    return X.neighbours(tiles, "tile", "geometry")


@query("neighbours_same_scope", f"""
SELECT a.tile, b.tile AS neighbour FROM {TILES_SQL} a JOIN {TILES_SQL} b
 ON a.tile <> b.tile AND a.scope = b.scope AND abs(a.i - b.i) <= 1 AND abs(a.j - b.j) <= 1""")
def neighbours_same_scope(t: Tables):
    """Neighbours restricted to one group."""
    key = F.col("c_custkey")
    i, j = (key % 30).cast("double"), F.floor(key / 30).cast("double")
    tiles = t.customer.select(
        key.alias("tile"), F.col("c_nationkey").cast("string").alias("scope"), geo.box_polygon(i, j, i + 1, j + 1).alias("geometry")
    )
    return X.neighbours(tiles, "tile", "geometry", ["scope"])


@query("zonal_statistics", f"""
SELECT zone, CAST(trunc(min(v)) AS INTEGER) AS altitude_min, CAST(trunc(max(v)) AS INTEGER) AS altitude_max,
 CAST(printf('%.1f', CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) / count(v)) AS DOUBLE) AS altitude_moyenne
FROM {ZONES_SQL} LEFT JOIN {POINTS_SQL} ON x > x0 AND x < x1 AND y > y0 AND y < y1 AND v > 0 GROUP BY zone""")
def zonal_statistics(t: Tables):
    """Minimum, maximum and mean of the values in each zone; empty zones stay NULL."""
    return X.zonal_stats(points(t), "x", "y", "v", zones(t), "zone", "geometry")
