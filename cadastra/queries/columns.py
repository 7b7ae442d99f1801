"""Projections, filters, code mapping, tiers, formatting and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import columns as C
from cadastra.functions import dates as D
from cadastra.operators.sets import union_all
from cadastra.queries.registry import Tables, query


@query("typed_projection", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, o_orderstatus AS status
FROM orders""")
def typed_projection(t: Tables):
    """Rename and cast by a spec, drop the rest."""
    typed = C.enforce(
        t.orders,
        [
            ("o_orderkey", "id", "string"),
            ("o_orderdate", "day", "date"),
            ("o_totalprice", "price", "decimal(18,2)"),
            ("o_orderstatus", "status", "string"),
        ],
    )
    return typed.withColumns({"year": F.year("day"), "price": F.col("price").cast("double")}).drop("day")


@query("constant_filter", """
SELECT l_linestatus, count(*) AS n FROM lineitem
WHERE l_returnflag = 'R' AND l_linestatus <> 'F' AND regexp_matches(CAST(l_orderkey AS VARCHAR), '^[0-9]+$')
GROUP BY l_linestatus""")
def constant_filter(t: Tables):
    """Equality, inequality and pattern gate; the first two reach the scan."""
    rows = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "F"))
    gated = rows.filter(F.col("l_orderkey").cast("string").rlike("^[0-9]+$"))
    return gated.groupBy("l_linestatus").agg(F.count("*").alias("n"))


BRANDS = [("^Brand#1[0-9]$", "Brand#1x"), ("^Brand#2[0-4]$", "Brand#2x")]
BRANDS_SQL = """CASE WHEN regexp_matches(p_brand, '^Brand#1[0-9]$') THEN 'Brand#1x'
 WHEN regexp_matches(p_brand, '^Brand#2[0-4]$') THEN 'Brand#2x' ELSE p_brand END"""


@query("crosswalk_pattern", f"""
SELECT {BRANDS_SQL} AS code, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total_size
FROM part GROUP BY 1""")
def crosswalk_pattern(t: Tables):
    """Codes folded by the first matching pattern, then summed."""
    return t.part.groupBy(C.crosswalk(F.col("p_brand"), BRANDS).alias("code")).agg(
        F.count("*").alias("n"), F.sum("p_size").alias("total_size")
    )


@query("crosswalk_range", """
SELECT CASE WHEN p_size BETWEEN 1 AND 10 THEN 'S' WHEN p_size BETWEEN 11 AND 30 THEN 'M'
            ELSE p_type END AS code, count(*) AS n FROM part GROUP BY 1""")
def crosswalk_range(t: Tables):
    """P5: codes by closed number ranges."""
    code = C.crosswalk_ranges(F.col("p_size"), [(1, 10, "S"), (11, 30, "M")], F.col("p_type"))
    return t.part.groupBy(code.alias("code")).agg(F.count("*").alias("n"))


@query("crosswalk_unchanged", f"""
SELECT p_partkey, p_brand FROM part WHERE p_brand = {BRANDS_SQL}""")
def crosswalk_unchanged(t: Tables):
    """Only rows whose code the crosswalk leaves alone."""
    kept = t.part.filter(F.col("p_brand") == C.crosswalk(F.col("p_brand"), BRANDS))
    return kept.select("p_partkey", "p_brand")


@query("flag_derivation", """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F','P') THEN 1 ELSE 0 END AS flag_closed,
       CASE WHEN length(o_orderpriority) = 5 THEN 1 ELSE 0 END AS flag_short,
       CASE WHEN nullif(o_orderstatus,'P') = 'F' THEN 1 ELSE 0 END AS flag_known
FROM orders""")
def flag_derivation(t: Tables):
    """0/1 flags from membership, length and equality; unknown is 0."""
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        C.flag(status.isin("F", "P")).alias("flag_closed"),
        C.flag(F.length("o_orderpriority") == 5).alias("flag_short"),
        C.flag(F.nullif(status, F.lit("P")) == "F").alias("flag_known"),
    )


@query("tier_labels", """
SELECT tier, bin, reliability, count(*) AS n FROM (
 SELECT CASE WHEN v IS NULL THEN 'unknown' WHEN v < 950 THEN 'low' WHEN v < 1000 THEN 'mid' ELSE 'high' END AS tier,
        CASE WHEN p_size <= 10 THEN '1-10' WHEN p_size <= 25 THEN '11-25' ELSE '26+' END AS bin,
        CASE WHEN v >= 1000 THEN 'reliable' WHEN v >= 950 THEN 'caution' ELSE 'unreliable' END AS reliability
 FROM (SELECT p_size, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice END AS v FROM part))
GROUP BY ALL""")
def tier_labels(t: Tables):
    """Left-closed tiers with a label for NULL, right-closed bins, lower-bound tiers."""
    v = F.when(F.col("p_type") != "PROMO", F.col("p_retailprice"))
    return t.part.groupBy(
        C.tiers(v, [(950, "low"), (1000, "mid")], "high", missing="unknown").alias("tier"),
        C.tiers(F.col("p_size"), [(10, "1-10"), (25, "11-25")], "26+", closed="right").alias("bin"),
        C.tiers_from(v, [(1000, "reliable"), (950, "caution")], "unreliable").alias("reliability"),
    ).agg(F.count("*").alias("n"))


@query("non_blank_rows", """
SELECT lang, count(*) AS n FROM documents
WHERE text IS NOT NULL AND trim(nullif(source, 'src0')) <> '' GROUP BY lang""")
def non_blank_rows(t: Tables):
    """Rows whose text and source are neither NULL nor blank."""
    source = F.nullif("source", F.lit("src0"))
    kept = t.documents.filter(F.col("text").isNotNull() & C.not_blank(source))
    return kept.groupBy("lang").agg(F.count("*").alias("n"))


@query("presence_flag", """
SELECT c_custkey, k IS NOT NULL AS has_urgent, coalesce(n, 0) AS n_urgent
FROM customer LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders
  WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON c_custkey = k""")
def presence_flag(t: Tables):
    """Left join of pre-aggregated orders, presence flag and default fill."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    counts = urgent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.select("c_custkey").join(counts, "c_custkey", "left").select(
        "c_custkey", C.found(F.col("n")).alias("has_urgent"),
        F.coalesce("n", F.lit(0)).alias("n_urgent"),
    )


@query("total_or_parts", """
SELECT l_orderkey, l_linenumber,
       coalesce(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END, l_quantity + l_tax) AS amount
FROM lineitem""")
def total_or_parts(t: Tables):
    """The stated total, else the sum of its parts."""
    stated = F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        C.total_or_parts(stated, F.col("l_quantity"), F.col("l_tax")).alias("amount"),
    )


YEARS = [1995, 1996, 1997]


@query("prefixed_columns", """
SELECT o_custkey AS CODGEO, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS O, CAST(y AS INTEGER) AS year
FROM (SELECT *, year(o_orderdate) AS y FROM orders), (SELECT 1) WHERE y IN (1995, 1996, 1997)
GROUP BY o_custkey, y
UNION ALL
SELECT k, 0, 0, CAST(y AS INTEGER) FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE year(o_orderdate) IN (1995,1996,1997)),
 (VALUES (1995),(1996),(1997)) v(y)
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = k AND year(o_orderdate) = y)""")
def prefixed_columns(t: Tables):
    """Yearly column groups P95_, P96_, P97_ of one wide table, stacked by year."""
    year = F.year("o_orderdate")
    wide = t.orders.filter(year.isin(YEARS)).groupBy(F.col("o_custkey").alias("CODGEO")).agg(
        *[
            F.count_if((year == y) & (F.col("o_orderstatus") == s)).alias(f"P{y % 100}_{s}")
            for y in YEARS
            for s in ("F", "O")
        ]
    )
    return union_all([C.prefixed(wide, "CODGEO", f"P{y % 100}_", year=y) for y in YEARS])


@query("harmonized_vintages", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(1995 AS INTEGER) AS year, 'v1' AS version,
       o_totalprice AS median, CAST(NULL AS DOUBLE) AS gini FROM orders WHERE year(o_orderdate) = 1995
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), 1996, 'v2', CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END,
       CAST(o_custkey AS DOUBLE) FROM orders WHERE year(o_orderdate) = 1996""")
def harmonized_vintages(t: Tables):
    """Two vintages with other column names, decimal commas and junk, one schema."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    year = F.year("o_orderdate")
    key = F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("CODGEO")
    first = t.orders.filter(year == 1995).select(key, F.replace(price, F.lit("."), F.lit(",")).alias("MED95"))
    second = t.orders.filter(year == 1996).select(
        key,
        F.when(F.col("o_orderstatus") == "P", "n.d.").otherwise(F.concat(F.lit('"'), price, F.lit('" '))).alias("Q296"),
        F.col("o_custkey").alias("GI96"),
    )
    columns = ["median", "gini"]
    return union_all(
        [
            C.harmonize(first, "CODGEO", {"median": "MED95", "gini": "GI95"}, columns, year=1995, version="v1"),
            C.harmonize(second, "CODGEO", {"median": "Q296", "gini": "GI96"}, columns, year=1996, version="v2"),
        ]
    )


@query("empty_relation", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS label_name, CAST(NULL AS VARCHAR) AS label_type FROM customer""")
def empty_relation(t: Tables):
    """A typed relation without rows fixes the schema of what is stacked onto it."""
    blank = C.empty(t.spark, "id string, label_name string, label_type string")
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("label_name"))
    return union_all([blank, rows])


@query("date_keys", """
SELECT CAST(year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate) AS INTEGER) AS date_id,
       CAST(year(o_orderdate)*10000 + 101 AS INTEGER) AS year_id, count(*) AS n FROM orders GROUP BY 1, 2""")
def date_keys(t: Tables):
    """Day and year surrogate keys."""
    day = F.col("o_orderdate")
    return t.orders.groupBy(
        C.date_key(day).alias("date_id"), C.year_key(F.year(day)).alias("year_id")
    ).agg(F.count("*").alias("n"))


@query("text_keys", """
SELECT l_orderkey || '|' || l_linenumber || '|' || nullif(l_returnflag, 'A') AS strict_key,
       concat_ws('|', l_orderkey, l_linenumber, nullif(l_returnflag, 'A')) AS loose_key FROM lineitem""")
def text_keys(t: Tables):
    """Composite keys; the strict one is NULL if a part is, the loose one skips it."""
    parts = [
        F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
        F.nullif("l_returnflag", F.lit("A")),
    ]
    return t.lineitem.select(
        C.text_key(*parts).alias("strict_key"), F.concat_ws("|", *parts).alias("loose_key")
    )


@query("guarded_ratio", """
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
   / nullif(CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE), 0) * 100 AS price_pct
FROM lineitem GROUP BY l_suppkey""")
def guarded_ratio(t: Tables):
    """Ratio of sums, NULL for a zero divisor."""
    money = lambda c: F.sum(c.cast("decimal(18,2)"))
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)
    sums = t.lineitem.groupBy("l_suppkey").agg(
        money(F.col("l_extendedprice")).alias("p"), money(returned).alias("q")
    )
    return sums.select("l_suppkey", C.ratio(F.col("p"), F.col("q"), 100).alias("price_pct"))


@query("trend_texts", """
SELECT c_custkey,
  CASE WHEN v IS NULL THEN '—' WHEN v > 0 THEN '▲ ' || printf('%+.2f', v) || '%'
       WHEN v < 0 THEN '▼ ' || printf('%+.2f', v) || '%' ELSE '▬ ' || printf('%+.2f', v) || '%' END AS trend,
  CASE WHEN v IS NULL THEN '—' ELSE printf('%.2f', v) END AS plain,
  format('{:,}', c_custkey * 1000) AS thousands
FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS v FROM customer)""")
def trend_texts(t: Tables):
    """Signed, plain and grouped number texts with arrows."""
    v = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal"))
    return t.customer.select(
        "c_custkey", C.trend_text(v, 2, "%").alias("trend"), C.ratio_text(v, 2).alias("plain"),
        C.thousands_text(F.col("c_custkey") * 1000).alias("thousands"),
    )


@query("slugs", """
SELECT p_partkey, replace(replace(replace(replace(lower(p_name || '-L''/' || p_type), ' ', '_'), '-', '_'), '''', ''), '/', '_') AS slug
FROM part""")
def slugs(t: Tables):
    """P20: file-name form of a name."""
    name = F.concat(F.col("p_name"), F.lit("-L'/"), F.col("p_type"))
    return t.part.select("p_partkey", C.slug(name).alias("slug"))


@query("rebased_paths", """
SELECT page_id, 'https://thumbs/' || regexp_replace(CASE WHEN url LIKE '%#%' THEN NULL ELSE url END, '^https?://', '') AS path FROM pages""")
def rebased_paths(t: Tables):
    """Prefix replaced, NULL stays NULL."""
    url = F.when(~F.col("url").contains("#"), F.col("url"))
    return t.pages.select("page_id", C.rebase_path(url, "https?://", "https://thumbs").alias("path"))


@query("string_functions", r"""
SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS len, substr(p_name, 2, 3) AS mid, left(p_name, 2) AS head,
       upper(p_name) AS up, trim('  ' || p_name || ' ') AS trimmed, trim('" ' || p_name || '"', ' "') AS unquoted,
       split_part(p_name, ' ', 2) AS second, split_part(p_name, ' : ', 2) AS absent,
       CAST(len(string_split(p_name, ' ')) AS INTEGER) AS words, p_name LIKE '%bolt' AS is_bolt,
       regexp_matches(p_brand, '#2') AS has_two, regexp_replace(p_name, '[aeiou]', '_', 'g') AS masked,
       regexp_extract(p_brand, '#(\d+)', 1) AS brand_no, regexp_extract(p_type, '^X(.)', 1) AS none,
       array_to_string(string_split_regex(p_type, ''), '.') AS spelled, md5(concat_ws('|', p_name, p_brand)) AS row_hash,
       nullif(p_type, 'PROMO') AS type_or_null, lpad(CAST(p_size AS VARCHAR), 2, '0') AS padded
FROM part""")
def string_functions(t: Tables):
    """The string functions in use."""
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.length(name).alias("len"),
        F.substring(name, 2, 3).alias("mid"),
        F.left(name, F.lit(2)).alias("head"),
        F.upper(name).alias("up"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.btrim(F.concat(F.lit('" '), name, F.lit('"')), F.lit(' "')).alias("unquoted"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("second"),
        F.split_part(name, F.lit(" : "), F.lit(2)).alias("absent"),
        F.size(F.split(name, " ")).alias("words"),
        name.like("%bolt").alias("is_bolt"),
        brand.rlike("#2").alias("has_two"),
        F.regexp_replace(name, "[aeiou]", "_").alias("masked"),
        F.regexp_extract(brand, r"#(\d+)", 1).alias("brand_no"),
        F.regexp_extract(kind, "^X(.)", 1).alias("none"),
        F.array_join(F.split(kind, ""), ".").alias("spelled"),
        F.md5(F.concat_ws("|", name, brand)).alias("row_hash"),
        F.nullif(kind, F.lit("PROMO")).alias("type_or_null"),
        C.zfill(F.col("p_size").cast("string"), 2).alias("padded"),
    )


@query("date_functions", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter, strftime(o_orderdate, '%Y-%m') AS year_month,
       CAST(strftime(o_orderdate, '%V') AS INTEGER) AS iso_week, CAST(isodow(o_orderdate) AS INTEGER) AS iso_dow,
       isodow(o_orderdate) >= 6 AS weekend, strftime(o_orderdate, '%A') AS name_en, strftime(o_orderdate, '%B') AS month_en,
       CAST(try_strptime(strftime(o_orderdate, '%Y/%m/%d'), '%Y/%m/%d') AS DATE) AS parsed,
       CAST(try_strptime(o_orderstatus, '%Y/%m/%d') AS DATE) AS unparsed,
       strftime(o_orderdate, 'base_%Y%m%dT%H%M%S.csv') AS stamped, CAST(o_orderdate AS TIMESTAMP) AS stamp,
       CAST(trunc(datediff('day', DATE '1923-01-17', CAST(o_orderdate AS DATE)) / 29.53059::DOUBLE) AS INTEGER) + 1 AS lunation
FROM orders""")
def date_functions(t: Tables):
    """Date parts, names, parsing, sortable stamps, lunation."""
    d = F.col("day")
    days = t.orders.select("o_orderstatus", F.col("o_orderdate").cast("date").alias("day")).distinct()
    stamped = D.stamped_name("base", F.to_timestamp_ntz(d.cast("string")), ".csv")
    return days.select(
        "day",
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        D.year_month(d).alias("year_month"),
        F.weekofyear(d).alias("iso_week"),
        D.iso_weekday(d).alias("iso_dow"),
        D.is_weekend(d).alias("weekend"),
        D.day_name(d, "en").alias("name_en"),
        D.month_name(d, "en").alias("month_en"),
        D.slashed_date(F.date_format(d, "yyyy/MM/dd")).alias("parsed"),
        D.slashed_date(F.col("o_orderstatus")).alias("unparsed"),
        stamped.alias("stamped"),
        D.stamp_of(stamped).cast("timestamp_ntz").alias("stamp"),
        D.lunation(d).alias("lunation"),
    ).distinct()


@query("easter_days", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
p AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y),
q AS (SELECT y, a, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS h, b, c FROM p),
r AS (SELECT y, a, h, (32 + 2*(b % 4) + 2*(c//4) - h - (c % 4)) % 7 AS l FROM q),
s AS (SELECT y, h + l - 7*((a + 11*h + 22*l)//451) + 114 AS k FROM r)
SELECT y AS year, make_date(y, k // 31, (k % 31) + 1) AS easter FROM s""")
def easter_days(t: Tables):
    """F32: Easter Sunday of every year with orders."""
    years = t.orders.select(F.year("o_orderdate").alias("year")).distinct()
    return years.select("year", D.easter(F.col("year")).alias("easter"))


@query("moon_phases", """
SELECT part, name, illumination, count(*) AS n FROM (
 SELECT CAST(floor(p) AS INTEGER) AS part,
  CASE WHEN p < 1 THEN 'New Moon' WHEN p < 6 THEN 'Waxing Crescent' WHEN p < 8 THEN 'First Quarter'
       WHEN p < 13 THEN 'Waxing Gibbous' WHEN p < 15 THEN 'Full Moon' WHEN p < 20 THEN 'Waning Gibbous'
       WHEN p < 22 THEN 'Last Quarter' WHEN p < 27 THEN 'Waning Crescent' ELSE 'New Moon' END AS name,
  CAST(printf('%.2f', greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - abs(p - 14.0::DOUBLE) / 14.0::DOUBLE))) AS DOUBLE) AS illumination
 FROM (SELECT CAST(l_quantity AS DOUBLE) * 0.5625::DOUBLE AS p FROM lineitem)) GROUP BY ALL""")
def moon_phases(t: Tables):
    """phase bands and the illumination triangle."""
    phase = F.col("l_quantity").cast("double") * F.lit(0.5625)
    return t.lineitem.groupBy(
        F.floor(phase).cast("int").alias("part"), D.moon_phase_name(phase).alias("name"),
        D.moon_illumination(phase).alias("illumination"),
    ).agg(F.count("*").alias("n"))


@query("market_closures", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45),
h AS (SELECT day FROM d WHERE day(day) = 1)
SELECT d.day FROM d LEFT JOIN s ON d.day = s.day LEFT JOIN h ON d.day = h.day
WHERE isodow(d.day) < 6 AND CASE WHEN d.day BETWEEN (SELECT min(day) FROM s) AND (SELECT max(day) FROM s)
  THEN s.day IS NULL ELSE h.day IS NOT NULL END""")
def market_closures(t: Tables):
    """weekdays without a session, or public holidays outside the published sessions."""
    from cadastra.plans.calendar import market_holidays

    days = t.orders.select(F.col("o_orderdate").cast("date").alias("date")).distinct()
    heavy = (F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)
    sessions = t.lineitem.filter(heavy).select(F.col("l_shipdate").cast("date").alias("date")).distinct()
    closed = market_holidays(days, sessions, days.filter(F.day("date") == 1))
    return closed.select(F.col("date").alias("day"))


@query("math_functions", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 3) AS r, least(l_quantity, 20.0::DOUBLE, nullif(l_tax, 0)) AS low,
       CAST(trunc(l_quantity / 3) AS INTEGER) AS truncated, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half_even,
       (CASE WHEN l_returnflag = 'R' THEN 1.3 ELSE 1.0 END)::DOUBLE * (CASE WHEN l_linestatus = 'O' THEN 1.5 ELSE 1.0 END)::DOUBLE AS factor
FROM lineitem""")
def math_functions(t: Tables):
    """Rounding, row-wise minimum, truncation, half-even, factor product."""
    quantity = F.col("l_quantity")
    factors = [(F.col("l_returnflag") == "R", 1.3), (F.col("l_linestatus") == "O", 1.5)]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        C.round_sql(F.col("l_extendedprice") / 7, 3).alias("r"),
        F.least(quantity, F.lit(20.0), F.nullif("l_tax", F.lit(0.0))).alias("low"),
        (quantity / 3).cast("int").alias("truncated"),
        F.bround(quantity / 2, 0).cast("int").alias("half_even"),
        C.multiplier(factors).alias("factor"),
    )


@query("json_and_arrays", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS broken,
       json_extract_string('[' || event_id || ',7]', '$[0]') AS first_item,
       CASE WHEN event_type IN ('view', 'click') THEN '{"kind":"' || event_type || '"}' END AS record,
       CASE event_type WHEN 'view' THEN 'vue' WHEN 'click' THEN 'clic' END AS label,
       string_split(event_type, 'i')[1] AS head, string_split(event_type, 'i')[-1] AS tail,
       CAST(event_id + length(event_type) AS BIGINT) AS part_sum
FROM events""")
def json_and_arrays(t: Tables):
    """JSON fields, broken JSON, literal maps, first and last item, sums over items."""
    kind = F.col("event_type")
    pieces = F.split(kind, "i")
    record = F.to_json(F.struct(F.when(kind.isin("view", "click"), kind).alias("kind")))
    items = F.array(F.col("event_id"), F.length(kind).cast("bigint"))
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.get_json_object(kind, "$.k").alias("broken"),
        F.get_json_object(F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit(",7]")), "$[0]").alias("first_item"),
        F.nullif(record, F.lit("{}")).alias("record"),
        C.lookup(kind, {"view": "vue", "click": "clic"}).alias("label"),
        F.element_at(pieces, 1).alias("head"),
        F.element_at(pieces, -1).alias("tail"),
        F.aggregate(items, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("part_sum"),
    )


@query("exploded_lists", """
SELECT line, count(*) AS n FROM (SELECT trim(unnest(string_split(text, chr(10)))) AS line FROM documents)
WHERE line <> '' GROUP BY line""")
def exploded_lists(t: Tables):
    """one row per list item, blanks dropped, counted over whole texts."""
    items = t.documents.select(F.explode(F.split("text", "\n")).alias("item"))
    lines = items.select(F.trim("item").alias("line")).filter("line <> ''")
    return lines.groupBy("line").agg(F.count("*").alias("n"))
