"""Aggregations, windows, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.functions import columns as C
from cadastra.operators import aggregates as A
from cadastra.operators import windows as W
from cadastra.plans import names as N
from cadastra.plans.constants import STOPWORDS
from cadastra.queries.registry import Tables, query

MONEY = "decimal(18,2)"


@query("sum_by_key", """
SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY 1""")
def sum_by_key(t: Tables):
    """G1: sums per key, folded on the map side."""
    return t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("quantity"), F.sum("l_linenumber").alias("lines")
    )


@query("conditional_max_pivot", """
SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent_f,
 max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS any_o, max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS low
FROM orders GROUP BY 1""")
def conditional_max_pivot(t: Tables):
    """Long to wide by conditions, NULL where none holds."""
    price, status, priority = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    return A.pivot_when(
        t.orders, ["o_custkey"],
        {
            "urgent_f": ((status == "F") & (priority == "1-URGENT"), price),
            "any_o": (status == "O", price),
            "low": (priority == "5-LOW", price),
        },
    )


@query("conditional_sum_pivot", """
SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS r,
 CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE) AS af,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS every FROM lineitem GROUP BY 1""")
def conditional_sum_pivot(t: Tables):
    """Conditional sums, NULL (not 0) without rows."""
    q, flag = F.col("l_quantity").cast(MONEY), F.col("l_returnflag")
    wide = A.pivot_when(
        t.lineitem, ["l_suppkey"],
        {"r": (flag == "R", q), "af": ((flag == "A") & (F.col("l_linestatus") == "F"), q), "every": (F.lit(True), q)},
        how="sum",
    )
    return wide.select("l_suppkey", *[F.col(c).cast("double").alias(c) for c in ("r", "af", "every")])


@query("distinct_counts", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT left(CAST(l_partkey AS VARCHAR), 1)) AS groups FROM lineitem GROUP BY 1""")
def distinct_counts(t: Tables):
    """Distinct members and distinct prefixes; pairs fold first."""
    pairs = t.lineitem.select("l_suppkey", "l_partkey").distinct()
    prefixes = pairs.groupBy("l_suppkey", F.left(F.col("l_partkey").cast("string"), F.lit(1))).agg(F.count("*").alias("n"))
    return prefixes.groupBy("l_suppkey").agg(F.sum("n").alias("parts"), F.count("*").alias("groups"))


@query("distinct_buckets", """
SELECT l_suppkey, count(DISTINCT l_partkey) AS total, count(DISTINCT CASE WHEN p_type = 'PROMO' THEN l_partkey END) AS promo,
 count(DISTINCT CASE WHEN p_type IN ('SMALL','LARGE') THEN l_partkey END) AS sized,
 count(DISTINCT CASE WHEN p_type NOT IN ('PROMO','SMALL','LARGE') OR p_type IS NULL THEN l_partkey END) AS other,
 count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def distinct_buckets(t: Tables):
    """Many conditional distinct counts without multiplying rows. The pairs of supplier and
    part are folded before the part table is joined."""
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    kind = F.col("p_type")
    counted = A.distinct_buckets(
        t.lineitem, ["l_suppkey"], "l_partkey", {"returned": F.col("l_returnflag") == "R"}, "total",
        kinds,
        {
            "promo": kind == "PROMO",
            "sized": kind.isin("SMALL", "LARGE"),
            "other": kind.isNull() | ~kind.isin("PROMO", "SMALL", "LARGE"),
        },
    )
    return counted.select("l_suppkey", "total", "promo", "sized", "other", "returned")


@query("weighted_rate", """
SELECT l_partkey, round(CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) * 1000.0::DOUBLE / nullif(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 0), 2) AS rate,
 bool_or(l_returnflag = 'R') AS any_returned, CASE WHEN max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = 1 THEN 'open' ELSE 'closed' END AS state
FROM lineitem GROUP BY 1""")
def weighted_rate(t: Tables):
    """Rate from sums, any-flags."""
    total = lambda c: F.sum(F.col(c).cast(MONEY)).cast("double")
    folded = t.lineitem.groupBy("l_partkey").agg(
        total("l_discount").alias("d"), total("l_quantity").alias("q"),
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        F.bool_or(F.col("l_linestatus") == "O").alias("_open"),
    )
    return folded.select(
        "l_partkey", C.round_sql(C.ratio(F.col("d") * 1000.0, F.col("q")), 2).alias("rate"), "any_returned",
        F.when(F.col("_open"), "open").otherwise("closed").alias("state"),
    )


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    """G9."""
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("dedupe_keep_first", """
SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first_order, arg_min(o_totalprice, o_orderkey) AS first_price FROM orders GROUP BY 1""")
def dedupe_keep_first(t: Tables):
    """First row per key in a stated order."""
    first = A.dedupe_first(t.orders, ["o_custkey"], [F.col("o_orderkey").asc()])
    return first.select("o_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_totalprice").alias("first_price"))


@query("group_benchmark", """
SELECT c_custkey, c_nationkey, c_acctbal, avg_bal, c_acctbal / nullif(avg_bal, 0) AS ratio FROM customer JOIN
 (SELECT c_nationkey AS k, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_bal FROM customer GROUP BY 1) ON c_nationkey = k""")
def group_benchmark(t: Tables):
    """Every row against its group mean, all groups in one pass."""
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    compared = A.group_benchmark(rows, ["c_nationkey"], {"avg_bal": "c_acctbal"})
    return compared.withColumn("ratio", C.ratio(F.col("c_acctbal"), F.col("avg_bal")))


@query("describe_groups", """
SELECT lang, count(*) AS n, min(v) AS min_value, round(sum(v)::DOUBLE / count(v), 1) AS avg_value, median(v) AS median_value,
 max(v) AS max_value, round(stddev_samp(v), 1) AS stddev_value FROM (SELECT lang, length(source) + quarter(DATE '2024-01-01') * 0 AS v FROM documents) GROUP BY lang""")
def describe_groups(t: Tables):
    """Descriptive statistics of a small-domain value through its counts."""
    stats = A.describe(t.documents, ["lang"], F.length("source"))
    return stats.withColumns({"min_value": F.col("min_value").cast("bigint"), "max_value": F.col("max_value").cast("bigint")})


@query("exact_median_by_group", "SELECT o_orderpriority, median(o_totalprice) AS median_price FROM orders GROUP BY 1")
def exact_median_by_group(t: Tables):
    """Exact median of an unbounded value per group; only the bracketed middle is ranked."""
    return A.exact_median(t.orders, ["o_orderpriority"], "o_totalprice", "median_price")


@query("exact_median_overall", "SELECT median(l_extendedprice) AS median_price, count(*) AS n FROM lineitem")
def exact_median_overall(t: Tables):
    """Exact median of a whole column."""
    middle = A.exact_median(t.lineitem, [], "l_extendedprice", "m").scalar()
    return t.lineitem.agg(F.count("*").alias("n")).withColumn("median_price", middle)


@query("frequency_having", "SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1 HAVING count(*) >= 60")
def frequency_having(t: Tables):
    """Frequencies above a minimum."""
    return A.frequency(t.customer, {"nation": F.col("c_nationkey")}, at_least=60)


@query("group_by_all", """
SELECT n_name, year(o_orderdate)::INTEGER AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def group_by_all(t: Tables):
    """Sum over all other columns; orders are folded per customer before the joins."""
    per_customer = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("v")
    )
    return t.spark.sql(
        """SELECT n_name, year, CAST(sum(v) AS DOUBLE) AS total FROM {per_customer}
           JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY ALL""",
        per_customer=per_customer, customer=t.customer, nation=t.nation,
    ).select("n_name", "year", "total")


@query("ordered_listagg", """
SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments FROM customer GROUP BY 1""")
def ordered_listagg(t: Tables):
    """Sorted distinct texts per group; pairs fold first."""
    pairs = t.customer.select("c_nationkey", "c_mktsegment").distinct()
    return pairs.groupBy("c_nationkey").agg(
        F.expr("listagg(c_mktsegment, ', ') WITHIN GROUP (ORDER BY c_mktsegment)").alias("segments")
    )


@query("group_rollup", """
SELECT c_nationkey, min(c_mktsegment) AS first_segment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total, max(c_acctbal) AS top FROM customer GROUP BY 1""")
def group_rollup(t: Tables):
    """First (made definite by minimum), count, sum and maximum."""
    return t.customer.groupBy("c_nationkey").agg(
        F.min("c_mktsegment").alias("first_segment"), F.count("*").alias("n"),
        F.sum(F.col("c_acctbal").cast(MONEY)).cast("double").alias("total"), F.max("c_acctbal").alias("top"),
    )


@query("group_completeness", """
SELECT c_nationkey, c_mktsegment, n_done, n_total, round_even(n_done::DOUBLE / n_total * 100, 1) AS pct_done, n_done = n_total AS is_complete FROM (
 SELECT c_nationkey, c_mktsegment, count(*) FILTER (WHERE k IS NOT NULL) AS n_done, count(*) AS n_total
 FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 300000) ON c_custkey = k GROUP BY 1, 2)""")
def group_completeness(t: Tables):
    """Done share of each group and whether it is complete."""
    big = t.orders.filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("done")).distinct()
    rows = t.customer.join(big, "c_custkey", "left")
    return A.completeness(rows, ["c_nationkey", "c_mktsegment"], F.col("done"))


@query("long_to_wide", """
SELECT o_custkey AS id, arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent,
 arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderpriority = '5-LOW') AS low, CAST(NULL AS DOUBLE) AS never FROM orders GROUP BY 1""")
def long_to_wide(t: Tables):
    """Measure rows to columns, the last value wins, absent measures are NULL."""
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("m"), F.col("o_totalprice").alias("v"), "o_orderkey")
    return A.long_to_wide(rows, ["id"], "m", "v", "o_orderkey", {"1-URGENT": "urgent", "5-LOW": "low", "9-NEVER": "never"})


@query("global_kpis", """
SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
 round(count(*) FILTER (WHERE o_orderstatus = 'F') * 100.0::DOUBLE / count(*), 2) AS pct_f FROM orders""")
def global_kpis(t: Tables):
    """One-row figures; per-customer counts fold first."""
    folded = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("v")
    )
    return folded.agg(
        F.sum("n").alias("n"), F.count("*").alias("customers"), F.sum("v").cast("double").alias("total"),
        C.round_sql(F.sum("f") * F.lit(100.0) / F.sum("n"), 2).alias("pct_f"),
    )


@query("threshold_badges", """
SELECT label, value, minimum FROM (SELECT count(*)::DOUBLE AS n, max(o_totalprice) AS top FROM orders),
 LATERAL (SELECT * FROM (VALUES ('10 orders', n, 10.0::DOUBLE), ('100k orders', n, 100000.0::DOUBLE), ('high price', top, 400000.0::DOUBLE)) v(label, value, minimum)) WHERE value >= minimum""")
def threshold_badges(t: Tables):
    """Badges whose metric reaches its minimum."""
    kpis = t.orders.agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    return A.badges(kpis, [("10 orders", "n", 10), ("100k orders", "n", 100000), ("high price", "top", 400000)])


@query("distinct_group_sum", """
SELECT CAST(sum(d) AS BIGINT) AS days, CAST(sum(k) AS BIGINT) AS transfers FROM (SELECT DISTINCT c_mktsegment, length(c_mktsegment) AS d, 0 AS k FROM customer
 UNION ALL SELECT NULL, 0, greatest(count(*) - 1, 0) * 2 FROM customer GROUP BY c_nationkey)""")
def distinct_group_sum(t: Tables):
    """Each group counted once; steps between the members of a group."""
    once = t.customer.select("c_mktsegment").distinct().agg(F.sum(F.length("c_mktsegment")).alias("days"))
    per_nation = t.customer.groupBy("c_nationkey").agg((F.greatest(F.count("*") - 1, F.lit(0)) * 2).alias("k"))
    steps = per_nation.agg(F.sum("k")).scalar()
    return once.withColumn("transfers", steps)


@query("token_top", """
SELECT word, count(*) AS n FROM (SELECT upper(left(w, 1)) || lower(substr(w, 2)) AS word FROM (
  SELECT unnest(string_split(replace(replace(p_name || '-' || p_type, '-', ' '), '''', ' '), ' ')) AS w FROM part) WHERE length(w) > 1 AND lower(w) NOT IN ('en', 'sur'))
GROUP BY word ORDER BY n DESC, word LIMIT 15""")
def token_top(t: Tables):
    """Top-15 words of names without stopwords."""
    return A.token_counts(t.part, F.concat_ws("-", "p_name", "p_type"), STOPWORDS, 15)


@query("pattern_tally", """
SELECT 'sur' AS label, count(*) FILTER (WHERE regexp_matches(text, '-sur-| sur ')) AS n FROM documents UNION ALL
SELECT 'the', count(*) FILTER (WHERE regexp_matches(text, '-the-| the ')) FROM documents UNION ALL
SELECT 'zzz', count(*) FILTER (WHERE regexp_matches(text, '-zzz-| zzz ')) FROM documents""")
def pattern_tally(t: Tables):
    """Rows matching each pattern over whole texts in one scan."""
    return A.pattern_tally(t.documents, F.col("text"), {w: f"-{w}-| {w} " for w in ("sur", "the", "zzz")})


@query("members_of_top_groups", """
SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)""")
def members_of_top_groups(t: Tables):
    """All members of the five largest groups."""
    return A.members_of_top_groups(t.customer, "c_nationkey", F.count("*"), 5).select("c_custkey", "c_nationkey")


# -- windows ---------------------------------------------------------------------------------


@query("latest_per_key", """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM (
 SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1""")
def latest_per_key(t: Tables):
    """Newest qualifying row per key; cut to one row per key before the shuffle."""
    newest = W.latest_per_key(
        t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], F.col("o_orderstatus") != "P"
    )
    return newest.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice")


@query("surrogate_id", "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_custkey FROM orders")
def surrogate_id(t: Tables):
    """Dense id in key order without a single-task window."""
    return W.surrogate_id(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], "id")


@query("first_of_group_flag", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 AS is_primary FROM orders""")
def first_of_group_flag(t: Tables):
    """First row of each key marked."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return W.flag_extreme(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "is_primary").drop("o_orderdate")


@query("latest_flag", """
SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1 AS is_latest FROM events""")
def latest_flag(t: Tables):
    """Newest row of each key marked."""
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    return W.flag_extreme(rows, ["user_id", "event_type"], ["ts", "event_id"], "is_latest", last=True).drop("ts")


@query("previous_state", """
SELECT event_id, user_id, event_type, lag(event_type) OVER w AS previous_event_type, lag(value) OVER w AS previous_value
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def previous_state(t: Tables):
    """State before each event, by a scan of even ranges."""
    rows = t.events.select("event_id", "user_id", "event_type", "value", "ts")
    staged = W.previous_state(rows, ["user_id"], ["ts", "event_id"], ["event_type", "value"])
    return staged.drop("ts", "value")


@query("event_transitions", """
SELECT kind, count(*) AS n FROM (SELECT CASE WHEN p IS NULL THEN 'initial' WHEN p = event_type THEN 'update' WHEN p = 'view' AND event_type = 'purchase' THEN 'upgrade'
  WHEN p = 'purchase' AND event_type = 'view' THEN 'downgrade' ELSE 'change' END AS kind
 FROM (SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)) GROUP BY 1""")
def event_transitions(t: Tables):
    """Kinds of state change."""
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    staged = W.previous_state(rows, ["user_id"], ["ts", "event_id"], ["event_type"])
    before, now = F.col("previous_event_type"), F.col("event_type")
    kind = C.choose(
        [
            (before.isNull(), F.lit("initial")),
            (before == now, F.lit("update")),
            ((before == "view") & (now == "purchase"), F.lit("upgrade")),
            ((before == "purchase") & (now == "view"), F.lit("downgrade")),
        ],
        F.lit("change"),
    )
    return staged.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("carried_forward", """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events""")
def carried_forward(t: Tables):
    """Running last known value (as used for section labels), by a scan of even ranges."""
    rows = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("p"))
    carried = W.carry_forward(rows, ["user_id"], ["ts", "event_id"], "p", "last_purchase")
    return carried.select("event_id", "last_purchase")


@query("share_of_total", """
SELECT letter, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 1) AS percentage FROM (SELECT upper(left(p_name, 1)) AS letter, count(*) AS n FROM part GROUP BY 1)""")
def share_of_total(t: Tables):
    """Percent of the total, the total being a scalar subquery."""
    return N.first_letters(t.part, "p_name")


# -- ordering --------------------------------------------------------------------------------


@query("ordered_panel", """
SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 ORDER BY 1, 2""")
def ordered_panel(t: Tables):
    """O1: a result in key order (range-partitioned sort)."""
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    rows = per_customer.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    return rows.groupBy("c_nationkey", "year").agg(F.sum("n").alias("n")).orderBy("c_nationkey", "year")


@query("nulls_last_top", """
SELECT p_partkey, nullif(p_size, 50) AS size FROM part ORDER BY nullif(p_size, 50) DESC NULLS LAST, p_partkey LIMIT 25""")
def nulls_last_top(t: Tables):
    """Descending with NULLs last, under an optional limit."""
    rows = t.part.select("p_partkey", F.nullif("p_size", F.lit(50)).alias("size"))
    return A.top(rows, 25, F.col("size").desc_nulls_last(), F.col("p_partkey").asc())


@query("top_and_bottom", """
SELECT * FROM (SELECT 'top' AS side, c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'bottom', c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 10)""")
def top_and_bottom(t: Tables):
    """O3: k largest and k smallest rows with a tiebreak."""
    rows = t.customer.select("c_custkey", "c_acctbal")
    side = lambda name, order: A.top(rows.select(F.lit(name).alias("side"), "*"), 10, order, F.col("c_custkey").asc())
    return side("top", F.col("c_acctbal").desc()).unionByName(side("bottom", F.col("c_acctbal").asc()))


@query("extreme_rows", """
SELECT c_mktsegment, arg_max(c_name, c_acctbal) AS richest, arg_min(c_name, c_acctbal) AS poorest FROM
 (SELECT c_mktsegment, c_name, c_acctbal * 1000000 + c_custkey / 1000000.0 AS c_acctbal FROM customer) GROUP BY 1""")
def extreme_rows(t: Tables):
    """Names at the largest and smallest value, ties by key."""
    order = F.struct("c_acctbal", "c_custkey")
    return t.customer.groupBy("c_mktsegment").agg(
        F.max_by("c_name", order).alias("richest"), F.min_by("c_name", order).alias("poorest")
    )


@query("series_of_one_key", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders) GROUP BY 1 ORDER BY 1""")
def series_of_one_key(t: Tables):
    """The ordered series of one key; the key is a scalar subquery."""
    key = t.orders.agg(F.min("o_custkey")).scalar()
    rows = t.orders.filter(F.col("o_custkey") == key)
    return rows.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n")).orderBy("year")
