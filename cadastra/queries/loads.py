"""History, appends, quality, manifests, provenance, files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadastra.functions.columns import round_exact
from cadastra.operators import history as H
from cadastra.operators import loads as L
from cadastra.operators import manifest as M
from cadastra.operators import provenance as P
from cadastra.operators import quality as Q
from cadastra.operators import stored as S
from cadastra.queries.registry import Tables, query
from cadastra.session import ensure_checkpoint_dir, shuffle_partitions
from cadastra.sources import catalog, readers, writers

FIRST, SECOND = "2024-01-01", "2024-07-01"
LOADED = "2024-07-02 03:04:05"


def scratch(t: Tables, name: str) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    return f"{ensure_checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def first_delivery(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.lit(None).cast("string").alias("note"))


def second_delivery(t: Tables):
    """Nation 3 is gone, BUILDING changes, in FURNITURE the value moves to the next column;
    suppliers are new."""
    kept = t.customer.filter(F.col("c_nationkey") != 3)
    segment = F.col("c_mktsegment")
    changed = kept.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"),
        F.when(segment == "BUILDING", "CONSTRUCTION").when(segment != "FURNITURE", segment).alias("segment"),
        F.when(segment == "FURNITURE", segment).alias("note"),
    )
    new = t.supplier.select((-F.col("s_suppkey") - 1).alias("id"), F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("segment"), F.lit(None).cast("string").alias("note"))
    return changed.unionByName(new)


def two_loads(t: Tables):
    blank = H.empty_history(t.spark, first_delivery(t).schema)
    first = H.scd2_merge(blank, first_delivery(t), ["id", "nation"], FIRST, f"{FIRST} 00:00:00")
    return H.scd2_merge(first, second_delivery(t), ["id", "nation"], SECOND, LOADED)


MERGED_SQL = f"""v1 AS (SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS note FROM customer),
v2 AS (SELECT c_custkey AS id, c_nationkey AS nation, CASE c_mktsegment WHEN 'BUILDING' THEN 'CONSTRUCTION' WHEN 'FURNITURE' THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN c_mktsegment END AS note FROM customer WHERE c_nationkey <> 3
  UNION ALL SELECT -s_suppkey - 1, s_nationkey, 'SUPPLIER', NULL FROM supplier),
h AS (
 SELECT md5(concat_ws('|', v1.id, v1.nation, '{FIRST}')) AS surrogate_key, v1.id, v1.nation, v1.segment, v1.note, DATE '{FIRST}' AS effective_date,
  CASE WHEN v2.id IS NOT NULL AND v2.segment IS NOT DISTINCT FROM v1.segment AND v2.note IS NOT DISTINCT FROM v1.note THEN DATE '9999-12-31' ELSE DATE '{SECOND}' END AS expiry_date,
  (v2.id IS NOT NULL AND v2.segment IS NOT DISTINCT FROM v1.segment AND v2.note IS NOT DISTINCT FROM v1.note) AS is_current
 FROM v1 LEFT JOIN v2 ON v1.id = v2.id AND v1.nation = v2.nation
 UNION ALL
 SELECT md5(concat_ws('|', v2.id, v2.nation, '{SECOND}')), v2.id, v2.nation, v2.segment, v2.note, DATE '{SECOND}', DATE '9999-12-31', true
 FROM v2 LEFT JOIN v1 ON v1.id = v2.id AND v1.nation = v2.nation
 WHERE v1.id IS NULL OR v2.segment IS DISTINCT FROM v1.segment OR v2.note IS DISTINCT FROM v1.note)"""


@query("scd2_two_loads", f"WITH {MERGED_SQL} SELECT * FROM h")
def scd2_two_loads(t: Tables):
    """History after two loads: unchanged, changed, shifted to another column, gone and
    new keys on a composite key."""
    return two_loads(t).drop("inserted_at")


@query("scd2_reload_unchanged", """
SELECT c_custkey AS id, DATE '2024-01-01' AS effective_date, true AS is_current FROM customer""")
def scd2_reload_unchanged(t: Tables):
    """L1: the same delivery twice leaves one current row per key."""
    blank = H.empty_history(t.spark, first_delivery(t).schema)
    first = H.scd2_merge(blank, first_delivery(t), ["id"], FIRST, f"{FIRST} 00:00:00")
    again = H.scd2_merge(first, first_delivery(t), ["id"], SECOND, LOADED)
    return again.select("id", "effective_date", "is_current")


@query("scd2_inserted_count", f"""
WITH {MERGED_SQL} SELECT (SELECT count(*) FROM h) - (SELECT count(*) FROM v1) AS inserted""")
def scd2_inserted_count(t: Tables):
    """L1: number of rows a load adds, counted against the state before it."""
    blank = H.empty_history(t.spark, first_delivery(t).schema)
    first = H.scd2_merge(blank, first_delivery(t), ["id", "nation"], FIRST, f"{FIRST} 00:00:00")
    second = H.scd2_merge(first, second_delivery(t), ["id", "nation"], SECOND, LOADED)
    return H.merge_counts(first, second, ["id", "nation"])


@query("scd2_views", f"""
WITH {MERGED_SQL}
SELECT 'current' AS view, id, segment FROM h WHERE is_current
UNION ALL SELECT 'before', id, segment FROM h WHERE effective_date <= DATE '2024-06-30' AND DATE '2024-06-30' < expiry_date
UNION ALL SELECT 'on', id, segment FROM h WHERE effective_date <= DATE '{SECOND}' AND DATE '{SECOND}' < expiry_date
UNION ALL SELECT 'key', id, segment FROM h WHERE id = 1""")
def scd2_views(t: Tables):
    """Current rows, rows valid on a day (both sides of a change), versions of a key."""
    table = two_loads(t)
    parts = {
        "current": H.current(table),
        "before": H.as_of(table, "2024-06-30"),
        "on": H.as_of(table, SECOND),
        "key": H.versions_of(table, id=1),
    }
    frames = [df.select(F.lit(n).alias("view"), "id", "segment") for n, df in parts.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query("append_new_rows", """
SELECT 'old' AS kind, o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) < 1998 GROUP BY 2, 3
UNION ALL SELECT 'new', o_custkey, CAST(year(o_orderdate) AS INTEGER), count(*) FROM orders o WHERE o_orderstatus <> 'P'
 AND NOT EXISTS (SELECT 1 FROM orders e WHERE year(e.o_orderdate) < 1998 AND e.o_custkey = o.o_custkey AND year(e.o_orderdate) = year(o.o_orderdate)) GROUP BY 2, 3""")
def append_new_rows(t: Tables):
    """L2: rows with a composite key the table lacks are appended, others left out."""
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    count = lambda df: df.groupBy("id", "year").agg(F.count("*").alias("n"))
    table = count(rows.filter("year < 1998"))
    incoming = count(rows.filter("o_orderstatus <> 'P'"))
    new = L.append_new(table, incoming, ["id", "year"], LOADED)
    label = lambda df, kind: df.select(F.lit(kind).alias("kind"), "id", "year", "n")
    return label(table, "old").unionByName(label(new, "new"))


@query("stored_history", f"WITH {MERGED_SQL} SELECT * FROM h")
def stored_history(t: Tables):
    """Two loads into a stored history; the second reads and writes the buckets it changes."""
    path = scratch(t, "history")
    S.load_history(t.spark, path, first_delivery(t), ["id", "nation"], FIRST, f"{FIRST} 00:00:00")
    S.load_history(t.spark, path, second_delivery(t), ["id", "nation"], SECOND, LOADED)
    return S.read_history(t.spark, path).drop("inserted_at")


@query("stored_appends", """
SELECT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN year(o_orderdate) < 1998 THEN '2024-01-01' ELSE '2024-07-02' END AS loaded,
 CASE WHEN year(o_orderdate) < 1998 THEN count(*) ELSE count(*) FILTER (WHERE o_orderstatus <> 'P') END AS n
FROM orders WHERE year(o_orderdate) < 1998 OR o_orderstatus <> 'P' GROUP BY 1, 2, 3, year(o_orderdate)""")
def stored_appends(t: Tables):
    """L2: two loads into a stored fact table; the second adds new keys only."""
    path = scratch(t, "facts")
    rows = t.orders.select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    count = lambda df: df.groupBy("id", "year").agg(F.count("*").alias("n"))
    S.load_new(t.spark, path, count(rows.filter("year < 1998")), ["id", "year"], FIRST, f"{FIRST} 00:00:00")
    S.load_new(t.spark, path, count(rows.filter("o_orderstatus <> 'P'")), ["id", "year"], SECOND, LOADED)
    return S.read_loaded(t.spark, path).withColumn("loaded", F.date_format("inserted_at", "yyyy-MM-dd")).drop("inserted_at")


# Deliveries of some years' orders, not written in the order of their stamps; one has a further column.
DELIVERED = {"19960102": 1995, "19980103": 1997, "19940105": 1993, "19970101": 1996}


def deliveries(t: Tables) -> str:
    """Stamped folders of different rows; the glob that names them all."""
    folder = scratch(t, "exports")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("year"))
    for stamp, year in DELIVERED.items():
        some = rows.filter(F.col("year") == year).drop("year")
        (some if year == 1997 else some.drop("o_orderstatus")).write.parquet(f"{folder}/orders_{stamp}")
    rows.filter("year = 1992").write.parquet(f"{folder}/other_20991231")
    return f"{folder}/orders_*"


@query("newest_by_name", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE year(o_orderdate) = 1997""")
def newest_by_name(t: Tables):
    """Of several stamped exports, the newest is found by its name and read."""
    return readers.read_parquet(t.spark, readers.newest_delivery(t.spark, deliveries(t)))


@query("all_deliveries", """
SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) = 1997 THEN o_orderstatus END AS o_orderstatus,
 CASE year(o_orderdate) WHEN 1993 THEN 'orders_19940105' WHEN 1995 THEN 'orders_19960102' WHEN 1996 THEN 'orders_19970101' ELSE 'orders_19980103' END AS delivery
FROM orders WHERE year(o_orderdate) IN (1993, 1995, 1996, 1997)""")
def all_deliveries(t: Tables):
    """All stamped exports of one pattern as one table, with the delivery each row came with."""
    return readers.read_deliveries(t.spark, deliveries(t))


@query("aggregate_export", """
SELECT o_orderstatus, CAST(count(*) AS VARCHAR) AS n FROM orders GROUP BY 1""")
def aggregate_export(t: Tables):
    """K3: a small aggregate as one delimited file, read back."""
    folder = scratch(t, "export")
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    writers.write_csv(counts, folder, ["o_orderstatus", "n"], single=True)
    return readers.read_csv(t.spark, folder, ["o_orderstatus", "n"])


@query("table_lifecycle", """
SELECT 'after append' AS step, count(*) AS n FROM supplier UNION ALL SELECT 'dropped', 1""")
def table_lifecycle(t: Tables):
    """K6: a table is started empty, filled in two appends, counted and removed."""
    path = scratch(t, "table")
    writers.create_if_missing(t.spark, path, "s_suppkey long")
    rows = t.supplier.select("s_suppkey")
    for odd in (0, 1):
        writers.append_rows(rows.filter(F.col("s_suppkey") % 2 == odd), f"{path}/rows")
    n = t.spark.read.parquet(f"{path}/rows").count()
    gone = int(writers.drop_table(t.spark, path))
    return t.spark.createDataFrame([("after append", n), ("dropped", gone)], "step string, n long")


@query("full_reload", "SELECT TIMESTAMP '2024-07-02 03:04:05' AS loaded, s_suppkey, s_name FROM supplier")
def full_reload(t: Tables):
    """L3, L4: checked for rows, then taken as the whole new content."""
    incoming = L.assert_loadable(lambda: t.supplier.select("s_suppkey", "s_name"), "supplier")
    return L.full_reload(incoming, LOADED).select(F.col("inserted_at").cast("timestamp_ntz").alias("loaded"), "s_suppkey", "s_name")


@query("registered_load", """
SELECT c_custkey AS id, c_mktsegment AS zip_code_char, true AS is_current FROM customer""")
def registered_load(t: Tables):
    """Strategy and keys of a table come from the load registry."""
    incoming = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("zip_code_char"))
    return L.load("dim_zip_codes", None, incoming, FIRST, LOADED).select("id", "zip_code_char", "is_current")


@query("registered_loads", f"""
SELECT 'dim_zip_codes' AS "table", CAST(c_custkey AS VARCHAR) AS id, CAST(NULL AS INTEGER) AS year, c_mktsegment AS value, '{FIRST}' AS since,
 CASE WHEN c_nationkey <> 3 AND c_mktsegment <> 'BUILDING' THEN '9999-12-31' ELSE '{SECOND}' END AS until FROM customer
UNION ALL SELECT 'dim_zip_codes', CAST(c_custkey AS VARCHAR), NULL, 'CONSTRUCTION', '{SECOND}', '9999-12-31' FROM customer WHERE c_nationkey <> 3 AND c_mktsegment = 'BUILDING'
UNION ALL SELECT 'dim_equipment', CAST(p_partkey AS VARCHAR), NULL, p_name, CASE WHEN p_size <= 25 THEN '{FIRST}' ELSE '2024-07-02' END, NULL FROM part
UNION ALL SELECT 'fact_population', CAST(o_custkey AS VARCHAR), CAST(year(o_orderdate) AS INTEGER), CAST(count(*) AS VARCHAR), '2024-07-02', NULL
 FROM orders WHERE year(o_orderdate) > 1993 GROUP BY 2, 3""")
def registered_loads(t: Tables):
    """Two deliveries each into a stored history, a table that grows and one that is replaced,
    all by the load registry; buckets that a delivery does not change are neither read nor written."""
    spark = t.spark
    zips = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("zip_code_char"), "c_nationkey")
    changed = F.when(F.col("zip_code_char") == "BUILDING", "CONSTRUCTION").otherwise(F.col("zip_code_char"))
    parts = t.part.select(F.col("p_partkey").alias("equipment_code"), F.col("p_name").alias("label"), "p_size")
    counts = t.orders.groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    deliveries = {
        "dim_zip_codes": (
            zips.drop("c_nationkey"),
            zips.filter("c_nationkey <> 3").withColumn("zip_code_char", changed).drop("c_nationkey"),
        ),
        "dim_equipment": (parts.filter("p_size <= 25").drop("p_size"), parts.drop("p_size")),
        "fact_population": (counts, counts.filter("year > 1993")),
    }
    read = {}
    for name, (first, second) in deliveries.items():
        path = scratch(t, name)
        S.load(spark, name, path, first, FIRST, f"{FIRST} 00:00:00")
        S.load(spark, name, path, second, SECOND, LOADED)
        read[name] = S.read(spark, name, path)
    shown = [
        read["dim_zip_codes"].select(
            F.lit("dim_zip_codes").alias("table"), F.col("id").cast("string"), F.lit(None).cast("int").alias("year"),
            F.col("zip_code_char").alias("value"), F.col("effective_date").cast("string").alias("since"),
            F.col("expiry_date").cast("string").alias("until"),
        ),
        read["dim_equipment"].select(
            F.lit("dim_equipment").alias("table"), F.col("equipment_code").cast("string").alias("id"),
            F.lit(None).cast("int").alias("year"), F.col("label").alias("value"),
            F.date_format("inserted_at", "yyyy-MM-dd").alias("since"), F.lit(None).cast("string").alias("until"),
        ),
        read["fact_population"].select(
            F.lit("fact_population").alias("table"), F.col("id").cast("string"), "year", F.col("n").cast("string").alias("value"),
            F.date_format("inserted_at", "yyyy-MM-dd").alias("since"), F.lit(None).cast("string").alias("until"),
        ),
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


# -- quality ---------------------------------------------------------------------------------

RULES = [
    Q.not_null("o_custkey"),
    Q.unique("o_orderkey"),
    Q.unique("o_custkey", "o_orderpriority", severity="warn"),
    Q.accepted_values("o_orderstatus", ["F", "O"], severity="warn"),
    Q.accepted_range("o_totalprice", 0, 400000, severity="warn"),
    Q.accepted_range("o_totalprice", low=2000, where="o_orderstatus = 'P'", severity="error"),
    Q.relationship("o_custkey", "supplier", "s_suppkey", severity="warn"),
]


@query("quality_report", """
SELECT 'not_null' AS rule, 'o_custkey' AS "column", 'error' AS severity, count(*) FILTER (WHERE o_custkey IS NULL) AS failures FROM orders
UNION ALL SELECT 'unique', 'o_orderkey', 'error', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'unique_combination', 'o_custkey,o_orderpriority', 'warn', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1)
UNION ALL SELECT 'accepted_values', 'o_orderstatus', 'warn', count(*) FROM orders WHERE o_orderstatus NOT IN ('F','O')
UNION ALL SELECT 'accepted_range', 'o_totalprice', 'warn', count(*) FROM orders WHERE o_totalprice < 0 OR o_totalprice > 400000
UNION ALL SELECT 'accepted_range', 'o_totalprice', 'error', count(*) FROM orders WHERE o_totalprice < 2000 AND o_orderstatus = 'P'
UNION ALL SELECT 'relationship', 'o_custkey', 'warn', count(*) FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def quality_report(t: Tables):
    """DQ1-DQ7: one line per rule with its failures; row rules share one scan."""
    return Q.report(t.orders, RULES, {"supplier": t.supplier})


@query("rejected_rows", """
SELECT o_orderkey, CASE WHEN o_totalprice < 2000 AND o_orderstatus = 'P' THEN 'accepted_range(o_totalprice)' ELSE '' END AS why FROM orders""")
def rejected_rows(t: Tables):
    """DQ7: rows split into passing ones and rejected ones with the rules they break."""
    clean, bad = Q.split_rejected(t.orders, RULES)
    return clean.select("o_orderkey", F.lit("").alias("why")).unionByName(
        bad.select("o_orderkey", F.array_join("rejected_by", ";").alias("why"))
    )


@query("gated_build", """
SELECT 'passed' AS outcome, count(*) AS n FROM orders WHERE o_totalprice >= 2000 OR o_orderstatus <> 'P'
UNION ALL SELECT 'refused', count(*) FROM orders WHERE o_totalprice < 2000 AND o_orderstatus = 'P' HAVING count(*) > 0""")
def gated_build(t: Tables):
    """DQ7: a table is built only if no error-level rule fails; with a broken row it is refused."""
    clean, bad = Q.split_rejected(t.orders, RULES)
    Q.gate(clean, RULES, {"supplier": t.supplier})
    outcome = clean.agg(F.lit("passed").alias("outcome"), F.count("*").alias("n"))
    try:
        Q.gate(t.orders, RULES, {"supplier": t.supplier})
    except ValueError:
        refused = bad.agg(F.lit("refused").alias("outcome"), F.count("*").alias("n"))
        outcome = outcome.unionByName(refused)
    return outcome


# -- manifests -------------------------------------------------------------------------------
# Each document stands for a delivered file; the version before differs by language.


def scan(t: Tables):
    name = F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".csv"))
    return t.documents.select(name.alias("filename"), F.md5("text").alias("md5"), F.octet_length("text").cast("bigint").alias("bytes"), "lang")


def known(t: Tables):
    """Older manifest rows: English unchanged, French changed, others never seen."""
    files = scan(t).filter(F.col("lang").isin("en", "fr"))
    changed = F.when(F.col("lang") == "fr", F.md5(F.concat("md5", F.lit("x")))).otherwise(F.col("md5"))
    newer = files.select("filename", changed.alias("md5"), F.lit("20240201T000000").alias("uploaded"))
    older = files.select("filename", F.md5("filename").alias("md5"), F.lit("20240101T000000").alias("uploaded"))
    return newer.unionByName(older)


@query("manifest_changes", """
SELECT source || '_' || doc_id || '.csv' AS filename, strlen(text) AS bytes, CAST(printf('%.2f', strlen(text) / 1048576.0::DOUBLE) AS DOUBLE) AS size_mb,
 CASE lang WHEN 'en' THEN 'unchanged' WHEN 'fr' THEN 'changed' ELSE 'new' END AS status FROM documents""")
def manifest_changes(t: Tables):
    """M1, M2, M3: content hash and size; new, changed and unchanged files against the latest
    manifest rows, which are derived from upload times."""
    latest = M.with_latest(known(t), ["filename"], ["uploaded"])
    labelled = M.classify(scan(t), latest)
    return labelled.select("filename", "bytes", round_exact(F.col("bytes") / F.lit(1048576.0), 2).alias("size_mb"), "status")


@query("manifest_latest", """
WITH f AS (SELECT source || '_' || doc_id || '.csv' AS filename FROM documents WHERE lang IN ('en', 'fr'))
SELECT filename, '20240201T000000' AS uploaded, true AS is_latest FROM f UNION ALL SELECT filename, '20240101T000000', false FROM f""")
def manifest_latest(t: Tables):
    """Latest flag of an append-only manifest."""
    return M.with_latest(known(t), ["filename"], ["uploaded"]).select("filename", "uploaded", "is_latest")


@query("newest_versions", """
SELECT source AS base, max(source || '_' || lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS newest, count(*) - 1 AS archived FROM documents GROUP BY 1""")
def newest_versions(t: Tables):
    """Newest version of each base name, and how many older ones are to be archived."""
    stamp = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    files = t.documents.select(F.concat("source", F.lit("_"), stamp).alias("filename"))
    base, version = F.split_part("filename", F.lit("_"), F.lit(1)), F.split_part("filename", F.lit("_"), F.lit(2))
    newest = M.latest_files(files, base, version).select(base.alias("base"), F.col("filename").alias("newest"))
    counts = files.groupBy(base.alias("base")).agg((F.count("*") - 1).alias("archived"))
    return newest.join(counts, "base")


@query("archived_versions", """
SELECT filename FROM (SELECT source || '_' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS filename, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS r FROM documents) WHERE r > 2""")
def archived_versions(t: Tables):
    """M7: all but the two newest versions of each base name go to the archive."""
    stamp = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    files = t.documents.select(F.concat("source", F.lit("_"), stamp).alias("filename"))
    base, version = F.split_part("filename", F.lit("_"), F.lit(1)), F.split_part("filename", F.lit("_"), F.lit(2))
    return M.archive_list(files, base, version, keep=2)


@query("run_ledger", """
WITH r AS (SELECT user_id AS run_id, event_type AS domain, min(ts) AS started_at, max(ts) AS ended_at,
  arg_max(CASE WHEN value > 10 THEN 'SUCCESS' ELSE 'FAILED' END, ts) AS status, count(*) AS files FROM events GROUP BY 1, 2),
l AS (SELECT domain, arg_max(run_id, (ended_at, run_id)) AS run_id FROM r WHERE status = 'SUCCESS' GROUP BY 1)
SELECT r.domain, r.run_id, r.status, r.files, l.run_id IS NOT NULL AS is_last_success FROM r LEFT JOIN l ON r.domain = l.domain AND r.run_id = l.run_id""")
def run_ledger(t: Tables):
    """M4: state of each run from its events, and the last successful run per domain."""
    status = F.when(F.col("value") > 10, "SUCCESS").otherwise("FAILED")
    events = t.events.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("domain"), F.col("ts").alias("at"), status.alias("status"), F.lit(1).alias("files"))
    runs = M.run_states(events)
    last = M.latest_success(runs).select("domain", "run_id", F.lit(True).alias("_last"))
    return runs.join(last, ["domain", "run_id"], "left").select(
        "domain", "run_id", "status", "files", F.coalesce("_last", F.lit(False)).alias("is_last_success")
    )


@query("missing_inputs", """
WITH e AS (SELECT DISTINCT source, CASE WHEN source LIKE 'src1%' THEN 60 ELSE 40 END AS minimum FROM documents UNION ALL SELECT 'ghost', 1),
l AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), m AS (SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY 1)
SELECT e.source, CAST(minimum AS INTEGER) AS minimum, coalesce(l.n, 0) AS listed, coalesce(m.n, 0) AS recorded FROM e LEFT JOIN l USING (source) LEFT JOIN m USING (source)
WHERE coalesce(l.n, 0) < minimum OR coalesce(m.n, 0) < minimum""")
def missing_inputs(t: Tables):
    """M5: sources with too few files in the listing or in the manifest."""
    rows = t.documents.select("source", "lang")
    wanted = rows.select("source").distinct().select("source", F.when(F.col("source").like("src1%"), 60).otherwise(40).alias("minimum"))
    ghost = t.spark.createDataFrame([("ghost", 1)], "source string, minimum int")
    return M.missing_inputs(wanted.unionByName(ghost), rows, rows.filter("lang = 'en'"))


@query("skip_unchanged", """
WITH now AS (SELECT md5(text) AS h FROM documents), fewer AS (SELECT md5(text) AS h FROM documents WHERE lang <> 'en'), changed AS (SELECT md5(h) AS h FROM now)
SELECT 'same' AS probe, NOT EXISTS (SELECT h FROM now EXCEPT SELECT h FROM now) AS skip
UNION ALL SELECT 'fewer', NOT EXISTS (SELECT h FROM now EXCEPT SELECT h FROM fewer) UNION ALL SELECT 'changed', NOT EXISTS (SELECT h FROM now EXCEPT SELECT h FROM changed)""")
def skip_unchanged(t: Tables):
    """M6: a run is skipped only if its input hashes equal those of the last run."""
    now = scan(t)
    probes = {"same": now, "fewer": now.filter("lang <> 'en'"), "changed": now.select(F.md5("md5").alias("md5"))}
    out = None
    for name, last in probes.items():
        row = M.unchanged_since(now, last).select(F.lit(name).alias("probe"), "skip")
        out = row if out is None else out.unionByName(row)
    return out


@query("routed_files", """
SELECT target, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(f, '^src1[0-9]_') THEN 'teens' WHEN regexp_matches(f, '^src[0-9]_') THEN 'ones' END AS target
 FROM (SELECT source || '_' || doc_id AS f FROM documents)) WHERE target IS NOT NULL GROUP BY 1
UNION ALL SELECT 'unmatched ^zip', 0""")
def routed_files(t: Tables):
    """M8: files routed by name pattern; patterns without a file are reported."""
    files = t.documents.select(F.concat_ws("_", "source", "doc_id").alias("filename"))
    patterns = {"^src1[0-9]_": "teens", "^src[0-9]_": "ones", "^zip": "zips"}
    routed = M.route(files, patterns).groupBy("target").agg(F.count("*").alias("n"))
    lost = M.unmatched_patterns(files, patterns)
    return routed.unionByName(lost.select(F.concat(F.lit("unmatched "), "pattern").alias("target"), F.lit(0).cast("bigint").alias("n")))


@query("provenance_sidecars", """
SELECT source || '_' || doc_id || '.csv.meta.json' AS key, '{"filename":"' || source || '_' || doc_id || '.csv","md5":"' || md5(text) || '","license":"open","language":"' || lang || '"}' AS json FROM documents""")
def provenance_sidecars(t: Tables):
    """M9: provenance of each file as JSON next to it."""
    return M.sidecar(scan(t), license=F.lit("open"), language=F.col("lang"))


@query("main_data_files", """
SELECT source AS delivery, arg_max(filename, (bytes, filename)) AS filename, max(bytes) AS bytes FROM (
 SELECT source, strlen(text) AS bytes, CASE lang WHEN 'en' THEN 'data_' WHEN 'fr' THEN 'Note_' ELSE 'x_' END || doc_id || CASE WHEN lang = 'de' THEN '.pdf' ELSE '.CSV' END AS filename FROM documents)
WHERE NOT (lower(filename) LIKE 'note%') AND lower(filename) LIKE '%.csv' GROUP BY 1""")
def main_data_files(t: Tables):
    """The largest table file of each delivery that is not documentation."""
    head = F.when(F.col("lang") == "en", "data_").when(F.col("lang") == "fr", "Note_").otherwise("x_")
    tail = F.when(F.col("lang") == "de", ".pdf").otherwise(".CSV")
    files = t.documents.select(F.col("source").alias("delivery"), F.concat(head, F.col("doc_id").cast("string"), tail).alias("filename"), F.octet_length("text").cast("bigint").alias("bytes"))
    return M.main_file(files, "delivery")


@query("file_hashes", """
SELECT source, part, length(body) AS bytes, md5(body) AS md5 FROM (SELECT source, doc_id // 500 AS part, string_agg(doc_id, chr(10) ORDER BY doc_id) || chr(10) AS body FROM documents GROUP BY 1, 2)""")
def file_hashes(t: Tables):
    """M1: files listed and hashed; the ids of a source's documents, five hundred ids' range to a file."""
    folder = scratch(t, "files")
    part = F.floor(F.col("doc_id") / 500).cast("bigint").alias("part")
    ids = t.documents.select("source", part, "doc_id").repartition(shuffle_partitions(t.spark), "source", "part").sortWithinPartitions("source", "part", "doc_id")
    ids.select("source", "part", F.col("doc_id").cast("string")).write.partitionBy("source", "part").text(folder)
    files = M.hash_files(t.spark, f"{folder}/source=*/part=*", "part-*")
    found = lambda name: F.regexp_extract("path", f"{name}=([^/]+)/", 1)
    return files.select(found("source").alias("source"), found("part").cast("bigint").alias("part"), "bytes", "md5")


# -- provenance ------------------------------------------------------------------------------

LINKS_SQL = """s AS (SELECT n_nationkey AS source_id, n_name AS source_name, 'org' || n_regionkey AS organization FROM nation),
l AS (SELECT 'fact' AS target_table, o_custkey || '|' || y AS target_key, source_id FROM (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders), s WHERE source_name IN ('NATION_1', 'NATION_2')
 UNION ALL SELECT 'dim', CAST(c_custkey AS VARCHAR), source_id FROM customer JOIN (VALUES ('BUILDING','NATION_4'),('MACHINERY','NATION_5')) m(seg, src) ON c_mktsegment = seg JOIN s ON source_name = src)"""


def link_parts(t: Tables):
    sources = t.nation.select(F.col("n_nationkey").alias("source_id"), F.col("n_name").alias("source_name"), F.concat(F.lit("org"), F.col("n_regionkey").cast("string")).alias("organization"))
    panel = t.orders.select("o_custkey", F.year("o_orderdate").alias("y")).distinct()
    facts = P.links(panel, "fact", F.concat_ws("|", "o_custkey", "y"), sources, ["NATION_1", "NATION_2"])
    dims = P.mapped_links(t.customer, "dim", F.col("c_custkey"), "c_mktsegment", {"BUILDING": "NATION_4", "MACHINERY": "NATION_5"}, sources)
    return sources, [facts, dims]


@query("provenance_bridge", f"""
WITH {LINKS_SQL} SELECT row_number() OVER (ORDER BY target_table, target_key, source_id) AS source_link_id, target_table, target_key, source_id FROM l""")
def provenance_bridge(t: Tables):
    """Row-level source links of two tables with an id unique over all of them."""
    return P.bridge(link_parts(t)[1])


@query("provenance_reports", f"""
WITH {LINKS_SQL} SELECT target_table, string_agg(DISTINCT source_name, ', ' ORDER BY source_name) AS sources, count(*) AS n_links FROM l JOIN s USING (source_id) GROUP BY 1""")
def provenance_reports(t: Tables):
    """Sources of each table as one sorted text."""
    sources, (facts, dims) = link_parts(t)
    return P.sources_per_table(facts.unionByName(dims), sources)


@query("rows_with_sources", f"""
WITH {LINKS_SQL} SELECT c_custkey, source_name, organization FROM customer JOIN l ON target_table = 'dim' AND target_key = CAST(c_custkey AS VARCHAR) JOIN s USING (source_id)""")
def rows_with_sources(t: Tables):
    """Rows of a table with the sources they come from, by composite text key."""
    sources, (_, dims) = link_parts(t)
    return P.rows_from(t.customer.select("c_custkey"), F.col("c_custkey"), "dim", dims, sources)


@query("source_catalogue", """
SELECT CAST(source_id AS INTEGER) AS source_id, source_name, n_rows FROM (VALUES (1, 'register'), (2, 'survey'), (10, 'census')) s(source_id, source_name) LEFT JOIN
 (SELECT sid, count(*) AS n_rows FROM customer JOIN (VALUES ('BUILDING', 1), ('BUILDING', 10), ('MACHINERY', 1)) l(seg, sid) ON seg = c_mktsegment GROUP BY 1) ON sid = source_id""")
def source_catalogue(t: Tables):
    """Sources from configuration lists, the models they feed, and the rows behind each."""
    groups = {
        "downloads": [{"source_id": 10, "source_name": "census"}, {"source_id": 2, "source_name": "survey"}],
        "files": [{"source_id": 1, "source_name": "register"}, {"source_name": "draft"}],
    }
    sources = catalog.source_table(t.spark, groups)
    links = catalog.model_sources(t.spark, {"BUILDING": [1, 10], "MACHINERY": [1]})
    rows = t.customer.groupBy(F.col("c_mktsegment").alias("model_name")).agg(F.count("*").alias("n"))
    counts = rows.join(links, "model_name").groupBy("source_id").agg(F.sum("n").alias("n_rows"))
    return sources.join(counts, "source_id", "left").select("source_id", "source_name", "n_rows")


# -- files -----------------------------------------------------------------------------------


@query("csv_round_trip", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS code, c_name AS name, c_acctbal AS balance FROM customer""")
def csv_round_trip(t: Tables):
    """Delimited text with header and fixed column order, read as text and then cast."""
    folder = scratch(t, "csv")
    rows = t.customer.select(F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("code"), F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"))
    writers.write_csv(rows, folder, ["code", "name", "balance"])
    back = readers.read_csv(t.spark, folder, ["code", "name", "balance"])
    return back.select("code", "name", F.col("balance").cast("double").alias("balance"))


@query("preamble_scan", """
SELECT CAST(s_suppkey AS VARCHAR) AS "CODGEO", s_name AS "LIBGEO" FROM supplier""")
def preamble_scan(t: Tables):
    """Tables whose header stands below title lines, in every file of a folder; the files
    have their columns in different orders."""
    folder = scratch(t, "preamble")
    turned = F.col("part") % 2 == 1
    head = F.when(turned, F.lit("LIBGEO;CODGEO")).otherwise(F.lit("CODGEO;LIBGEO"))
    title = F.array(F.lit("Report;"), F.lit(""), head)
    code, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    line = F.when(F.col("s_nationkey") % 2 == 1, F.concat_ws(";", name, code)).otherwise(F.concat_ws(";", code, name))
    # One file per group of suppliers, each with its own title lines.
    rows = t.supplier.select(F.col("s_nationkey").alias("part"), F.lit(1).alias("o"), line.alias("value"))
    heads = rows.select("part").distinct().select("part", F.lit(0).alias("o"), F.posexplode(title).alias("p", "value"))
    stacked = rows.withColumn("p", F.lit(0)).unionByName(heads)
    ordered = stacked.repartition(4, "part").sortWithinPartitions("part", "o", "p")
    ordered.select("part", "value").write.partitionBy("part").text(folder)
    return readers.read_after_preamble(t.spark, f"{folder}/part=*", 2, sep=";").select("CODGEO", "LIBGEO")


@query("versioned_table", """
SELECT 1 AS version, c_name FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT 2, c_name FROM customer""")
def versioned_table(t: Tables):
    """Table versions written one after the other and read by number or newest."""
    path = scratch(t, "versions")
    writers.write_table(t.customer.filter("c_mktsegment = 'BUILDING'"), path)
    writers.write_table(t.customer, path)
    one = readers.read_table(t.spark, path, 1).select(F.lit(1).alias("version"), "c_name")
    return one.unionByName(readers.read_table(t.spark, path).select(F.lit(2).alias("version"), "c_name"))


@query("layered_views", """
SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 1000 GROUP BY 1""")
def layered_views(t: Tables):
    """Lazy views per layer, queried by SQL text with bound parameters."""
    catalog.register_layer(t.spark, "silver", {"customer": t.customer})
    return readers.query(t.spark, "SELECT c_mktsegment, count(*) AS n FROM silver_customer WHERE c_acctbal > ? GROUP BY 1", [1000])


@query("geojson_points", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_custkey % 360 - 180 AS DOUBLE) AS x, CAST(c_nationkey AS DOUBLE) AS y, 'false' AS visited FROM customer""")
def geojson_points(t: Tables):
    """S3, K5: points with collection columns as GeoJSON lines, read back."""
    folder = scratch(t, "geojson")
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"), F.col("c_nationkey").cast("double").alias("lat"))
    writers.write_points(writers.collection_columns(rows), folder, "lon", "lat")
    back = readers.read_geojson(t.spark, folder, ["id", "name", "visited", "photo"])
    return back.select("id", "name", "x", "y", "visited")


@query("geojson_polygons", """
SELECT CAST(s_suppkey AS VARCHAR) AS code, CAST(s_nationkey AS VARCHAR) AS kind, CASE WHEN s_nationkey > 10 THEN 2 ELSE 1 END AS parts,
  CASE WHEN s_nationkey > 10 THEN 5.0 ELSE 4.0 END::DOUBLE AS area FROM supplier""")
def geojson_polygons(t: Tables):
    """S3: Polygon and MultiPolygon features to one geometry type."""
    from cadastra.functions import geo

    square = "[[[0,0],[2,0],[2,2],[0,2],[0,0]]]"
    second = "[[[5,5],[6,5],[6,6],[5,6],[5,5]]]"
    many = F.col("s_nationkey") > 10
    shape = F.when(many, f'{{"type":"MultiPolygon","coordinates":[{square},{second}]}}').otherwise(f'{{"type":"Polygon","coordinates":{square}}}')
    props = F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("code"), F.col("s_nationkey").alias("kind")))
    text = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), shape, F.lit("}"))
    parsed = readers.features(t.supplier.select(text.alias("f")), "f", ["code", "kind"])
    return parsed.select("code", "kind", geo.parts(F.col("geometry")).alias("parts"), geo.area(F.col("geometry")).alias("area"))
