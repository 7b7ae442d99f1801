"""Work on small files and on stacked sources is dealt to tasks: rows of one file, results as before."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.functions import html as X
from cadastra.operators import aggregates as A
from cadastra.operators import extraction as E
from cadastra.operators import manifest as M
from cadastra.operators import spatial
from cadastra.plans import demography as DEM
from cadastra.queries import QUERIES


def tasks_of(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_pages_of_one_file_are_taken_apart_in_several_tasks(spark, tmp_path):
    row = F.concat(F.lit("<tr><td>-</td><td>T"), F.col("id").cast("string"), F.lit("</td><td></td><td></td><td>7</td></tr>"))
    html = F.concat(F.lit("<table class='ea-advanced-data-table'><tbody>"), row, F.lit("</tbody></table>"))
    spark.range(200).select(F.col("id").alias("page_id"), html.alias("html")).coalesce(1).write.parquet(str(tmp_path / "pages"))
    towns = E.labelled_towns(spark.read.parquet(str(tmp_path / "pages")))
    assert tasks_of(towns) == 4
    assert sorted(map(tuple, towns.collect())) == sorted((i, f"t{i}", "07") for i in range(200))


def test_texts_without_references_are_left_as_they_are(spark):
    texts = [("plain; #65; text",), (None,), ("",), ("a & b",), ("&#65;&amp;#66; &lt;",)]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").select(X.unescape(F.col("t"))).collect()]
    assert got == ["plain; #65; text", None, "", "a & b", "A&#66; <"]


def test_sources_of_the_population_are_dealt_each(spark):
    obs = "GEO string, GEO_OBJECT string, TIME_PERIOD string, OBS_VALUE string"
    census = spark.createDataFrame([("c", "COM", "2015", "100"), ("c", "COM", "2015", "100"), (None, "COM", "2016", "7")], obs)
    over = spark.createDataFrame([("c", "2016", "120")], "commune_id string, year string, population string")
    births = spark.createDataFrame([("c", "COM", "2016", "3", "LVB")], obs + ", EC_MEASURE string")
    deaths = spark.createDataFrame([("c", "COM", "2016", "1", "DTH", "A")], obs + ", EC_MEASURE string, OBS_STATUS string")
    family = spark.createDataFrame([("c", "COM", "2015", "8", "CH0_Y_LT25", "_T")], obs + ", NCH string, TFN string")
    migration = spark.createDataFrame([("c", "COM", "1", "1", "2")] * 2, "CODGEO string, NIVGEO string, IMMI string, SEXE string, NB string")
    facts = DEM.fact_population(census, over, births, deaths, family, migration)
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 6
    rows = {(r["id"], r["year"]): r for r in facts.collect()}
    assert set(rows) == {("c", 2015), ("c", 2016), (None, 2016), ("c", 2022)}
    assert (rows["c", 2016]["population"], rows["c", 2016]["year_evolution"], rows["c", 2016]["birth_death_diff"]) == (120, 20, 2)
    assert rows["c", 2022]["number_migrant"] == 4 and rows[None, 2016]["population"] == 7


def test_outlines_of_one_file_are_cut_in_several_tasks(spark, tmp_path, monkeypatch):
    n = F.col("id").cast("double")
    boxes = spark.range(60).select(F.col("id").alias("key"), geo.box_polygon(n, F.lit(0.0), n + 1, F.lit(1.0)).alias("geometry"))
    boxes.coalesce(1).write.parquet(str(tmp_path / "boxes"))
    seen, keep = [], spatial.pin
    monkeypatch.setattr(spatial, "pin", lambda df: (seen.append(tasks_of(df)), keep(df))[1])
    pairs = spatial.neighbours(spark.read.parquet(str(tmp_path / "boxes")), "key", "geometry")
    assert seen[0] == 4
    assert {tuple(r) for r in pairs.collect()} == {(i, j) for i in range(60) for j in (i - 1, i + 1) if 0 <= j < 60}


def test_files_to_hash_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    import hashlib

    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    rows.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    listed, real = [], M.hash_files
    monkeypatch.setattr(M, "hash_files", lambda spark, path, pattern: (listed.extend(glob.glob(f"{path.removeprefix('file:')}/{pattern}")), real(spark, path, pattern))[1])
    got = {(r["source"], r["part"]): (r["bytes"], r["md5"]) for r in QUERIES["file_hashes"](spark, str(tmp_path)).collect()}
    assert len(listed) == 24 and len({f.rsplit("/", 1)[1][:10] for f in listed}) > 1
    body = "".join(f"{i}\n" for i in range(500, 1000) if i % 3 == 1).encode()
    assert len(got) == 24 and got["s1", 1] == (len(body), hashlib.md5(body).hexdigest())


def test_traits_join_after_the_only_fold(spark):
    rows = spark.createDataFrame([(1, 10, "R"), (1, 10, "A"), (1, 11, "A"), (1, 12, None), (None, 12, "R"), (2, None, "R")], "k int, e int, f string")
    traits = spark.createDataFrame([(10, "x"), (10, "y"), (11, None), (None, "x")], "e int, kind string")
    kind = F.col("kind")
    counted = A.distinct_buckets(
        rows, ["k"], "e", {"r": F.col("f") == "R"}, "total", traits, {"x": kind == "x", "other": kind.isNull() | (kind != "x")},
    )
    assert {tuple(r) for r in counted.select("k", "total", "r", "x", "other").collect()} == {(1, 3, 1, 1, 3), (None, 1, 1, 0, 1)}


def test_pairs_are_folded_once(spark, folder):
    import re

    plan = QUERIES["distinct_buckets"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"HashAggregate\(keys=\[l_suppkey#\w+, l_partkey#\w+\]", plan)) == 2
