"""Operators on small hand-made tables."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from cadastra.functions import columns as C
from cadastra.functions import dates as D
from cadastra.operators import aggregates as A
from cadastra.operators import history as H
from cadastra.operators import joins as J
from cadastra.operators import loads as L
from cadastra.operators import manifest as M
from cadastra.operators import quality as Q
from cadastra.plans import calendar as CAL
from cadastra.plans import constants as K
from cadastra.plans import demography as DEM
from cadastra.plans import names as N


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# -- columns ---------------------------------------------------------------------------------


def test_crosswalk(spark):
    codes = ["75101", "69381", "13201", "2A004", "97501", "75056", "751011"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = {r["c"]: r["m"] for r in df.select("c", C.crosswalk(F.col("c"), K.CITY_CODES).alias("m")).collect()}
    assert got["75101"] == "75056" and got["69381"] == "69123" and got["13201"] == "13055"
    assert all(got[c] == c for c in ["2A004", "97501", "75056", "751011"])


def test_number_parsing(spark):
    cases = {"1,5": 1.5, ' "12.25" ': 12.25, "": None, "n.d.": None, None: None, "s": None, "7": 7.0, "-3,0": -3.0}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r["c"]: r["n"] for r in df.select("c", C.number(F.col("c")).alias("n")).collect()} == cases


def test_prefixed_needs_a_hit(spark):
    df = spark.createDataFrame([("01001", 1, 2)], "CODGEO string, P17_ACT int, P16_ACT int")
    row = C.prefixed(df, "CODGEO", "P17_", year=2017)
    assert row.columns == ["CODGEO", "ACT", "year"] and row.first()[1] == 1
    with pytest.raises(ValueError):
        C.prefixed(df, "CODGEO", "P09_", year=2009)


def test_text_forms(spark):
    got = one(
        spark,
        C.trend_text(F.lit(1234.5), 0, "", thousands=True).alias("up"), C.trend_text(F.lit(-1.26), 1, "%").alias("down"),
        C.trend_text(F.lit(0.0), 1).alias("flat"), C.trend_text(F.lit(None).cast("double")).alias("none"),
        C.slug(F.lit("L'Haÿ-les Roses/Sud")).alias("slug"), C.zfill(F.lit("123"), 2).alias("z3"), C.zfill(F.lit("2A"), 3).alias("z2a"),
        C.zfill(F.lit("1"), 2).alias("z1"), C.rebase_path(F.lit("DCIM/a.jpg"), "DCIM/", "b/").alias("path"),
    )
    assert got["up"] == "▲ +1,234" and got["down"] == "▼ -1.3%" and got["flat"] == "▬ +0.0" and got["none"] == "—"
    assert (got["slug"], got["z3"], got["z2a"], got["z1"], got["path"]) == ("lhaÿ_les_roses_sud", "123", "2A", "01", "b/a.jpg")


def test_numbers_print_as_in_python(spark):
    values = [11.25, 0.15, 1.15, 0.25, 0.35, 2.675, -0.04, -1.25, -0.15, 1234.5, 1e6 + 0.05, 3.0, -7.349999, 99.95, 0.05, 1 / 3]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", C.signed_text(F.col("v"), 1).alias("a"), C.signed_text(F.col("v"), 0, thousands=True).alias("b"), C.ratio_text(F.col("v"), 2).alias("c")
    )
    for r in rows.collect():
        assert (r["a"], r["b"], r["c"]) == (f"{r['v']:+.1f}", f"{r['v']:+,.0f}", f"{r['v']:.2f}")


def test_integer_text_rounds(spark):
    df = spark.createDataFrame([("12.6",), ("3",), ("2.5",)], "v string")
    assert [r[0] for r in C.enforce(df, [("v", "v", "int")]).collect()] == [13, 3, 3]


# -- dates -----------------------------------------------------------------------------------


def easter_of(year):
    a, b, c = year % 19, year // 100, year % 100
    d, e, f = b // 4, b % 4, (b + 8) // 25
    g = (b - f + 1) // 3
    h = (19 * a + b - d - g + 15) % 30
    i, k = c // 4, c % 4
    l = (32 + 2 * e + 2 * i - h - k) % 7  # noqa: E741
    m = (a + 11 * h + 22 * l) // 451
    return date(year, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1)


def test_easter_for_two_centuries(spark):
    rows = spark.range(1583, 2301).select(F.col("id").cast("int").alias("y")).select("y", D.easter(F.col("y")).alias("e")).collect()
    assert all(r["e"] == easter_of(r["y"]) for r in rows)


def test_feasts(spark):
    days = {r["date"] for r in CAL.christian_holidays(spark.createDataFrame([(2024,)], "year int")).collect()}
    sunday = date(2024, 3, 31)
    assert {sunday - timedelta(46), sunday, sunday + timedelta(39), date(2024, 12, 25)} <= days
    assert len(days) == 30 - 0 or len(days) == 29


def test_moon(spark):
    got = one(spark, D.moon_phase_name(F.lit(0.99)).alias("a"), D.moon_phase_name(F.lit(27.0)).alias("b"), D.moon_illumination(F.lit(7.0)).alias("c"),
              D.lunation(F.lit("1923-01-17").cast("date")).alias("d"), D.lunation(F.lit("1923-01-10").cast("date")).alias("e"))
    assert tuple(got) == ("New Moon", "New Moon", 0.5, 1, 1)


def test_full_calendar(spark):
    df = CAL.calendar_parts(CAL.days(spark))
    assert df.count() == 73414
    assert df.filter("date = date'2021-01-03'").first()["iso_week"] == 53


def test_slashed_dates(spark):
    df = spark.createDataFrame([("1920/01/02",), ("1990/5/6",), ("bad",), (None,)], "t string")
    assert [r[0] for r in df.select(D.slashed_date(F.col("t"))).collect()] == [date(1920, 1, 2), date(1990, 5, 6), None, None]


def test_timelines(spark):
    nested = spark.sql("""SELECT map('presidents', array(
        named_struct('name', 'A', 'start', '1959-01-08', 'end', '1969-04-28'), named_struct('name', 'B', 'start', '1969-04-28', 'end', NULL),
        named_struct('name', '', 'start', '1969-04-28', 'end', NULL), named_struct('name', 'C', 'start', NULL, 'end', NULL),
        named_struct('name', 'D', 'start', '1969-13-28', 'end', NULL)), 'nobody', NULL) AS timelines""")
    assert [(r["name"], r["end_date"]) for r in CAL.timelines(nested).orderBy("name").collect()] == [("A", date(1969, 4, 28)), ("B", None)]
    assert {r["problem"] for r in CAL.timeline_violations(nested).collect()} == {"name missing", "start missing", "start not ISO"}


# -- joins and aggregates ----------------------------------------------------------------------


def test_prior_period_with_gap_and_zero(spark):
    df = spark.createDataFrame([("x", 2015, 10), ("x", 2017, 0), ("x", 2018, 5), ("y", 2018, 1)], "id string, year int, v int")
    paired = J.prior_period(df, ["id"], "year", ["v"]).withColumn("pct", C.ratio(F.col("v") - F.col("prev_v"), F.col("prev_v"), 100))
    got = {(r["id"], r["year"]): (r["prev_v"], r["pct"]) for r in paired.collect()}
    assert got == {("x", 2015): (None, None), ("x", 2017): (None, None), ("x", 2018): (0, None), ("y", 2018): (None, None)}


def test_conditional_sums_are_null_without_rows(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 6), ("b", 2, 7)], "k string, c int, v int")
    wide = A.pivot_when(df, ["k"], {"one": (F.col("c") == 1, F.col("v")), "two": (F.col("c") == 2, F.col("v"))}, how="sum")
    assert {r["k"]: (r["one"], r["two"]) for r in wide.collect()} == {"a": (5, 6), "b": (None, 7)}


def test_not_in(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "v int")
    assert [r[0] for r in J.not_in(left, "k", right, "v").collect()] == [2]
    assert J.not_in(left, "k", right, "v", null_aware=True).collect() == []
    empty = right.filter("v = 99")
    assert sorted(r[0] for r in J.not_in(left, "k", empty, "v", null_aware=True).collect()) == [1, 2]


def test_median_of_even_count(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), ("b", 2.0), ("b", 9.0), ("c", None)], "k string, v double")
    assert {r["k"]: r["m"] for r in A.exact_median(df, ["k"], "v", "m").collect()} == {"a": 2.5, "b": 2.0}


def test_name_helpers(spark):
    df = spark.createDataFrame([("Saint-Jean-de-Luz",), ("Saint Jean",), ("Aix-en-Provence",), ("Y",), ("L'Haÿ-les-Roses",)], "name string")
    assert N.patron_saints(df).first()["saint_name"] == "Jean"
    words = {r["word"]: r["n"] for r in N.common_words(df, None).collect()}
    assert words["Saint"] == 2 and "En" not in words and "Les" not in words
    assert {r["qualifier"]: r["n"] for r in N.qualifiers(df).collect()}["en"] == 1
    assert "B" in {r["letter"] for r in N.missing_letters(df).collect()}
    stats = N.length_stats(df).first()
    assert (stats["min_len"], stats["max_len"], stats["med_len"]) == (1, 17, 15)


# -- history -----------------------------------------------------------------------------------

DAYS = ("2024-01-01", "2024-06-01")


def load_twice(spark, schema, keys, first, second):
    frames = [spark.createDataFrame(rows, schema) for rows in (first, second)]
    table = H.empty_history(spark, frames[0].schema)
    for frame, day in zip(frames, DAYS):
        table = H.scd2_merge(table, frame, keys, day, f"{day} 10:00:00")
    return table


def test_history_new_and_duplicate(spark):
    table = load_twice(spark, "name string, dept string", ["name", "dept"], [("x", "99")], [("x", "99")])
    rows = table.collect()
    assert len(rows) == 1 and rows[0]["is_current"] and rows[0]["expiry_date"] == date(9999, 12, 31)


def test_history_changed(spark):
    table = load_twice(spark, "name string, dept string, population string", ["name", "dept"], [("z", "20", "700")], [("z", "20", "999")])
    got = {r["population"]: (r["is_current"], r["effective_date"], r["expiry_date"]) for r in table.collect()}
    assert got == {"700": (False, date(2024, 1, 1), date(2024, 6, 1)), "999": (True, date(2024, 6, 1), date(9999, 12, 31))}


def test_history_removed(spark):
    table = load_twice(spark, "name string", ["name"], [("a",), ("b",)], [("a",)])
    assert {r["name"]: r["is_current"] for r in table.collect()} == {"a": True, "b": False}


def test_history_composite_key_and_null_shift(spark):
    table = load_twice(
        spark, "a string, b string, v string, w string", ["a", "b"],
        [("a1", "b1", None, "x"), ("a1", "b2", "k", None), ("a2", "b1", "k", "k")],
        [("a1", "b2", None, "k"), ("a2", "b1", "k", "k")],
    )
    state = sorted((r["a"], r["b"], r["v"], r["is_current"]) for r in table.fillna("-").collect())
    assert state == [("a1", "b1", "-", False), ("a1", "b2", "-", True), ("a1", "b2", "k", False), ("a2", "b1", "k", True)]


def test_history_refuses_bad_keys(spark):
    with pytest.raises(ValueError, match="duplicate"):
        H.check_keys(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"])
    with pytest.raises(ValueError, match="NULL"):
        H.check_keys(spark.createDataFrame([("a",), (None,)], "k string"), ["k"])


def test_append(spark):
    table = spark.createDataFrame([("c01", "5000")], "id string, p string")
    new = L.append_new(table, spark.createDataFrame([("c01", "1"), ("c02", "3000")], "id string, p string"), ["id"], "2024-01-01 00:00:00")
    assert [r["id"] for r in new.collect()] == ["c02"] and new.columns[0] == "inserted_at"
    assert L.append_new(table, table.limit(0), ["id"], "2024-01-01 00:00:00").isEmpty()


def test_loadable(spark):
    assert L.assert_loadable(lambda: spark.range(1), "t").count() == 1
    for read in (lambda: spark.range(0), lambda: spark.read.parquet("/nowhere")):
        with pytest.raises(ValueError):
            L.assert_loadable(read, "t")


def test_registered_loads(spark):
    rows = spark.createDataFrame([("75001", "x")], "id string, v string")
    first = L.load("dim_communes", None, rows, *["2024-01-01", "2024-01-01 00:00:00"])
    again = L.load("dim_communes", first, rows, "2024-02-01", "2024-02-01 00:00:00")
    assert again.count() == 1
    facts = L.load("fact_income", None, spark.createDataFrame([("1", 2020)], "id string, year int"), "2024-01-01", "2024-01-01 00:00:00")
    assert facts.columns == ["inserted_at", "id", "year"]


# -- quality and manifests -----------------------------------------------------------------------


def test_gate(spark):
    df = spark.createDataFrame([("a", 1), ("a", 200), (None, 3)], "k string, v int")
    rules = [Q.not_null("k"), Q.unique("k", severity="warn"), Q.accepted_range("v", 0, 100, severity="warn"), Q.relationship("k", "p", "id", severity="warn")]
    parents = {"p": spark.createDataFrame([("b",)], "id string")}
    got = {r["rule"]: r["failures"] for r in Q.report(df, rules, parents).collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_range": 1, "relationship": 2}
    with pytest.raises(ValueError, match="not_null"):
        Q.gate(df, rules, parents)
    assert Q.gate(df, rules[1:], parents).count() == 3
    clean, bad = Q.split_rejected(df, rules)
    assert (clean.count(), bad.first()["rejected_by"]) == (2, ["not_null(k)"])


def test_file_hashes(spark, tmp_path):
    import hashlib

    (tmp_path / "a_20240101T000000.csv").write_bytes(b"1")
    (tmp_path / "a_20240301T000000.csv").write_bytes(b"22")
    files = M.hash_files(spark, str(tmp_path), "*.csv")
    got = {r["filename"]: (r["bytes"], r["md5"]) for r in files.collect()}
    assert got["a_20240301T000000.csv"] == (2, hashlib.md5(b"22").hexdigest())
    newest = M.latest_files(files, F.regexp_extract("filename", r"^(.*)_\d{8}T", 1), D.stamp_of(F.col("filename")))
    assert [r["filename"] for r in newest.collect()] == ["a_20240301T000000.csv"]
    old = M.archive_list(files, F.regexp_extract("filename", r"^(.*)_\d{8}T", 1), D.stamp_of(F.col("filename")))
    assert [r["filename"] for r in old.collect()] == ["a_20240101T000000.csv"]


# -- demography --------------------------------------------------------------------------------


def test_income_mappings():
    assert DEM.income_mapping(2013)["salary_share"] == "PTSAC13" and "unemployment_share" not in DEM.income_mapping(2013)
    assert DEM.income_mapping(2014)["median_income"] == "MED14" and "gini" not in DEM.income_mapping(2014)
    assert DEM.income_mapping(2018)["s80_s20"] == "S80S2018"
    assert "tax_share" not in DEM.income_mapping(2021) and DEM.income_mapping(2021)["activity_income_share"] == "PACT21"


def test_population_change(spark):
    obs = "GEO string, GEO_OBJECT string, TIME_PERIOD string, OBS_VALUE string"
    pop = spark.createDataFrame([("c", "COM", "2015", "100"), ("c", "COM", "2016", "110"), ("c", "COM", "2018", "50"), ("c", "DEP", "2015", "9")], obs)
    over = spark.createDataFrame([("c", "2016", "120")], "commune_id string, year string, population string")
    births = spark.createDataFrame([("c", "COM", "2017", "3", "LVB"), ("c", "COM", "2017", "9", "X")], obs + ", EC_MEASURE string")
    deaths = spark.createDataFrame([("c", "COM", "2017", "1", "DTH", "A"), ("c", "COM", "2016", "1", "DTH", "P")], obs + ", EC_MEASURE string, OBS_STATUS string")
    family = spark.createDataFrame([("c", "COM", "2015", "8", "CH0_Y_LT25", "_T"), ("c", "COM", "2015", "9", "_T", "11")], obs + ", NCH string, TFN string")
    migr = spark.createDataFrame([("c", "COM", "1", "1", "2.5"), ("c", "COM", "2", "1", "4")], "CODGEO string, NIVGEO string, IMMI string, SEXE string, NB string")
    rows = {r["year"]: r for r in DEM.fact_population(pop, over, births, deaths, family, migr).collect()}
    assert sorted(rows) == [2015, 2016, 2017, 2018, 2022]
    assert (rows[2016]["population"], rows[2016]["year_evolution"], rows[2016]["year_evolution_percent"]) == (120, 20, 20.0)
    assert rows[2017]["population"] is None and rows[2017]["year_evolution"] is None and rows[2017]["birth_death_diff"] == 2
    assert rows[2018]["year_evolution"] is None
    assert (rows[2015]["no_children_u24"], rows[2015]["number_single_father_families"], rows[2015]["one_child_u24"]) == (8, 9, None)
    assert (rows[2022]["number_migrant"], rows[2022]["number_male"], rows[2022]["number_female"], rows[2022]["number_total"]) == (2.5, 6.5, None, 6.5)
