"""Files: catalog scans, versions, GeoJSON, preambles, arrivals."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cadastra.functions import geo
from cadastra.plans import territory as T
from cadastra.sources import catalog, readers, writers
from cadastra.streaming.arrivals import append_arrivals


def put(root, path, text, encoding="utf-8"):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(text.encode(encoding))


def test_newest_source_and_encoding(spark, tmp_path):
    put(tmp_path, "geography/zip_codes_20240101T000000.csv", "#Code_commune_INSEE;Code_postal\n99999;99999\n")
    put(tmp_path, "geography/zip_codes_20240201T000000.csv", "#Code_commune_INSEE;Code_postal;Nom\n01001;01400;Vallée\n75101;75001;Paris\n", "latin-1")
    df = catalog.read_source(spark, str(tmp_path), "zip_codes")
    rows = df.orderBy("Code_postal").collect()
    assert rows[0]["#Code_commune_INSEE"] == "01001" and rows[0]["Nom"] == "Vallée" and len(rows) == 2
    zips = T.dim_zip_codes(df).orderBy("id").collect()
    assert (zips[0]["id"], zips[0]["zip_code_char"], zips[0]["number_of_communes"]) == (1400, "01400", 1)
    communes = spark.createDataFrame([("01001",), ("75056",)], "id string")
    assert {r["commune_id"] for r in T.bridge_communes_zip_codes(df, communes).collect()} == {"01001", "75056"}
    with pytest.raises(FileNotFoundError):
        readers.newest_file(spark, str(tmp_path / "geography"), "none_*.csv")


def test_separator_is_detected(spark, tmp_path):
    put(tmp_path, "demographics/births_20240101T000000.csv", '"GEO";"OBS_VALUE"\n"01001";"5"\n')
    assert catalog.read_source(spark, str(tmp_path), "births").first()["GEO"] == "01001"


def test_all_versions(spark, tmp_path):
    from dataclasses import replace

    for stamp in ("20240101", "20240201"):
        put(tmp_path, f"geography/altitude_{stamp}T000000.csv", "commune_id,altitude_min\n01001,3\n")
    specs = {"altitude": replace(catalog.SOURCES["altitude"], all_versions=True, sep=",")}
    assert catalog.read_source(spark, str(tmp_path), "altitude", specs).count() == 2
    assert catalog.read_source(spark, str(tmp_path), "altitude").count() == 1


def geojson():
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    shapes = [("01001", "Polygon", square), ("01002", "MultiPolygon", [square, [[[5, 5], [6, 5], [6, 6], [5, 6], [5, 5]]]])]
    return [
        {"type": "Feature", "properties": {"code": c, "nom": "N", "tags": ["a", "b"]}, "geometry": {"type": k, "coordinates": g}}
        for c, k, g in shapes
    ]


@pytest.mark.parametrize("style", ["lines", "collection", "document", "compact"])
def test_geojson(spark, tmp_path, style):
    features = geojson()
    if style == "lines":
        text = "\n".join(json.dumps(f) for f in features)
    elif style == "collection":
        text = '{"type": "FeatureCollection", "features": [\n' + ",\n".join(json.dumps(f) for f in features) + "\n]}"
    else:
        text = json.dumps({"type": "FeatureCollection", "features": features}, indent=1 if style == "document" else None)
    put(tmp_path, "x.geojson", text)
    rows = readers.read_geojson(spark, str(tmp_path / "x.geojson"), ["code", "tags"], ["tags"]).withColumn("area", geo.area(F.col("geometry"))).orderBy("code").collect()
    assert [(r["code"], r["area"], r["tags"]) for r in rows] == [("01001", 4.0, ["a", "b"]), ("01002", 5.0, ["a", "b"])]


def test_geojson_document_is_split(spark, tmp_path):
    features = [
        {"type": "Feature", "properties": {"code": str(i), "tags": ['x "type": "Feature" y', "{"]}, "geometry": {"type": "Point", "coordinates": [i, 1.5]}}
        for i in range(200)
    ]
    put(tmp_path, "p.geojson", json.dumps({"type": "FeatureCollection", "features": features}))
    put(tmp_path, "q.geojson", json.dumps({"type": "FeatureCollection", "features": [{"geometry": None, "properties": {"code": "1"}, "type": "Feature"}, {"type": "Feature"}]}))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = readers.read_geojson(spark, str(tmp_path / "p.geojson"), ["code", "tags"], ["tags"])
        assert df.rdd.getNumPartitions() > 3
        assert sorted((r["code"], r["x"]) for r in df.collect()) == sorted((str(i), float(i)) for i in range(200))
        assert df.first()["tags"][0] == 'x "type": "Feature" y'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(Exception, match="type"):
        readers.read_geojson(spark, str(tmp_path / "q.geojson"), ["code"]).collect()


def test_preamble(spark, tmp_path):
    for i in range(3):
        put(tmp_path, f"in/f{i}.csv", f"Title\n\nINSEE_COM,CLASSEMENT\n0{i}001,Mer\n\n0{i}002,Lac\n")
    df = readers.read_after_preamble(spark, str(tmp_path / "in"), 2)
    assert df.columns == ["INSEE_COM", "CLASSEMENT"]
    assert sorted(r["INSEE_COM"] for r in df.collect()) == [f"0{i}00{j}" for i in range(3) for j in (1, 2)]
    flags = {r["commune_id"]: (r["is_coast"], r["has_lake"]) for r in T.littoral(df).collect()}
    assert flags["00001"] == (True, False) and flags["00002"] == (False, True)
    with pytest.raises(ValueError):
        readers.read_after_preamble(spark, str(tmp_path / "in" / "f0.csv"), 20)


def test_preamble_headers_differ_by_file(spark, tmp_path):
    put(tmp_path, "in/a.csv", "Title\n\nA;B\n1;2\n")
    put(tmp_path, "in/b.csv", "Title\n\nB;A;C\n20;10;30\n")
    df = readers.read_after_preamble(spark, str(tmp_path / "in"), 2, sep=";")
    assert df.columns == ["A", "B", "C"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", None), ("10", "20", "30")]
    given = readers.read_after_preamble(spark, str(tmp_path / "in"), 2, ["x", "y"], sep=";")
    assert sorted(tuple(r) for r in given.collect()) == [("1", "2"), ("20", "10")]


def test_geojson_of_any_spelling_and_layout(spark, tmp_path):
    def feature(code, colon):
        return f'{{"type"{colon}"Feature","properties":{{"code":"{code}","kind":"FeatureX"}},"geometry":{{"type":"Point","coordinates":[{code},2]}}}}'

    put(tmp_path, "g/a.json", '{"type":"FeatureCollection","features":[' + ",".join(feature(i, ":") for i in (1, 2, 3)) + "]}")
    put(tmp_path, "g/b.json", '{ "type": "FeatureCollection", "features": [\n' + ",\n".join(feature(i, ": ") for i in (4, 5)) + "\n]}\n")
    put(tmp_path, "g/c.json", "\n".join(feature(i, " : ") for i in (6, 7)) + "\n")
    put(tmp_path, "g/d.json", '{"type":"FeatureCollection","features":[]}')
    rows = readers.read_geojson(spark, str(tmp_path / "g"), ["code"]).collect()
    assert sorted((r["code"], r["x"]) for r in rows) == [(str(i), float(i)) for i in range(1, 8)]
    put(tmp_path, "h/a.json", '{"type":"FeatureCollection","features":[{"properties":{"kind":"Feature"},"type":"Feature"}]}')
    with pytest.raises(Exception, match="does not start with its type"):
        readers.read_geojson(spark, str(tmp_path / "h"), ["code"]).collect()


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, path)
    writers.create_if_missing(spark, path, "a int")
    assert readers.read_table(spark, path).count() == 0
    assert writers.write_table(spark.range(3).selectExpr("cast(id as int) a"), path) == 2
    assert readers.read_table(spark, path).count() == 3 and readers.read_table(spark, path, 1).count() == 0
    writers.write_table(spark.range(1).selectExpr("cast(id as int) a"), path)
    assert writers.drop_old_versions(spark, path, 1) == [1, 2] and readers.versions(spark, path) == [3]
    assert writers.drop_table(spark, path) and not writers.drop_table(spark, path)


def test_unfinished_version_is_invisible(spark, tmp_path):
    path = tmp_path / "t"
    writers.write_table(spark.range(1), str(path))
    put(path, "version=2/part-0.parquet", "half")
    assert readers.versions(spark, str(path)) == [1]


def test_single_csv(spark, tmp_path):
    writers.write_csv(spark.range(3).selectExpr("id as b", "id * 2 as a"), str(tmp_path / "o"), ["a", "b"], single=True)
    files = list((tmp_path / "o").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text().splitlines()[0] == "a,b"


def test_arrivals(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, v int")
    schema = rows(("a", 1)).schema
    for batch in ([("a", 1), ("b", 2)], [("b", 9), ("c", 3)]):
        rows(*batch).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        query = append_arrivals(stream, table, ["id"], str(tmp_path / "ck")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    got = spark.read.parquet(table)
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    # Each batch holds the buckets of the keys it brought.
    held = lambda n: {p.parent.name for p in (tmp_path / "table" / f"batch={n}").rglob("*.parquet")}
    assert len(held(0)) == 2 and len(held(1)) == 1 and not held(0) & held(1)


def test_build_and_check(spark, tmp_path):
    from cadastra.plans import rules

    good = spark.createDataFrame([("01001", "M1"), ("01002", "M1")], "commune_code string, monument_reference string")
    assert rules.build_and_check("bridge_monument_communes", good, str(tmp_path / "b")).filter("failures > 0").isEmpty()
    with pytest.raises(ValueError, match="unique_combination"):
        rules.build_and_check("bridge_monument_communes", good.union(good), str(tmp_path / "b"))


def test_rule_counts():
    from collections import Counter

    from cadastra.plans import rules

    kinds = Counter(r.kind for table in rules.RULES.values() for r in table)
    assert kinds["accepted_range"] == 94 and kinds["relationship"] == 13 and kinds["accepted_values"] == 8 and kinds["not_null"] == 68


def test_layer_of_stored_tables(spark, tmp_path):
    for n in (1, 2):
        writers.write_table(spark.range(n), str(tmp_path / "t"))
    assert catalog.register_stored_layer(spark, "gold", str(tmp_path), ["t"]) == ["gold_t"]
    assert readers.query(spark, "SELECT count(*) FROM gold_t WHERE id >= :low", {"low": 1}).first()[0] == 1
    assert catalog.create_layer(spark, "silver", str(tmp_path), ["t"]) == ["silver.t"]
    assert readers.query(spark, "SELECT * FROM silver.t", limit=1).count() == 1
    assert spark.table("silver.t").count() == 2
    spark.sql("DROP SCHEMA silver CASCADE")


def test_loads_leave_closed_partitions_alone(spark, tmp_path):
    from cadastra.operators import stored

    path = str(tmp_path / "h")
    deliver = lambda *rows: spark.createDataFrame(rows, "id int, v string")
    files = lambda: {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    stored.load_history(spark, path, deliver((1, "a"), (2, "b")), ["id"], "2024-01-01", "2024-01-01")
    stored.load_history(spark, path, deliver((1, "A"), (2, "b")), ["id"], "2024-02-01", "2024-02-01")
    before = files()
    stored.load_history(spark, path, deliver((1, "A"), (3, "c")), ["id"], "2024-03-01", "2024-03-01")
    after = files()
    assert all(after[p] == t for p, t in before.items())
    rows = sorted((r["id"], r["v"], str(r["effective_date"]), str(r["expiry_date"])) for r in stored.read_history(spark, path).collect())
    assert rows == [
        (1, "A", "2024-02-01", "9999-12-31"), (1, "a", "2024-01-01", "2024-02-01"),
        (2, "b", "2024-01-01", "2024-03-01"), (3, "c", "2024-03-01", "9999-12-31"),
    ]
    with pytest.raises(ValueError):
        stored.load_history(spark, path, deliver((1, "A")), ["id"], "2024-03-01", "2024-03-01")


def test_a_broken_off_load_is_invisible_and_can_be_repeated(spark, tmp_path):
    from cadastra.operators import stored

    path = str(tmp_path / "h")
    deliver = lambda *rows: spark.createDataFrame(rows, "id int, v string")
    stored.load_history(spark, path, deliver((1, "a")), ["id"], "2024-01-01", "2024-01-01")
    # Closed rows of a load whose open rows were never written.
    stored.read_history(spark, path).write.parquet(f"{path}/closed/version=20240201")
    assert stored.read_history(spark, path).count() == 1
    stored.load_history(spark, path, deliver((1, "b")), ["id"], "2024-02-01", "2024-02-01")
    assert stored.read_history(spark, path).count() == 2
    # A load whose rows were written, but not its list.
    rows = stored.read_history(spark, path).selectExpr("*", "1 AS _open", "0 AS _bucket")
    rows.write.partitionBy("_open", "_bucket").parquet(f"{path}/rows/version=20240301")
    assert stored.read_history(spark, path).count() == 2
    stored.load_history(spark, path, deliver((1, "c")), ["id"], "2024-03-01", "2024-03-01")
    assert [r["v"] for r in stored.read_history(spark, path).orderBy("effective_date").collect()] == ["a", "b", "c"]


def test_appends_are_repeatable(spark, tmp_path):
    from cadastra.operators import stored

    path = str(tmp_path / "f")
    deliver = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    stored.load_new(spark, path, deliver(1, 2), ["id"], "2024-01-01", "2024-01-01")
    for _ in range(2):
        stored.load_new(spark, path, deliver(2, 3), ["id"], "2024-01-02", "2024-01-02")
    assert sorted(r["id"] for r in stored.read_loaded(spark, path).collect()) == [1, 2, 3]


def test_a_load_with_one_change_touches_one_bucket(spark, tmp_path):
    from cadastra.operators import stored

    path = str(tmp_path / "h")
    deliver = lambda rows: spark.createDataFrame(rows, "id int, v string, w string")
    written = lambda n: sorted({p.parent.name for p in tmp_path.rglob(f"rows/version={n}/**/*.parquet")})
    first = [(i, f"v{i}", None) for i in range(500)]
    assert len(stored.load_history(spark, path, deliver(first), ["id"], "2024-01-01", "2024-01-01", 16)) == 16
    # The same rows in another order change nothing.
    assert stored.load_history(spark, path, deliver(first[::-1]), ["id"], "2024-01-02", "2024-01-02") == []
    assert written(20240102) == [] and stored.read_history(spark, path).count() == 500
    # A value that moves to the next column is a change, in one bucket.
    moved = [(i, None, v) if i == 7 else (i, v, w) for i, v, w in first]
    one = stored.load_history(spark, path, deliver(moved), ["id"], "2024-01-03", "2024-01-03")
    assert len(one) == 1 and written(20240103) == [f"_bucket={one[0]}"]
    rows = stored.read_history(spark, path)
    assert rows.count() == 501 and rows.filter("is_current").count() == 500
    assert [(r["v"], r["w"], r["is_current"]) for r in rows.filter("id = 7").orderBy("effective_date").collect()] == [("v7", None, False), (None, "v7", True)]
    # All rows of the other buckets go.
    left = [r for r in moved if r[0] == 7]
    assert len(stored.load_history(spark, path, deliver(left), ["id"], "2024-01-04", "2024-01-04")) == 16
    rows = stored.read_history(spark, path)
    assert rows.filter("is_current").count() == 1 and rows.count() == 501
    for bad in ([(7, "x", None), (7, "y", None)], [(None, "x", None)]):
        with pytest.raises(ValueError):
            stored.load_history(spark, path, deliver(bad), ["id"], "2024-01-05", "2024-01-05")
    with pytest.raises(ValueError):
        stored.load_history(spark, path, deliver(left).drop("w"), ["id"], "2024-01-05", "2024-01-05")
    assert stored.read_history(spark, path).count() == 501


def test_stored_loads_equal_the_merge_of_whole_tables(spark, tmp_path):
    import random

    from cadastra.operators import history, stored

    draw = random.Random(5)
    path, kind = str(tmp_path / "h"), "a int, b string, v double, s struct<x:int,y:int>"
    whole = history.empty_history(spark, spark.createDataFrame([], kind).schema)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"):
        keys = [(a, b) for a in range(12) for b in "pqr" if draw.random() < 0.7] if day != "2024-01-03" else []
        rows = [(a, b, draw.choice([None, 0.0, 1.5]), draw.choice([(1, None), (None, 1), None])) for a, b in keys]
        incoming = spark.createDataFrame(rows, kind)
        stored.load_history(spark, path, incoming, ["a", "b"], day, day, 5)
        whole = spark.createDataFrame(history.scd2_merge(whole, incoming, ["a", "b"], day, day).collect(), whole.schema)
        order = lambda df: sorted(map(repr, df.select(whole.columns).collect()))
        assert order(stored.read_history(spark, path)) == order(whole)


def test_appends_look_at_changed_buckets_only(spark, tmp_path):
    from cadastra.operators import stored

    path = str(tmp_path / "f")
    deliver = lambda *ids: spark.createDataFrame([(i, "x") for i in ids], "id int, v string")
    stored.load_new(spark, path, deliver(), ["id"], "2024-01-01", "2024-01-01", 8)
    assert stored.read_loaded(spark, path).count() == 0
    stored.load_new(spark, path, deliver(*range(100)), ["id"], "2024-01-02", "2024-01-02")
    assert stored.load_new(spark, path, deliver(*range(100)), ["id"], "2024-01-03", "2024-01-03") == []
    assert len(stored.load_new(spark, path, deliver(*range(101)), ["id"], "2024-01-04", "2024-01-04")) == 1
    assert sorted(r["id"] for r in stored.read_loaded(spark, path).collect()) == list(range(101))
    # Keys with a NULL are never known, whether their bucket changes or not.
    for day in ("2024-01-05", "2024-01-06"):
        stored.load_new(spark, path, deliver(None), ["id"], day, day)
    assert stored.read_loaded(spark, path).filter("id is null").count() == 2


def test_a_file_above_two_gigabytes_is_hashed(spark, tmp_path):
    import hashlib

    from cadastra.operators import manifest

    big, size = tmp_path / "big.bin", 2**31 + 12345
    with open(big, "wb") as file:
        file.truncate(size)
        file.seek(size - 3)
        file.write(b"end")
    (tmp_path / "a b é.bin").write_bytes(b"\x00\xff" * 10)
    (tmp_path / "other.txt").write_bytes(b"x")
    digest = hashlib.md5()
    with open(big, "rb") as file:
        while block := file.read(1 << 24):
            digest.update(block)
    found = {r["filename"]: (r["bytes"], r["md5"]) for r in manifest.hash_files(spark, str(tmp_path), "*.bin").collect()}
    big.unlink()
    assert found["big.bin"] == (size, digest.hexdigest())
    assert len(found) == 2 and (20, hashlib.md5(b"\x00\xff" * 10).hexdigest()) in found.values()


def test_archive_list_ranks_the_newest_only(spark):
    from pyspark.sql import functions as F

    from cadastra.operators import manifest

    rows = [("a", f"{i:04d}") for i in range(500)] + [("b", "0001"), ("c", "0007"), ("c", "0003"), (None, "0001"), (None, "0002"), (None, "0000"), ("d", None), ("d", "0002"), ("d", "0004")]
    files = spark.createDataFrame(rows, "base string, stamp string").withColumn("name", F.concat_ws("_", "base", "stamp"))
    past = manifest.archive_list(files, F.col("base"), F.col("stamp"), keep=2)
    plan = past._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("+- Window ") == 1
    found = [(r["base"], r["stamp"]) for r in past.collect()]
    want = [("a", f"{i:04d}") for i in range(498)] + [(None, "0000"), ("d", None)]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert manifest.archive_list(files.limit(0), F.col("base"), F.col("stamp")).count() == 0


def test_the_newest_delivery_is_chosen_by_its_stamp(spark, tmp_path):
    from cadastra.sources import readers

    for stamp, n in (("20240201", 2), ("20240301", 3), ("20240115", 1)):
        spark.range(n).write.parquet(f"{tmp_path}/x_{stamp}")
    spark.range(9).write.parquet(f"{tmp_path}/y_20250101")
    newest = readers.newest_delivery(spark, f"{tmp_path}/x_*")
    assert newest.endswith("x_20240301") and readers.read_parquet(spark, newest).count() == 3
    every = readers.read_deliveries(spark, f"{tmp_path}/x_*").groupBy("delivery").count().collect()
    assert {r["delivery"]: r["count"] for r in every} == {"x_20240201": 2, "x_20240301": 3, "x_20240115": 1}
