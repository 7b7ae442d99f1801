"""One key with a third and more of the rows: same results, spread over tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadastra.operators import aggregates as A
from cadastra.operators import joins as J
from cadastra.operators import windows as W
from cadastra.operators.skew import heavy_keys, skew_join, with_salts


@pytest.fixture(scope="module")
def skewed(spark):
    """20,000 rows; key 1 has half of them, NULL a tenth, the rest are small."""
    n = F.col("id")
    key = F.when(n % 2 == 0, F.lit(1)).when(n % 10 == 1, F.lit(None)).otherwise(n % 500 + 2)
    return spark.range(20000).select(
        n.alias("row"), key.cast("bigint").alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(86400 * 20))).alias("ts"),
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))


def same(a, b):
    assert a.columns == b.columns
    left, right = a.exceptAll(b), b.exceptAll(a)
    assert left.isEmpty() and right.isEmpty()


def test_heavy_keys_are_measured(skewed):
    heavy = {r["_hash"]: r["_salts"] for r in heavy_keys(skewed, ["k"], 20).collect()}
    hashes = {r["k"]: r["h"] for r in skewed.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    # Half of the rows fill ten of twenty tasks, a tenth two; no other key fills one.
    assert heavy == {hashes[1]: 10, hashes[None]: 2}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("tasks", [None, 7, 100_000])
def test_join_equals_plain_join(skewed, lookup, how, tasks):
    got = skew_join(skewed, lookup, ["k"], how, tasks=tasks)
    same(got.select(sorted(got.columns)), (w := skewed.join(lookup, "k", how)).select(sorted(w.columns)))


def test_heavy_rows_go_to_many_tasks(spark, skewed, lookup):
    def tasks(df):
        return df.filter("k = 1").groupBy(F.spark_partition_id()).count().count()

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left, right = skewed.drop("ts"), lookup.hint("merge")
        assert tasks(left.join(right, "k", "left")) == 1
        assert tasks(skew_join(left, right, ["k"], "left", tasks=16)) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_key_of_a_thousandth_is_spread_over_two_thousand_tasks(spark):
    """The threshold follows the number of tasks, and right rows are repeated by share only."""
    rows = spark.range(200_000).select(
        "id", F.when(F.col("id") < 200, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    heavy = heavy_keys(rows, ["k"], 2000)
    assert [r["_salts"] for r in heavy.collect()] == [2]
    right = rows.select("k").distinct().withColumn("x", F.lit(1))
    repeated = with_salts(right, ["k"], heavy).withColumn("n", F.coalesce("_salts", F.lit(1)))
    assert repeated.agg(F.sum("n")).first()[0] == right.count() + 1
    assert heavy_keys(rows, ["k"], 500).isEmpty()


def test_previous_state(skewed):
    w = Window.partitionBy("k").orderBy("ts", "row")
    want = skewed.select("row", "k", "ts", "v", F.lag("v").over(w).alias("previous_v"))
    got = W.previous_state(skewed, ["k"], ["ts", "row"], ["v"])
    # NULL keys form a group of their own, as in the window.
    same(got.select("row", "previous_v"), want.select("row", "previous_v"))


@pytest.mark.parametrize("groups", [1, 3, 7, 5000])
def test_state_is_carried_over_ranges(spark, groups):
    """One key with all rows, keys over several ranges, keys of a few rows; NULL states and NULL keys; all rows
    of a key at the same time but for the tiebreak."""
    n = F.col("id")
    key = F.when(n % groups == 2, F.lit(None)).otherwise(n % groups)
    rows = spark.range(6000).select(
        n.alias("row"), key.alias("k"), (F.pmod(F.xxhash64("id"), F.lit(5)) * 0).alias("t"),
        F.when(F.xxhash64("id") % 3 == 0, n).alias("v"), F.when(F.xxhash64("id", F.lit(1)) % 997 == 0, n).alias("x"),
    )
    w = Window.partitionBy("k").orderBy("t", "row")
    got = W.previous_state(rows, ["k"], ["t", "row"], ["v", "row"], prefix="p_").select("row", "p_v", "p_row")
    same(got, rows.select("row", F.lag("v").over(w).alias("p_v"), F.lag("row").over(w).alias("p_row")))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    got = W.carry_forward(rows, ["k"], ["t", "row"], "x", "y").select("row", "y")
    same(got, rows.select("row", F.last("x", True).over(upto).alias("y")))
    assert W.previous_state(rows.limit(0), ["k"], ["t", "row"], ["v"]).count() == 0
    assert W.carry_forward(rows.limit(0), ["k"], ["t", "row"], "x", "y").count() == 0


def test_one_key_is_scanned_by_all_tasks(spark):
    rows = spark.range(40_000).select(F.col("id").alias("row"), F.lit(1).alias("k"), F.col("id").alias("v"))
    got = W.previous_state(rows, ["k"], ["row"], ["v"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    # One exchange of rows by range number, one of the ranges' ends.
    assert plan.count("shufflepartitionidpassthrough") == 1
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 20_000
    assert got.filter("previous_v = row - 1").count() == 39_999


def test_carry_forward_and_running_sum(skewed):
    rows = skewed.withColumn("x", F.when(F.col("v") % 7 == 0, F.col("v")))
    w = Window.partitionBy("k").orderBy("ts", "row").rowsBetween(Window.unboundedPreceding, 0)
    got = W.carry_forward(rows, ["k"], ["ts", "row"], "x", "y")
    same(got.select("row", "y"), rows.select("row", F.last("x", True).over(w).alias("y")))
    total = W.running_sum(rows, ["k"], F.date_trunc("day", "ts"), ["ts", "row"], "v", "s")
    same(total.select("row", "s"), rows.select("row", F.sum("v").over(w).alias("s")))


def test_flag_extreme(skewed):
    rows = skewed.select("row", "k", "v")
    w = Window.partitionBy("k").orderBy("v", "row")
    same(
        W.flag_extreme(rows, ["k"], ["v", "row"], "f").select("row", "f"),
        rows.select("row", (F.row_number().over(w) == 1).alias("f")),
    )


def test_latest_per_key_is_cut_before_the_shuffle(skewed):
    df = W.latest_per_key(skewed, ["k"], [F.col("ts").desc(), F.col("row").desc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[first_exchange:], plan


def test_surrogate_id_is_dense(skewed):
    ids = W.surrogate_id(skewed.select("row"), ["row"], "i", partitions=5)
    assert ids.filter("i = row + 1").count() == 20000


def test_exact_median(skewed):
    rows = skewed.filter("k is not null").select("k", F.col("v").cast("double").alias("v"))
    got = A.exact_median(rows, ["k"], "v", "m")
    same(got.select("k", "m"), rows.groupBy("k").agg(F.median("v").alias("m")).select("k", "m"))


def test_group_benchmark(skewed):
    rows = skewed.filter("k is not null").select("row", "k", "v")
    got = A.group_benchmark(rows, ["k"], {"mean": "v"})
    want = rows.withColumn("mean", F.avg("v").over(Window.partitionBy("k")))
    same(got.select("row", F.round("mean", 8).alias("m")), want.select("row", F.round("mean", 8).alias("m")))


def test_interval_join_with_a_crowded_day(spark):
    facts = spark.range(5000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, F.lit("2020-01-15").cast("date")).otherwise(
            F.date_add(F.lit("2019-12-01").cast("date"), (F.col("id") % 90).cast("int"))
        ).alias("d"),
    )
    terms = spark.createDataFrame(
        [("2019-12-10", "2020-01-15", "a"), ("2020-01-15", "2020-02-01", "b"), ("2020-01-20", None, "c"), ("2020-01-01", "2020-01-01", "empty")],
        "s string, e string, name string",
    ).select(F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"), "name")
    got = J.interval_join(facts, terms, "d", ["name"]).select("row", "name")
    cond = (F.col("d") >= F.col("start_date")) & ((F.col("d") < F.col("end_date")) | F.col("end_date").isNull())
    same(got, facts.join(terms, cond, "left").select("row", "name"))
    # On a boundary the new term holds, the old one does not.
    assert [r["name"] for r in got.filter("row = 0").collect()] == ["b"]


def test_interval_join_repeats_no_interval_per_partition(spark):
    """200 partitions: what meets the facts is a row per date and interval."""
    facts = spark.range(20000).select(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2500).cast("int")).alias("d"))
    terms = spark.createDataFrame([("2000-01-01", None, "open"), ("2021-01-01", "2022-01-01", "year")], "s string, e string, name string")
    terms = terms.select(F.to_date("s").alias("start_date"), F.to_date("e").alias("end_date"), "name")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        got = J.interval_join(facts, terms, "d", ["name"])
        assert got.count() == 20000 + 365 * 8
        assert heavy_keys(facts, ["d"]).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_finding_heavy_keys_shuffles_sketches_only(spark, skewed):
    """No exchange is dealt by the keys or their hash: only bounded sketches travel."""
    plan = heavy_keys(skewed, ["k"], 20)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert 1 <= len(exchanges) <= 2 and not any("xxhash64" in line or "k#" in line for line in exchanges)
    # The grouping of the first step is a number of map tasks, not a key.
    assert "keys=[_groupingexpression" in plan and "SPARK_PARTITION_ID()" in plan
    assert heavy_keys(skewed.limit(0), ["k"]).isEmpty()
    assert heavy_keys(skewed.repartition(50).filter("row < 0"), ["k"]).isEmpty()


def test_the_sketch_stays_within_its_error(spark):
    """Shares around the threshold among many more keys than the sketch tracks."""
    from cadastra.operators.skew import SKETCH_ERROR

    tasks, rows = 40, 400_000
    fair = rows // tasks
    sizes = {-1: int(fair * 0.5), -2: int(fair * 1.5), -3: fair * 3, -4: fair * 10}
    ends, at = [], 0
    for key, size in sizes.items():
        at += size
        ends.append((key, at))
    k = F.col("id")
    for key, end in reversed(ends):
        k = F.when(F.col("id") < end, F.lit(key)).otherwise(k)
    df = spark.range(rows).select(k.alias("k")).repartition(9)
    names = {r["h"]: r["k"] for r in spark.createDataFrame([(x,) for x in sizes], "k long").select("k", F.xxhash64("k").alias("h")).collect()}
    found = {names[r["_hash"]]: r["_salts"] for r in heavy_keys(df, ["k"], tasks).collect()}
    assert set(found) <= {-2, -3, -4} and {-3, -4} <= set(found)
    for key, salts in found.items():
        share = sizes[key] / fair
        assert share - SKETCH_ERROR <= salts <= share + 1


def test_an_interval_is_a_few_dyadic_nodes(spark):
    """The nodes are disjoint, cover the span exactly, and are few for any length."""
    import random

    r = random.Random(5)
    whole = 1 << J.DAY_BITS
    spans = [(0, whole), (0, 0), (5, 5), (7, 8), (1, whole - 1), (whole - 1, whole), (3, 2)]
    spans += [tuple(sorted((r.randrange(whole + 1), r.randrange(whole + 1)))) for _ in range(300)]
    df = spark.createDataFrame(spans, "a long, b long")
    for x in df.select("a", "b", J.dyadic_nodes(F.col("a"), F.col("b")).alias("n")).collect():
        parts = sorted((n.node << n.level, (n.node + 1) << n.level) for n in x.n)
        assert len(parts) <= 2 * J.DAY_BITS
        assert (not parts and x.a >= x.b) or (parts[0][0], parts[-1][1]) == (x.a, x.b)
        assert all(one[1] == two[0] for one, two in zip(parts, parts[1:]))


def test_interval_join_of_times(spark):
    """Interval ends within a day, open and empty intervals, times on the edges."""
    facts = spark.sql("SELECT id AS row, timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS d FROM range(120)")
    facts = facts.withColumn("d", F.when(F.col("row") != 60, F.col("d")))
    terms = spark.createDataFrame(
        [("2020-01-01 05:00:00", "2020-01-01 07:00:00", "hours"), ("2020-01-01 23:00:00", "2020-01-03 12:00:00", "days"),
         ("0001-01-01 00:00:00", "2020-01-02 01:00:00", "old"), ("2020-01-05 10:00:00", None, "open"), ("2020-01-02 00:00:00", "2020-01-02 00:00:00", "empty"), (None, None, "never")],
        "s string, e string, name string",
    ).select(F.to_timestamp("s").alias("start_date"), F.to_timestamp("e").alias("end_date"), "name")
    got = J.interval_join(facts, terms, "d", ["name"]).select("row", "name")
    cond = (F.col("d") >= F.col("start_date")) & ((F.col("d") < F.col("end_date")) | F.col("end_date").isNull())
    same(got, facts.join(terms, cond, "left").select("row", "name"))
