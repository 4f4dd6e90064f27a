"""Generic operators on hand-written rows (edges from the fixture notes)."""

import os

import re

import pytest
from pyspark.sql import functions as F

from claimlake.operators import aggregates as A
from claimlake.operators import joins as J
from claimlake.operators import reshape as RS
from claimlake.operators import windows as W


def test_wide_to_long_discovers_suffixes(spark):
    df = spark.createDataFrame([("a", 1, 10, 2, 20)], "id string, x_2019 int, y_2019 int, x_2020 int, y_2020 int")
    out = RS.wide_to_long(df, ["id"], ["x", "y"], "year").orderBy("year").collect()
    assert [(r.id, r.year, r.x, r.y) for r in out] == [("a", 2019, 1, 10), ("a", 2020, 2, 20)]


def test_wide_to_long_missing_stub_is_null(spark):
    df = spark.createDataFrame([("a", 1, 10, 2)], "id string, x_2019 int, y_2019 int, x_2020 int")
    out = RS.wide_to_long(df, ["id"], ["x", "y"], "year").orderBy("year").collect()
    assert out[1].y is None and out[1].x == 2


def test_long_rows_equal_wide_rows_times_keys(spark):
    df = spark.range(37).select(F.col("id").alias("id"), *[F.col("id").alias(f"v_{y}") for y in range(2000, 2005)])
    assert RS.wide_to_long(df, ["id"], ["v"], "y").count() == 37 * 5


def test_metrics_to_rows(spark):
    df = spark.createDataFrame([("s", 10, 99.0, 98.9)], "src string, n int, a double, b double")
    out = RS.metrics_to_rows(df, ["src", "n"], {"a": "a", "b": "b"}, "col", "pct").collect()
    assert [(r.col, r.pct) for r in out] == [("a", 99.0), ("b", 98.9)]


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_ranked_running_total_matches_window(spark, slices):
    # one hot year holds most rows; ties on value broken by name
    rows = [(2001 if i % 4 else 2000, float(i % 9), f"n{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "year int, v double, name string")
    order = [F.col("v").desc(), F.col("name").asc()]
    got = W.ranked_running_total(df, ["year"], order, "v", "rk", "cum", "tot", slices=slices)
    want = W.ranked_running_total(df, ["year"], order, "v", "rk", "cum", "tot", method="window")
    a = {(r.year, r.name): (r.rk, r.cum, r.tot) for r in got.collect()}
    b = {(r.year, r.name): (r.rk, r.cum, r.tot) for r in want.collect()}
    assert a == b and len(a) == 200


@pytest.mark.parametrize("slices", [2, 5, 16])
def test_ranks_of_many_rows_from_one_file(spark, tmp_dir, slices):
    """More rows than the range sample holds, every column kept, one input file."""
    path = os.path.join(tmp_dir, "one")
    spark.range(30_000).select(
        F.when(F.col("id") % 10 < 8, 2001).otherwise(F.col("id") % 10 + 1990).cast("int").alias("year"),
        (F.col("id") * 7919 % 613).cast("decimal(18,2)").alias("v"), F.col("id").alias("name"),
        F.md5(F.col("id").cast("string")).alias("more"), F.lit(1).alias("rest")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    order = [F.col("v").desc(), F.col("name").asc()]
    got = W.ranked_running_total(df, ["year"], order, "v", "rk", "cum", "tot", slices=slices)
    want = W.ranked_running_total(df, ["year"], order, "v", "rk", "cum", "tot", method="window")
    assert got.count() == 30_000 and got.exceptAll(want.select(*got.columns)).isEmpty()
    ranks = got.groupBy("year").agg(F.max("rk").alias("m"), F.count_distinct("rk").alias("d"), F.count(F.lit(1)).alias("n"))
    assert ranks.where("m <> n or d <> n").isEmpty()


@pytest.mark.parametrize("by", [(), ("g",)])
def test_percentile_cuts_equal_spark(spark, by):
    df = spark.createDataFrame([(i % 3, (i * 37 % 50) or None) for i in range(200)] + [(9, None), (8, 4)], "g int, v int")
    ps = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = A.percentile_cuts(df, "v", ps, by)
    want = df.where("v is not null").groupBy(*by).agg(*[F.percentile("v", F.lit(p)).alias(f"_p{i}") for i, p in enumerate(ps)])

    def rounded(d):
        return sorted(tuple(round(float(x), 9) for x in r) for r in d.collect())
    assert rounded(got) == rounded(want.select(*got.columns))


def test_key_guard_reads_the_whole_dimension(spark):
    from claimlake.operators.joins import FanOutError, checked_broadcast
    dim = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    assert "broadcast" in checked_broadcast(dim, ["k"])._jdf.queryExecution().analyzed().toString().lower()
    with pytest.warns(UserWarning):
        assert "broadcast" not in checked_broadcast(dim, ["k"], max_bytes=100)._jdf.queryExecution().analyzed().toString().lower()
    for limit in (100, 64 << 20):
        with pytest.raises(FanOutError):
            checked_broadcast(dim.unionByName(dim.where("k = '4999'")), ["k"], max_bytes=limit)


def test_distincts_are_not_expanded(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (1, None, 2), (1, "b", 2)], "k int, v string, w int")
    one = A.distinct_per_group(df, ["k"], "v", "n")
    both = A.join_groups(one, A.distinct_per_group(df, ["k"], "w", "m"), ["k"])
    assert sorted(map(tuple, both.collect()), key=str) == [(1, 1, 1), (None, 1, 1)]
    assert "Expand" not in both._jdf.queryExecution().toString()


def test_share_of_total_zero_total_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 3)], "y int, v int")
    out = W.share_of_total(df, "v", ["y"], "pct").orderBy("y", "v").collect()
    assert [r.pct for r in out] == [None, None, 25.0, 75.0]


def test_year_over_year_needs_previous_year(spark):
    df = spark.createDataFrame([("A", 2019, 100), ("A", 2020, 110), ("A", 2022, 121)], "k string, y int, v int")
    out = W.year_over_year(df, ["k"], "y", "v", "prev", "pct").orderBy("y").collect()
    assert [(r.prev, r.pct) for r in out] == [(None, None), (100, 10.0), (None, None)]


def test_pareto_tier_edges(spark):
    df = spark.createDataFrame([(80.0,), (80.01,), (95.0,), (95.01,)], "c double")
    out = [r[0] for r in df.select(W.pareto_tier("c")).collect()]
    assert out == ["Top 80%", "Next 15%", "Next 15%", "Long Tail"]


def test_percentile_cuts_of_a_hot_group(spark, capsys):
    """A million distinct values in one group: equal to Spark's own, and no task orders more than a bucket."""
    df = spark.range(1_000_000).select(F.lit("hot").alias("g"), ((F.col("id") * 7919) % 1_000_003).cast("decimal(18,2)").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 3), (None, 5), ("one", 4), ("none", None)], "g string, v int")
                        .withColumn("v", F.col("v").cast("decimal(18,2)")))
    ps = (0.0, 0.25, 0.5, 0.9, 1.0)
    for by in (["g"], []):
        got = A.percentile_cuts(df, "v", ps, by)
        want = df.where("v is not null").groupBy(*by).agg(*[F.percentile("v", F.lit(p)).alias(f"_p{i}") for i, p in enumerate(ps)])
        key = (lambda r: str(r["g"])) if by else str
        for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
            assert [a[x] for x in by] == [b[x] for x in by]
            assert [a[f"_p{i}"] for i in range(5)] == pytest.approx([b[f"_p{i}"] for i in range(5)], rel=1e-12)
        got.explain()
        plan = capsys.readouterr().out
        assert "percentile(" not in plan.replace("percentile_approx(", "") and "CartesianProduct" not in plan
        assert not re.search(r"Exchange SinglePartition.*\n[^\n]*\n?[^\n]*Window", plan)
        windows = re.findall(r"Window \[.*\], \[([^\]]*)\], \[", plan)
        assert windows and all("_b" in w for w in windows)


def test_distinct_sketches_merge(spark):
    df = spark.range(400_000).select((F.col("id") % 7).alias("area"), (F.col("id") % 2).alias("state"),
                                     F.concat(F.lit("npi"), F.col("id") % 90_000).alias("npi"))
    df = df.unionByName(spark.createDataFrame([(8, 5, None), (9, 5, "x"), (8, 5, "x")], "area long, state long, npi string"))
    fine = A.distinct_sketches(df, ["area", "state"], "npi", "s")
    exact = {r.state: r.n for r in df.groupBy("state").agg(F.count_distinct("npi").alias("n")).collect()}
    got = {r.state: r.n for r in A.merged_distinct(fine, ["state"], "s", "n").collect()}
    assert got.keys() == exact.keys() and got[5] == 1
    assert all(abs(got[k] - exact[k]) <= A.SKETCH_BOUND * exact[k] for k in exact)


def test_percentile_tiers_global(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (0,), (None,)], "c int")
    out = A.percentile_tiers(df, "c", "tier", [("High", 0.75), ("Medium", 0.25)], "Low",
                             where=F.col("c") > 0).collect()
    tiers = {r.c: r.tier for r in out}
    # P75 of 1,2,3,10 = 4.75, P25 = 1.75
    assert tiers == {1: "Low", 2: "Medium", 3: "Medium", 10: "High", 0: "Low", None: "Low"}


def test_top_label_ties_break_on_label(spark):
    df = spark.createDataFrame([("g", "B", 5.0), ("g", "A", 5.0), ("g", "C", 1.0)], "k string, name string, s double")
    assert df.groupBy("k").agg(A.top_label("name", "s")).first()[1] == "B"


def test_checked_broadcast_rejects_duplicate_keys(spark):
    dim = spark.createDataFrame([("A", 1), ("A", 2)], "k string, v int")
    with pytest.raises(J.FanOutError):
        J.checked_broadcast(dim, ["k"], 10, "dim")


def test_checked_broadcast_falls_back_when_large(spark):
    dim = spark.range(50).withColumnRenamed("id", "k")
    with pytest.warns(UserWarning):
        out = J.checked_broadcast(dim, ["k"], 10, "dim")
    assert out.count() == 50


def test_count_distinct_if_and_sum_if(spark):
    df = spark.createDataFrame([(1, True, 5), (1, False, 7), (2, True, 5), (2, True, None)], "npi int, s boolean, c int")
    r = df.agg(A.count_distinct_if(F.col("s"), "npi").alias("n"), A.sum_if(F.col("s"), "c").alias("t")).first()
    assert (r.n, r.t) == (2, 10)


def test_top_labels_matches_single_pass(spark):
    rows = [("g", "B", 5.0), ("g", "A", 5.0), ("g", "C", 1.0), ("g", "C", 6.0), ("h", "X", 2.0)]
    df = spark.createDataFrame(rows, "k string, name string, s double")
    one = {r.k: r.t for r in df.groupBy("k").agg(A.top_label("name", "s").alias("t")).collect()}
    two = {r.k: r.t for r in A.top_labels(df, ["k"], "name", "s", "t").collect()}
    assert one == two == {"g": "C", "h": "X"}
