"""Clustering by interleaved ranks: filters on each column skip row groups, no row is changed."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from claimlake.operators.clustering import cluster, cut_points, interleaved_key
from claimlake.plans.build import LAYOUT
from claimlake.plans.catalog import project
from claimlake.sources.sinks import write_table
from tests.conftest import SF_CHECK


def groups_read(path, column, value):
    """(row groups whose statistics admit ``value``, all row groups)."""
    read = total = 0
    for f in glob.glob(os.path.join(path, "**", "*.parquet"), recursive=True):
        meta = pq.ParquetFile(f).metadata
        i = meta.schema.to_arrow_schema().names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(i).statistics
            total += 1
            read += s.has_min_max and s.min <= value <= s.max
    return read, total


def test_each_filter_reads_a_third_at_most(spark, tmp_dir):
    """Two columns of many values: sorted by the first, a filter on the second skips little; interleaved, each
    filter reads a third at most."""
    d = project(spark, SF_CHECK).model("int_prescriber_drug_detail")
    columns = ("npi", "generic_name")
    dirs = {k: os.path.join(tmp_dir, k) for k in ("sorted", "interleaved")}
    d.repartitionByRange(64, *columns).sortWithinPartitions(*columns).write.parquet(dirs["sorted"])
    write_table(d, dirs["interleaved"], interleave=columns, files=64)
    back = spark.read.parquet(dirs["interleaved"])
    assert back.count() == d.count() and back.exceptAll(d).count() == 0
    for column in columns:
        some = d.select(column).distinct().orderBy(F.xxhash64(column)).limit(40).collect()
        for (value,) in some:
            read, total = groups_read(dirs["interleaved"], column, value)
            assert total == 64 and 0 < 3 * read <= total, (column, value, read)
            if column == "generic_name":
                assert groups_read(dirs["sorted"], column, value)[0] > 48


def test_layout_of_the_detail(spark, tmp_dir):
    """The built table is sorted by (area, state, npi): its first columns have few values, so a filter on either of
    them reads a third at most, as it does with the two interleaved."""
    d = project(spark, SF_CHECK).model("int_prescriber_drug_detail")
    d.repartitionByRange(64, *LAYOUT["int_prescriber_drug_detail"][1]).sortWithinPartitions(
        *LAYOUT["int_prescriber_drug_detail"][1]).write.parquet(tmp_dir + "/sorted")
    write_table(d, tmp_dir + "/z", interleave=("therapeutic_area", "state"), files=64)
    for column in ("therapeutic_area", "state"):
        reads = [[groups_read(f"{tmp_dir}/{k}", column, v)[0] for k in ("sorted", "z")]
                 for (v,) in d.where(F.col(column).isNotNull()).select(column).distinct().collect()]
        assert all(3 * max(r) <= 64 for r in reads), reads


def test_ranks_follow_the_values(spark):
    """Hot values, nulls, empty texts and equal beginnings; every type that can be clustered by."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, "")
        .otherwise(F.concat(F.lit("same-beginning-"), F.col("id").cast("string"))).alias("s"),
        (F.col("id") % 50 - 25).alias("n"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"),
        (F.col("id") % 2 == 0).alias("b"), F.lit("x").alias("_cluster_key"))
    for c in ("n", "d", "b"):
        key = df.select(c, interleaved_key(df, cut_points(df, [c])).alias("k")).distinct().orderBy(c).collect()
        assert [r.k for r in key] == sorted(r.k for r in key) and len({r.k for r in key}) > (1 if c == "b" else 30)
    out = cluster(df, ["s", "n", "d"], files=8)
    assert out.columns == df.columns and out.exceptAll(df).count() == 0 and out.count() == 2000
    sizes = [len(p) for p in out.rdd.glom().collect()]
    assert max(sizes) < 2.5 * 2000 / 8
    assert cluster(df.limit(0), ["s", "n"]).count() == 0
    with pytest.raises(ValueError, match="cannot cluster"):
        cut_points(df.withColumn("m", F.array("n")), ["m"])


def test_years_stay_apart(spark, tmp_dir):
    df = spark.range(600).select((2020 + F.col("id") % 3).alias("y"), (F.col("id") % 10).alias("a"), (F.col("id") % 13).alias("c"))
    write_table(df, tmp_dir + "/t", partition_by=("y",), interleave=("a", "c"), files=12)
    assert sorted(os.listdir(tmp_dir + "/t"))[-3:] == ["y=2020", "y=2021", "y=2022"]
    assert spark.read.parquet(tmp_dir + "/t").select("y", "a", "c").exceptAll(df.select("y", "a", "c")).count() == 0
