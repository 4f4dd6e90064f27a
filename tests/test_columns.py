"""Column helpers: rounding, suppression, keys, tiers."""

import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from claimlake.functions import columns as C


def _one(spark, expr, schema="x int"):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_ratio_rounds_half_away_from_zero(spark):
    rows = spark.createDataFrame(
        [(201, 200), (107, 40), (-1, 200), (1, 0), (None, 3), (5, None)], "a int, b int")
    out = rows.select(C.ratio("a", "b", 2).alias("r")).collect()
    assert [r["r"] for r in out] == [1.01, 2.68, -0.01, None, None, None]


def test_ratio_exact_half_of_large_quotient(spark):
    # 3448287.01 / 2 = 1724143.505 exactly -> 1724143.51
    df = spark.createDataFrame([(Decimal("3448287.01"), 2)], "a decimal(18,2), b int")
    assert df.select(C.ratio("a", "b", 2)).first()[0] == 1724143.51


def test_ratio_scale_and_default(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a int, b int")
    out = df.select(C.ratio_or("a", "b", 1, 0.0, 100).alias("p")).collect()
    assert [r["p"] for r in out] == [33.3, 0.0]


def test_mean_is_exact_decimal_mean(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.2,)], "x double")
    assert df.agg(C.mean("x", 2)).first()[0] == 0.17


def test_suppress_small_cells(spark):
    df = spark.createDataFrame([(10,), (11,), (12,), (None,)], "b int")
    out = [r[0] for r in df.select(C.suppress_small_cells("b", 11)).collect()]
    assert out == [None, 11, 12, None]


def test_surrogate_key_matches_md5_convention(spark):
    df = spark.createDataFrame([(2023, "X", None, True)], "y int, a string, b string, f boolean")
    got = df.select(C.surrogate_key("y", "a", "b", "f")).first()[0]
    want = hashlib.md5(b"2023-X-_dbt_utils_surrogate_key_null_-true").hexdigest()
    assert got == want


def test_flag_null_is_false(spark):
    df = spark.createDataFrame([(None,), (1,), (0,)], "x int")
    out = [r[0] for r in df.select(C.flag(F.col("x") > 0)).collect()]
    assert out == [False, True, False]


def test_label_tiers_and_cost_tier(spark):
    df = spark.createDataFrame([(830.0,), (830.01,), (100.0,), (None,)], "m double")
    out = df.select(C.cost_tier("m").alias("t")).collect()
    assert [r["t"] for r in out] == ["Moderate", "High Cost", "Low Cost", "Low Cost"]
    tiers = df.select(C.label_tiers("m", [("A", 830.0), ("B", 100.0)], "C").alias("t")).collect()
    assert [r["t"] for r in tiers] == ["A", "A", "B", "C"]


def test_strip_upper_and_blank(spark):
    df = spark.createDataFrame([(" Abc ",), ("\tabc\n",), ("",), ("   ",), (None,)], "s string")
    out = df.select(C.strip_upper("s").alias("u"), C.is_blank("s").alias("b")).collect()
    assert [r["u"] for r in out] == ["ABC", "ABC", "", "", None]
    assert [r["b"] for r in out] == [False, False, True, True, True]


def test_mask_and_hash(spark):
    df = spark.createDataFrame([("Ab1-",)], "s string")
    r = df.select(C.mask_text("s").alias("m"), C.hash_identifier("s", "salt").alias("h")).first()
    assert r["m"] == "Xxn-"
    assert r["h"] == hashlib.sha256(b"saltAb1-").hexdigest()


def test_legend_bin(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (249.9,), (250.0,), (2500.0,)], "x double")
    out = [r[0] for r in df.select(C.legend_bin("x", 0, 2500, 10)).collect()]
    assert out == [0, 1, 1, 2, 11]
