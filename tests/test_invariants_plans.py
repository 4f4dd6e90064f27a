"""Invariants on the driver fixture, and plan shapes that the scale design relies on."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from claimlake.params import FIXTURE
from claimlake.plans.catalog import project
from claimlake.sources.fixtures import FIXTURE_YEARS
from tests.conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def prj(spark):
    return project(spark, SF_CHECK)


def _plan(df, capsys):
    df.explain(mode="formatted")
    return capsys.readouterr().out


def test_long_rows_equal_wide_rows_times_years(prj):
    wide = prj.raw("raw_part_d_spending").where(
        F.col("gnrc_name").isNotNull() & (F.trim("gnrc_name") != ""))
    from claimlake.operators.reshape import wide_to_long
    from claimlake.sources.fixtures import SPENDING_STUBS
    long = wide_to_long(wide, ["gnrc_name"], SPENDING_STUBS, "y")
    assert long.count() == wide.count() * len(FIXTURE_YEARS)


def test_shares_sum_to_hundred(prj):
    sums = (prj.model("mart_therapeutic_area_mix").groupBy("drug_year")
            .agg(F.sum("spending_share_pct").alias("s")).collect())
    assert all(abs(r.s - 100.0) < 0.01 * 20 for r in sums)


def test_brand_plus_generic_is_total(prj):
    bad = prj.model("mart_brand_generic_ratio").where(
        F.col("brand_claims") + F.col("generic_claims") != F.col("total_claims"))
    assert bad.count() == 0


def test_cumulative_share_ends_at_hundred(prj):
    last = (prj.model("mart_specialty_vs_generic").groupBy("drug_year")
            .agg(F.max("cumulative_spending_pct").alias("m"), F.count("*").alias("n"),
                 F.max("spending_rank").alias("r")).collect())
    assert all(r.m == 100.0 and r.n == r.r for r in last)


def test_one_open_row_per_key_in_history(spark):
    from claimlake.plans.extra_queries import SNAPSHOT_KEYS, snapshot_history
    h = snapshot_history(project(spark, SF_SMALL))
    dup = h.where(F.col("valid_to").isNull()).groupBy(*SNAPSHOT_KEYS).count().where("count > 1")
    assert dup.count() == 0


def test_pareto_plan_splits_years_by_range(spark, capsys):
    plan = _plan(project(spark, SF_SMALL).model("mart_specialty_vs_generic"), capsys)
    # ranked per stored slice, not per year; both passes read the same stored slices
    assert "hashpartitioning(_slice" in plan and "BroadcastHashJoin" in plan
    assert len(set(re.findall(r"/ranked-\w+", plan))) == 1


@pytest.mark.parametrize("slices", ["1", "4", "16", "200"])
def test_pareto_ranks_at_every_partition_count(spark, slices):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, slices)
    try:
        rows = project(spark, SF_SMALL, replace(FIXTURE, min_beneficiaries=0)).model("mart_specialty_vs_generic").collect()
    finally:
        spark.conf.set(key, old)
    by = {}
    for r in rows:
        by.setdefault(r.drug_year, []).append(r)
    assert len(rows) > 200
    for year in by.values():
        year.sort(key=lambda r: (-r.total_spending, r.generic_name, r.brand_name, r.manufacturer_name))
        assert [r.spending_rank for r in year] == list(range(1, len(year) + 1))


def test_share_totals_are_broadcast_not_shuffled(spark, capsys):
    plan = _plan(project(spark, SF_SMALL).model("mart_manufacturer_performance_report"), capsys)
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan


def test_scan_prunes_columns_and_pushes_filters(spark, capsys):
    prj = project(spark, SF_SMALL)
    prj.materialize(["int_drug_enriched"], spark.conf.get("spark.checkpoint.dir") + "/plan_t")
    plan = _plan(prj.model("mart_kpi_scorecard"), capsys)
    assert "PushedFilters: [IsNotNull(total_beneficiaries), GreaterThanOrEqual(total_beneficiaries,11)]" in plan
    read = [ln for ln in plan.splitlines() if ln.strip().startswith("ReadSchema")][0]
    assert "manufacturer_count" not in read and "total_spending" in read


@pytest.mark.parametrize("name", ["mart_specialty_adoption_funnel", "mart_geographic_distribution", "mart_executive_summary"])
def test_detail_rows_are_not_expanded(spark, capsys, name):
    assert "Expand" not in _plan(project(spark, SF_SMALL).model(name), capsys)


def test_approx_distinct_switch(spark, capsys):
    exact = project(spark, SF_SMALL).model("mart_drug_spending_trends")
    approx = project(spark, SF_SMALL, replace(FIXTURE, approx_distinct_rsd=0.02)).model("mart_drug_spending_trends")
    assert "approx_count_distinct" in _plan(approx, capsys)
    e = {r.spending_trend_key: r.distinct_drugs for r in exact.collect()}
    a = {r.spending_trend_key: r.distinct_drugs for r in approx.collect()}
    assert e.keys() == a.keys()
    assert all(abs(a[k] - e[k]) <= max(2, 0.1 * e[k]) for k in e)


def test_tier_options(spark):
    base = {r.npi: r.engagement_tier for r in
            project(spark, SF_SMALL).model("int_prescriber_summary").collect()}
    by_year = {r.npi: r.engagement_tier for r in project(
        spark, SF_SMALL, replace(FIXTURE, tiers_by_year=True)).model("int_prescriber_summary").collect()}
    assert by_year == base  # one release year: same cut points
    approx = project(spark, SF_SMALL, replace(FIXTURE, approx_percentile_accuracy=10000))
    tiers = {r.engagement_tier for r in approx.model("int_prescriber_summary").collect()}
    assert tiers <= {"High", "Medium", "Low"}


def test_exact_recount_never_exceeds_summed_count(spark):
    prj = project(spark, SF_CHECK)
    summed = {r.state: r.prescriber_count for r in
              __import__("claimlake.plans.reports", fromlist=["REPORTS"]).REPORTS[
                  "report_focus_geography"](prj).collect()}
    exact = {r.state: r.prescriber_count for r in
             __import__("claimlake.plans.reports", fromlist=["REPORTS"]).REPORTS[
                 "report_focus_geography_exact"](prj).collect()}
    assert exact.keys() == summed.keys() and all(exact[k] <= summed[k] for k in exact)
