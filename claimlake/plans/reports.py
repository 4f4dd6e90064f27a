"""Dashboard report queries over the marts (small results; sorted for display).

``report_year`` is the latest data year (the original pages pin the release year). Every
top-k report orders by a unique key set, so its rows are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean, ratio
from .project import Project

REPORTS: dict[str, callable] = {}


def report(fn):
    REPORTS[fn.__name__] = fn
    return fn


def _year(prj: Project) -> int:
    return prj.params.prescriber_release_year


def _m(prj: Project, name: str) -> DataFrame:
    return prj.model(name)


# ------------------------------------------------------------------------- overview

@report
def report_kpi_scorecard(prj):
    return _m(prj, "mart_kpi_scorecard").orderBy("drug_year")


@report
def report_executive_summary(prj):
    return _m(prj, "mart_executive_summary").orderBy(
        "drug_year", F.col("total_spending").desc(), "therapeutic_area", "is_focus_area")


@report
def report_spending_trends(prj):
    """Used by the overview and the commercial page."""
    return _m(prj, "mart_drug_spending_trends").orderBy("drug_year", "therapeutic_area",
                                                        "is_focus_area")


def _anomaly_order():
    return [F.abs(F.col("cost_per_claim_zscore")).desc(), F.col("drug_year"),
            F.col("generic_name"), F.col("brand_name"), F.col("therapeutic_area"),
            F.col("total_spending"), F.col("cost_per_claim"),
            F.col("cost_per_beneficiary_monthly"), F.col("total_claims")]


@report
def report_top_anomalies(prj):
    return (_m(prj, "mart_dq_anomalies").where(F.col("anomaly_status") == "Anomaly")
            .orderBy(*_anomaly_order()).limit(20))


# ----------------------------------------------------------------------- commercial

@report
def report_area_mix(prj):
    return _m(prj, "mart_therapeutic_area_mix").orderBy(
        "drug_year", F.col("total_spending").desc(), "therapeutic_area", "brand_generic_flag")


@report
def report_pareto_curve(prj):
    return (_m(prj, "mart_specialty_vs_generic").where(F.col("drug_year") == _year(prj))
            .orderBy("spending_rank").limit(50))


@report
def report_top_drugs(prj):
    return (_m(prj, "mart_cost_per_claim").where(F.col("drug_year") == _year(prj))
            .select("generic_name", "brand_name", "manufacturer_name", "therapeutic_area",
                    "total_spending", "total_claims", "cost_per_claim",
                    "cost_per_beneficiary_monthly", "is_specialty_drug")
            .orderBy(F.col("total_spending").desc(), "generic_name", "brand_name",
                     "manufacturer_name").limit(25))


# ----------------------------------------------------------------- customer success

@report
def report_engagement_by_specialty_tier(prj):
    return (_m(prj, "mart_prescriber_engagement").groupBy("specialty", "engagement_tier").agg(
        F.count(F.lit(1)).alias("prescriber_count"),
        mean("total_claims", 0).alias("avg_claims"),
        mean("brand_prescribing_rate_pct", 1).alias("avg_brand_rate"),
        mean("total_drug_cost", 2).alias("avg_drug_cost"))
        .orderBy("specialty", "engagement_tier"))


@report
def report_tier_distribution(prj):
    return _m(prj, "mart_prescriber_engagement").groupBy("engagement_tier").agg(
        F.count(F.lit(1)).alias("prescriber_count"))


@report
def report_specialty_counts(prj):
    return (_m(prj, "mart_prescriber_engagement").groupBy("specialty").agg(
        F.count(F.lit(1)).alias("prescriber_count"),
        F.sum("total_claims").alias("total_claims"),
        mean("brand_prescribing_rate_pct", 1).alias("avg_brand_rate"))
        .orderBy(F.col("total_claims").desc(), "specialty"))


@report
def report_focus_adoption(prj):
    return (_m(prj, "mart_specialty_adoption_funnel").where(F.col("is_focus_area"))
            .orderBy(F.col("specialty_claims").desc(), "adoption_key"))


@report
def report_cohorts(prj):
    return _m(prj, "mart_prescriber_retention_cohort").orderBy(
        "specialty", "engagement_tier", "census_region", "prescriber_year")


# --------------------------------------------------------------------- data quality

@report
def report_completeness(prj):
    return _m(prj, "mart_dq_completeness").orderBy("source_model", "column_name")


@report
def report_anomalies(prj):
    return _m(prj, "mart_dq_anomalies").orderBy(*_anomaly_order())


@report
def report_anomaly_summary(prj):
    return _m(prj, "mart_dq_anomalies").groupBy("anomaly_status").agg(
        F.count(F.lit(1)).alias("drug_count"),
        mean(F.abs(F.col("cost_per_claim_zscore")), 2).alias("avg_zscore"))


# ----------------------------------------------------------------------- enterprise

@report
def report_area_kpis(prj):
    return (_m(prj, "mart_therapeutic_area_kpis").where(F.col("drug_year") == _year(prj))
            .orderBy(F.col("total_spending").desc(), "therapeutic_area", "is_focus_area"))


@report
def report_focus_geography(prj):
    """Re-aggregates a mart: summing prescriber_count double-counts prescribers who
    appear in several areas (kept, as on the page)."""
    return (_m(prj, "mart_geographic_distribution").where(F.col("is_focus_area"))
            .groupBy("state").agg(
                F.sum("total_claims").alias("total_claims"),
                F.sum("total_drug_cost").alias("total_drug_cost"),
                F.sum("prescriber_count").alias("prescriber_count"),
                ratio(F.sum("total_drug_cost"), F.sum("total_claims"), 2).alias("avg_cost_per_claim"))
            .orderBy(F.col("total_drug_cost").desc(), "state"))


@report
def report_focus_geography_exact(prj):
    """Exact distinct prescribers per state in focus areas, recounted from the detail
    (the summed mart column above counts a prescriber once per area)."""
    return (_m(prj, "int_prescriber_drug_detail")
            .where((F.col("total_claims") > 0) & F.col("state").isNotNull()
                   & F.col("is_focus_area"))
            .groupBy("state").agg(F.count_distinct("npi").alias("prescriber_count"))
            .orderBy(F.col("prescriber_count").desc(), "state"))


@report
def report_manufacturer_focus(prj):
    return (_m(prj, "mart_manufacturer_performance_report")
            .where((F.col("drug_year") == _year(prj)) & F.col("is_focus_area"))
            .select("generic_name", "brand_name", "manufacturer_name", "therapeutic_area",
                    "total_spending", "total_claims", "total_beneficiaries", "cost_per_claim",
                    "cost_per_beneficiary_monthly", "ta_spending_share_pct", "ta_claims_share_pct")
            .orderBy(F.col("total_spending").desc(), "generic_name", "brand_name",
                     "manufacturer_name").limit(50))


# --------------------------------------------------------------------- pharmacy ops

@report
def report_focus_fill_trends(prj):
    return (_m(prj, "mart_fill_volume_trends").where(F.col("is_focus_area"))
            .orderBy("drug_year", "therapeutic_area", "fill_trend_key"))


@report
def report_cost_per_claim_by_area(prj):
    return (_m(prj, "mart_cost_per_claim").where(F.col("therapeutic_area") != "Other")
            .groupBy("therapeutic_area", "drug_year").agg(
                F.count(F.lit(1)).alias("drug_count"),
                mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
                mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost"),
                F.sum("total_claims").alias("total_claims"),
                F.sum("total_spending").alias("total_spending"))
            .orderBy("drug_year", "therapeutic_area"))


@report
def report_day_supply_by_area(prj):
    """Mean of per-row means, as on the page (not a weighted rate)."""
    return (_m(prj, "mart_day_supply_efficiency").where(F.col("therapeutic_area") != "Other")
            .groupBy("therapeutic_area").agg(
                mean("avg_day_supply_per_claim", 1).alias("avg_day_supply"),
                mean("cost_per_day_of_therapy", 2).alias("avg_cost_per_day"),
                F.sum("total_claims").alias("total_claims"))
            .orderBy(F.col("avg_cost_per_day").desc(), "therapeutic_area"))


@report
def report_focus_brand_generic(prj):
    return (_m(prj, "mart_brand_generic_ratio").where(F.col("is_focus_area"))
            .orderBy("therapeutic_area", "state", "drug_year"))


@report
def report_brand_generic_summary(prj):
    return (_m(prj, "mart_brand_generic_ratio").where(F.col("is_focus_area"))
            .groupBy("therapeutic_area").agg(
                F.sum("total_claims").alias("total_claims"),
                ratio(F.sum("generic_claims"), F.sum("total_claims"), 1, 100).alias("generic_rate"),
                ratio(F.sum("brand_claims"), F.sum("total_claims"), 1, 100).alias("brand_rate"))
            .orderBy(F.col("generic_rate").desc(), "therapeutic_area"))


# ------------------------------------------------------------------ dashboard extracts

@report
def extract_engagement_summary(prj):
    return _m(prj, "mart_prescriber_engagement").groupBy(
        "specialty", "engagement_tier", "state", "census_region").agg(
        F.count(F.lit(1)).alias("prescriber_count"),
        F.sum("total_claims").alias("total_claims"),
        mean("total_drug_cost", 2).alias("avg_drug_cost"),
        mean("brand_prescribing_rate_pct", 1).alias("avg_brand_rate"),
        mean("avg_cost_per_claim", 2).alias("avg_cost_per_claim"),
        F.sum("opioid_claims").alias("opioid_claims"),
        F.sum("antibiotic_claims").alias("antibiotic_claims"),
        mean("avg_beneficiary_age", 1).alias("avg_patient_age"))


@report
def extract_pareto_top50(prj):
    return (_m(prj, "mart_specialty_vs_generic").where(F.col("drug_year") == _year(prj))
            .orderBy(F.col("total_spending").desc(), "generic_name", "brand_name",
                     "manufacturer_name").limit(50))
