"""Intermediate models: staging rows enriched with the reference maps and unit costs.

Every map is key-checked (no fan-out) and size-checked before it is broadcast, so the
fact rows are never shuffled for these lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, ratio, surrogate_key, trim_upper
from ..operators.aggregates import percentile_tiers
from .project import Project, model


def area_map(prj: Project) -> DataFrame:
    seed = prj.raw("seed_therapeutic_area_map").select(
        trim_upper("generic_name").alias("generic_name"),
        "therapeutic_area",
        F.col("is_specialty").cast("boolean").alias("is_specialty_mapped"),
        F.col("is_focus_area").cast("boolean").alias("is_focus_mapped"))
    return prj.seed_frame("area_map", seed, ["generic_name"])


def region_map(prj: Project) -> DataFrame:
    seed = prj.raw("seed_state_region_map").select(
        "state_abbrev", "census_region", "census_division")
    return prj.seed_frame("region_map", seed, ["state_abbrev"])


@model("intermediate", grain=("drug_year", "generic_name", "brand_name", "manufacturer_name"),
       key="drug_spending_key")
def int_drug_enriched(prj: Project) -> DataFrame:
    """Drug spending with therapeutic area, specialty flag and unit costs."""
    s = prj.model("stg_drug_spending")
    m = area_map(prj)
    j = s.join(m, "generic_name", "left")
    benes, spend, claims = F.col("total_beneficiaries"), F.col("total_spending"), F.col("total_claims")
    threshold = F.lit(prj.params.specialty_cost_threshold).cast("decimal(12,2)")
    # spend / benes / 12 > threshold, compared exactly (no rounding of the monthly cost).
    by_cost = flag((benes > 0) & (spend > threshold * F.lit(12) * benes))
    per_bene = spend.cast("double") / benes.cast("double")
    out = j.select(
        *[F.col(c) for c in s.columns],
        "therapeutic_area",
        F.coalesce(F.col("is_focus_mapped"), F.lit(False)).alias("is_focus_area"),
        F.coalesce(F.col("is_specialty_mapped"), by_cost).alias("is_specialty_drug"),
        F.when(claims > 0, ratio(spend, claims, 2)).alias("cost_per_claim"),
        F.when(benes > 0, ratio(spend, benes, 2)).alias("cost_per_beneficiary"),
        F.when(benes > 0, ratio(per_bene, F.lit(12), 2)).alias("cost_per_beneficiary_monthly"),
        F.when(F.col("brand_name").isNotNull() & (F.col("brand_name") != ""), F.lit("Brand"))
        .otherwise(F.lit("Generic")).alias("brand_generic_flag"))
    key = surrogate_key("drug_year", "generic_name", "brand_name", "manufacturer_name")
    return out.select(key.alias("drug_spending_key"), *out.columns)


@model("intermediate", grain=("npi", "prescriber_year"), key="prescriber_key")
def int_prescriber_summary(prj: Project) -> DataFrame:
    """Prescribers with census region, rates and a claims-percentile engagement tier."""
    p = prj.model("stg_prescribers")
    r = region_map(prj)
    w = p.join(r, p.state == r.state_abbrev, "left").drop("state_abbrev")
    bg = F.col("brand_claims") + F.col("generic_claims")
    w = w.select(
        *[F.col(c) for c in p.columns], "census_region", "census_division",
        F.when(bg > 0, ratio("brand_claims", bg, 1, 100)).alias("brand_prescribing_rate_pct"),
        F.when(F.col("total_claims") > 0, ratio("total_drug_cost", "total_claims", 2))
        .alias("avg_cost_per_claim"),
        F.when(F.col("total_beneficiaries") > 0,
               ratio("total_claims", "total_beneficiaries", 1)).alias("claims_per_beneficiary"))
    prm = prj.params
    tiered = percentile_tiers(
        w, "total_claims", "engagement_tier",
        [("High", prm.tier_high_pct), ("Medium", prm.tier_medium_pct)], "Low",
        where=F.col("total_claims") > 0,
        by=("prescriber_year",) if prm.tiers_by_year else (),
        accuracy=prm.approx_percentile_accuracy)
    key = surrogate_key("prescriber_year", "npi")
    return tiered.select(key.alias("prescriber_key"), *tiered.columns)


@model("intermediate", grain=("prescriber_drug_year", "npi", "generic_name", "brand_name"),
       key="prescriber_drug_key")
def int_prescriber_drug_detail(prj: Project) -> DataFrame:
    """Prescriber x drug rows with therapeutic area, flags, region and unit measures."""
    pd_ = prj.model("stg_prescriber_drugs")
    m = area_map(prj)
    r = region_map(prj)
    j = (pd_.join(m, "generic_name", "left")
         .join(r, pd_.state == r.state_abbrev, "left"))
    claims = F.col("total_claims")
    out = j.select(
        *[pd_[c] for c in pd_.columns],
        "therapeutic_area",
        F.coalesce(F.col("is_specialty_mapped"), F.lit(False)).alias("is_specialty_drug"),
        F.coalesce(F.col("is_focus_mapped"), F.lit(False)).alias("is_focus_area"),
        "census_region",
        F.when(claims > 0, ratio("total_drug_cost", claims, 2)).alias("cost_per_claim"),
        F.when(claims > 0, ratio("total_day_supply", claims, 1)).alias("avg_day_supply_per_claim"))
    key = surrogate_key("prescriber_drug_year", "npi", "generic_name", "brand_name")
    return out.select(key.alias("prescriber_drug_key"), *out.columns)
