"""Mart models (17): aggregates and reports over the intermediate models.

Scale notes shared by all marts:
* every grouped measure is a sum/count with map-side partial aggregation, so a hot group
  key (for example the 'Other' area, or one year) costs the same as any other;
* ``count(distinct x)`` shuffles on (group, x), which spreads a hot group over its values;
* group totals used as denominators are pre-aggregated and broadcast (their row count is
  bounded by years x areas), instead of shuffling detail rows on the group key;
* ranking by year uses ``ranked_running_total`` (range slices + offsets), never one task
  per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, mean, ratio, ratio_or, round_to, surrogate_key
from ..operators.aggregates import (count_distinct_if, distinct_count, distinct_per_group,
                                    join_groups, percentile, percentile_cuts, sum_if, top_labels)
from ..operators.quality import anomaly_status, any_abs_above, completeness, group_zscores
from ..operators.windows import (pareto_tier, ranked_running_total, share_of_group,
                                 share_of_total)
from .project import Project, model

OTHER_AREA = "Other"


def _area_or_other() -> F.Column:
    return F.coalesce(F.col("therapeutic_area"), F.lit(OTHER_AREA)).alias("therapeutic_area")


def _suppressed_drugs(prj: Project) -> DataFrame:
    return suppressed(prj, prj.model("int_drug_enriched"))


def suppressed(prj: Project, drugs: DataFrame) -> DataFrame:
    """Row-form small-group suppression: keep rows describing >= threshold people."""
    return drugs.where(F.col("total_beneficiaries") >= F.lit(prj.params.min_beneficiaries))


def _with_key(df: DataFrame, key: str, *cols: str) -> DataFrame:
    return df.select(surrogate_key(*cols).alias(key), *df.columns)


def _distinct(prj: Project, c: str) -> F.Column:
    return distinct_count(c, prj.params.approx_distinct_rsd)


def _with_distincts(prj: Project, agg: DataFrame, d: DataFrame, keys: list[str], counted: dict[str, F.Column]) -> DataFrame:
    """``agg`` (one row per ``keys`` group of ``d``) with a distinct count of each column: two plain aggregates
    each, so that several counts do not expand the rows."""
    rsd = prj.params.approx_distinct_rsd
    for name, c in counted.items():
        rows = d.withColumn("_counted", c)
        part = (rows.groupBy(*keys).agg(distinct_count("_counted", rsd).alias(name)) if rsd
                else distinct_per_group(rows, keys, "_counted", name))
        agg = join_groups(agg, part, keys)
    return agg


def _zero() -> F.Column:
    return F.lit(0).cast("decimal(18,2)")


# --------------------------------------------------------------------------- commercial

@model("marts", "commercial", grain=("drug_year", "therapeutic_area", "is_focus_area"),
       key="spending_trend_key", owner="Commercial analytics",
       description="Spending, claims and mix by therapeutic area and year")
def mart_drug_spending_trends(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj)
    spec, brand = F.col("is_specialty_drug"), F.col("brand_generic_flag")
    agg = d.groupBy("drug_year", _area_or_other(), "is_focus_area").agg(
        _distinct(prj, "generic_name").alias("distinct_drugs"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        F.sum("total_spending").alias("total_spending"),
        mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
        mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost_per_bene"),
        sum_if(spec, "total_spending", _zero()).alias("specialty_spending"),
        sum_if(~spec, "total_spending", _zero()).alias("non_specialty_spending"),
        sum_if(brand == "Brand", "total_spending", _zero()).alias("brand_spending"),
        sum_if(brand == "Generic", "total_spending", _zero()).alias("generic_spending"))
    return spending_trends_columns(agg)


def spending_trends_columns(agg: DataFrame) -> DataFrame:
    """The mart's shares and key from its sums."""
    pos = F.col("total_spending") > 0
    out = agg.select(
        "*",
        F.when(pos, ratio("specialty_spending", "total_spending", 1, 100))
        .otherwise(F.lit(0.0)).alias("specialty_pct"),
        F.when(pos, ratio("brand_spending", "total_spending", 1, 100))
        .otherwise(F.lit(0.0)).alias("brand_pct"))
    return _with_key(out, "spending_trend_key", "drug_year", "therapeutic_area", "is_focus_area")


@model("marts", "commercial", grain=("drug_year", "therapeutic_area", "brand_generic_flag"),
       key="ta_mix_key", description="Market size and share by area and brand/generic")
def mart_therapeutic_area_mix(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj)
    agg = d.groupBy("drug_year", _area_or_other(), "brand_generic_flag").agg(
        _distinct(prj, "generic_name").alias("drug_count"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_spending").alias("total_spending"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
        mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost"))
    return area_mix_columns(agg)


def area_mix_columns(agg: DataFrame) -> DataFrame:
    """The mart's shares and key from its sums."""
    # Aggregated rows: a handful per year, so the year window is small.
    out = share_of_total(agg, "total_spending", ["drug_year"], "spending_share_pct")
    out = share_of_total(out, "total_claims", ["drug_year"], "claims_share_pct")
    return _with_key(out, "ta_mix_key", "drug_year", "therapeutic_area", "brand_generic_flag")


@model("marts", "commercial", grain=("drug_year", "generic_name", "brand_name", "manufacturer_name"),
       key="specialty_key", description="Pareto ranking of drugs by spending within a year")
def mart_specialty_vs_generic(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj).where(F.col("total_spending") > 0).select(
        "drug_year", "brand_name", "generic_name", "manufacturer_name", _area_or_other(),
        "is_specialty_drug", "brand_generic_flag", "total_claims", "total_beneficiaries",
        "total_spending", "cost_per_claim", "cost_per_beneficiary_monthly")
    order = [F.col("total_spending").desc(), F.col("generic_name").asc(),
             F.col("brand_name").asc(), F.col("manufacturer_name").asc()]
    ranked = ranked_running_total(d, ["drug_year"], order, "total_spending",
                                  "spending_rank", "_cum", "_total")
    out = ranked.select(
        *d.columns, "spending_rank",
        ratio("_cum", "_total", 2, 100).alias("cumulative_spending_pct"))
    out = out.withColumn("pareto_tier", pareto_tier("cumulative_spending_pct",
                                                    prj.params.pareto_top_pct,
                                                    prj.params.pareto_next_pct))
    return _with_key(out, "specialty_key", "drug_year", "generic_name", "brand_name",
                     "manufacturer_name")


# ------------------------------------------------------------------- customer success

@model("marts", "customer_success", grain=("npi", "prescriber_year"), key="prescriber_key",
       description="Prescriber engagement tier, brand rate, volume and risk flags")
def mart_prescriber_engagement(prj: Project) -> DataFrame:
    p = prj.model("int_prescriber_summary").where(F.col("total_claims") > 0)
    claims, opioid = F.col("total_claims"), F.col("opioid_claims")
    return p.select(
        "prescriber_key", "prescriber_year", "npi", "last_name_or_org", "first_name",
        "credentials", "specialty", "state", "city", "census_region", "engagement_tier",
        "total_claims", "total_beneficiaries", "total_drug_cost", "brand_claims",
        "generic_claims", "brand_prescribing_rate_pct", "avg_cost_per_claim",
        "claims_per_beneficiary", "opioid_claims", "antibiotic_claims", "avg_beneficiary_age",
        flag((F.col("engagement_tier") == "High") & (F.col("brand_prescribing_rate_pct") > 50))
        .alias("is_high_value_brand_prescriber"),
        # opioid / claims > 0.10, compared exactly on integers.
        flag((opioid > 0) & (claims > 0) & (opioid * 10 > claims)).alias("opioid_high_rate_flag"))


@model("marts", "customer_success",
       grain=("drug_year", "prescriber_specialty", "therapeutic_area", "is_focus_area"),
       key="adoption_key", description="Specialty drug adoption by prescriber specialty")
def mart_specialty_adoption_funnel(prj: Project) -> DataFrame:
    d = prj.model("int_prescriber_drug_detail").where(
        (F.col("total_claims") > 0) & F.col("therapeutic_area").isNotNull())
    spec = F.col("is_specialty_drug")
    d = d.withColumnsRenamed({"prescriber_drug_year": "drug_year", "specialty": "prescriber_specialty"})
    keys = ["drug_year", "prescriber_specialty", "therapeutic_area", "is_focus_area"]
    totals = ("total_claims", "total_drug_cost", "total_beneficiaries", "total_day_supply",
              "specialty_claims", "specialty_drug_cost")
    per_npi = d.groupBy(*keys, "npi").agg(
        F.max(spec).alias("_has_specialty_rx"), *[F.sum(c).alias(c) for c in totals[:4]],
        sum_if(spec, "total_claims").alias("specialty_claims"),
        sum_if(spec, "total_drug_cost", _zero()).alias("specialty_drug_cost"))
    agg = per_npi.groupBy(*keys).agg(
        F.count("npi").alias("prescriber_count"),
        F.count_if(F.col("npi").isNotNull() & F.col("_has_specialty_rx")).alias("prescribers_with_specialty_rx"),
        *[F.sum(c).alias(c) for c in totals])
    agg = join_groups(agg, distinct_per_group(d, keys, "generic_name", "distinct_drugs_prescribed"), keys)
    out = agg.select(
        "*",
        ratio_or("prescribers_with_specialty_rx", "prescriber_count", 1, 0.0, 100)
        .alias("specialty_adoption_rate_pct"),
        ratio_or("specialty_claims", "total_claims", 1, 0.0, 100).alias("specialty_claims_pct"),
        ratio("total_drug_cost", "total_claims", 2).alias("avg_cost_per_claim"))
    return _with_key(out, "adoption_key", "drug_year", "prescriber_specialty",
                     "therapeutic_area", "is_focus_area")


@model("marts", "customer_success",
       grain=("prescriber_year", "specialty", "census_region", "engagement_tier"),
       key="cohort_key", description="Prescriber volume cohorts (structure for retention)")
def mart_prescriber_retention_cohort(prj: Project) -> DataFrame:
    p = prj.model("int_prescriber_summary").where(F.col("total_claims") > 0)
    acc = prj.params.approx_percentile_accuracy
    keys = ["prescriber_year", "specialty", "census_region", "engagement_tier"]
    agg = p.groupBy(*keys).agg(
        _distinct(prj, "npi").alias("prescriber_count"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_drug_cost").alias("total_drug_cost"),
        mean("total_claims", 0).alias("avg_claims_per_prescriber"),
        mean("total_drug_cost", 2).alias("avg_cost_per_prescriber"),
        mean("brand_prescribing_rate_pct", 1).alias("avg_brand_rate_pct"),
        mean("avg_beneficiary_age", 1).alias("avg_patient_age"))
    if acc:
        cuts = p.groupBy(*keys).agg(*[percentile("total_claims", x, acc).alias(f"_p{i}") for i, x in enumerate((0.5, 0.9))])
    else:
        cuts = percentile_cuts(p, "total_claims", (0.5, 0.9), keys)
    # Interpolated percentiles, shown to 6 decimals.
    agg = (join_groups(agg, cuts, keys)
           .withColumns({"median_claims": round_to(F.col("_p0"), 6), "p90_claims": round_to(F.col("_p1"), 6)}).drop("_p0", "_p1"))
    return _with_key(agg, "cohort_key", "prescriber_year", "specialty", "census_region",
                     "engagement_tier")


# ----------------------------------------------------------------------- pharmacy ops

@model("marts", "pharmacy_ops",
       grain=("drug_year", "therapeutic_area", "is_focus_area", "is_specialty_drug",
              "brand_generic_flag"),
       key="fill_trend_key", description="Fill volume by area, specialty and brand/generic")
def mart_fill_volume_trends(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj)
    agg = d.groupBy("drug_year", _area_or_other(), "is_focus_area", "is_specialty_drug",
                    "brand_generic_flag").agg(
        _distinct(prj, "generic_name").alias("distinct_drugs"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_30day_fills").alias("total_30day_fills"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        F.sum("total_spending").alias("total_spending"),
        mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
        mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost_per_bene"),
        ratio(F.sum("total_30day_fills"), F.sum("total_beneficiaries"), 2)
        .alias("fills_per_beneficiary"))
    return _with_key(agg, "fill_trend_key", "drug_year", "therapeutic_area", "is_focus_area",
                     "is_specialty_drug", "brand_generic_flag")


@model("marts", "pharmacy_ops",
       grain=("drug_year", "generic_name", "brand_name", "manufacturer_name"),
       key="cost_claim_key", owner="Data & Analytics",
       description="Cost per claim, per beneficiary and per 30-day fill by drug")
def mart_cost_per_claim(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj).where(F.col("total_claims") > 0)
    out = d.select(
        "drug_year", "brand_name", "generic_name", _area_or_other(), "manufacturer_name",
        "is_focus_area", "is_specialty_drug", "brand_generic_flag", "total_claims",
        "total_beneficiaries", "total_spending", "total_30day_fills", "cost_per_claim",
        "cost_per_beneficiary", "cost_per_beneficiary_monthly",
        ratio("total_spending", "total_30day_fills", 2).alias("cost_per_30day_fill"),
        # On the rounded monthly cost (unlike the specialty flag, which is unrounded).
        flag(F.col("cost_per_beneficiary_monthly") > F.lit(prj.params.specialty_cost_threshold))
        .alias("exceeds_specialty_threshold"))
    return _with_key(out, "cost_claim_key", "drug_year", "generic_name", "brand_name",
                     "manufacturer_name")


@model("marts", "pharmacy_ops",
       grain=("drug_year", "generic_name", "therapeutic_area", "is_specialty_drug",
              "is_focus_area", "state", "census_region"),
       key="day_supply_key", description="Day supply per claim and cost per day of therapy")
def mart_day_supply_efficiency(prj: Project) -> DataFrame:
    d = prj.model("int_prescriber_drug_detail").where(
        (F.col("total_claims") > 0) & (F.col("total_day_supply") > 0)
        & F.col("therapeutic_area").isNotNull())
    agg = d.groupBy(F.col("prescriber_drug_year").alias("drug_year"), "generic_name",
                    "therapeutic_area", "is_specialty_drug", "is_focus_area", "state",
                    "census_region").agg(
        _distinct(prj, "npi").alias("prescriber_count"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_day_supply").alias("total_day_supply"),
        F.sum("total_drug_cost").alias("total_drug_cost"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        ratio(F.sum("total_day_supply"), F.sum("total_claims"), 1).alias("avg_day_supply_per_claim"),
        ratio(F.sum("total_drug_cost"), F.sum("total_day_supply"), 2).alias("cost_per_day_of_therapy"),
        ratio(F.sum("total_drug_cost"), F.sum("total_day_supply"), 2, 30)
        .alias("cost_per_30day_equivalent"))
    return _with_key(agg, "day_supply_key", "drug_year", "generic_name", "state")


@model("marts", "pharmacy_ops",
       grain=("drug_year", "therapeutic_area", "is_focus_area", "state", "census_region"),
       key="brand_generic_key", description="Brand vs generic dispensing by area and state")
def mart_brand_generic_ratio(prj: Project) -> DataFrame:
    d = prj.model("int_prescriber_drug_detail").where(
        (F.col("total_claims") > 0) & F.col("therapeutic_area").isNotNull())
    b, g = F.col("brand_name"), F.col("generic_name")
    is_brand = b.isNotNull() & (b != "") & (b != g)
    is_generic = b.isNull() | (b == "") | (b == g)
    agg = d.groupBy(F.col("prescriber_drug_year").alias("drug_year"), "therapeutic_area",
                    "is_focus_area", "state", "census_region").agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_drug_cost").alias("total_drug_cost"),
        sum_if(is_brand, "total_claims").alias("brand_claims"),
        sum_if(is_generic, "total_claims").alias("generic_claims"),
        sum_if(is_brand, "total_drug_cost", _zero()).alias("brand_cost"),
        sum_if(is_generic, "total_drug_cost", _zero()).alias("generic_cost"),
        _distinct(prj, "npi").alias("prescriber_count"))
    out = agg.select(
        "*",
        ratio_or("generic_claims", "total_claims", 1, 0.0, 100).alias("generic_dispensing_rate_pct"),
        ratio_or("brand_claims", "total_claims", 1, 0.0, 100).alias("brand_dispensing_rate_pct"),
        F.when(F.col("generic_cost") > 0, ratio("brand_cost", "generic_cost", 2))
        .alias("brand_to_generic_cost_ratio"))
    return _with_key(out, "brand_generic_key", "drug_year", "therapeutic_area", "state",
                     "is_focus_area")


# ------------------------------------------------------------------------- enterprise

@model("marts", "enterprise",
       grain=("drug_year", "generic_name", "brand_name", "manufacturer_name"),
       key="mfr_report_key", description="Per-manufacturer drug performance and market share")
def mart_manufacturer_performance_report(prj: Project) -> DataFrame:
    d = (_suppressed_drugs(prj).where(F.col("total_claims") > 0)
         .withColumn("therapeutic_area", _area_or_other()))
    # Area totals: partial sums per task, one row per year x area (bounded by the map).
    totals = d.groupBy("drug_year", "therapeutic_area").agg(
        F.sum("total_spending").alias("ta_total_spending"),
        F.sum("total_claims").alias("ta_total_claims"))
    j = share_of_group(d, totals, ["drug_year", "therapeutic_area"], bounded=True)
    out = j.select(
        "drug_year", "brand_name", "generic_name", "manufacturer_name", "therapeutic_area",
        "is_focus_area", "is_specialty_drug", "brand_generic_flag", "total_claims",
        "total_beneficiaries", "total_spending", "total_30day_fills", "cost_per_claim",
        "cost_per_beneficiary", "cost_per_beneficiary_monthly",
        ratio("total_spending", "ta_total_spending", 2, 100).alias("ta_spending_share_pct"),
        ratio("total_claims", "ta_total_claims", 2, 100).alias("ta_claims_share_pct"),
        "ta_total_spending", "ta_total_claims")
    return _with_key(out, "mfr_report_key", "drug_year", "generic_name", "brand_name",
                     "manufacturer_name")


@model("marts", "enterprise", grain=("drug_year", "therapeutic_area", "is_focus_area"),
       key="ta_kpi_key", description="Summary KPIs per therapeutic area for partner reporting")
def mart_therapeutic_area_kpis(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj).withColumn("therapeutic_area", _area_or_other())
    keys = ["drug_year", "therapeutic_area", "is_focus_area"]
    spend = F.sum("total_spending")
    agg = d.groupBy(*keys).agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        F.sum("total_30day_fills").alias("total_30day_fills"),
        spend.alias("total_spending"),
        mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
        mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost"),
        ratio(sum_if(F.col("is_specialty_drug"), "total_spending", _zero()), spend, 1, 100)
        .alias("specialty_spending_pct"),
        ratio(sum_if(F.col("brand_generic_flag") == "Brand", "total_spending", _zero()),
              spend, 1, 100).alias("brand_spending_pct"))
    agg = _with_distincts(prj, agg, d, keys, {
        "drug_count": F.col("generic_name"),
        "brand_count": F.when(F.col("brand_name") != "", F.col("brand_name"))})
    # Both sides are aggregates keyed by year x area x focus (bounded by the area map).
    top = top_labels(d, keys, "generic_name", "total_spending", "top_drug_by_spending")
    out = agg.join(top, keys, "left")
    return _with_key(out, "ta_kpi_key", "drug_year", "therapeutic_area", "is_focus_area")


@model("marts", "enterprise",
       grain=("drug_year", "state", "census_region", "therapeutic_area", "is_focus_area"),
       key="geo_key", description="Prescribing volume and cost by state and area")
def mart_geographic_distribution(prj: Project) -> DataFrame:
    d = geography_rows(prj.model("int_prescriber_drug_detail"))
    keys = ["drug_year", "state", "census_region", "therapeutic_area", "is_focus_area"]
    totals = ("total_claims", "total_drug_cost", "total_beneficiaries", "total_day_supply")
    agg = (d.groupBy(*keys, "npi").agg(*[F.sum(c).alias(c) for c in totals])
           .groupBy(*keys).agg(F.count("npi").alias("prescriber_count"), *[F.sum(c).alias(c) for c in totals]))
    return geography_columns(join_groups(agg, distinct_per_group(d, keys, "generic_name", "distinct_drugs"), keys))


def geography_rows(detail: DataFrame) -> DataFrame:
    """The prescriber-drug rows that the geography mart counts."""
    d = detail.where((F.col("total_claims") > 0) & F.col("state").isNotNull())
    return d.withColumn("therapeutic_area", _area_or_other()).withColumnRenamed("prescriber_drug_year", "drug_year")


def geography_columns(agg: DataFrame) -> DataFrame:
    """The mart's rates and key from its sums."""
    agg = agg.select(
        "*", ratio("total_drug_cost", "total_claims", 2).alias("avg_cost_per_claim"),
        ratio("total_drug_cost", "total_beneficiaries", 2).alias("cost_per_beneficiary"),
        ratio("total_claims", "prescriber_count", 0).alias("claims_per_prescriber"))
    return _with_key(agg, "geo_key", "drug_year", "state", "therapeutic_area", "is_focus_area")


# -------------------------------------------------------------------------- executive

@model("marts", "executive", grain=("drug_year", "therapeutic_area", "is_focus_area"),
       key="exec_summary_key", description="Drug spending joined with prescriber reach")
def mart_executive_summary(prj: Project) -> DataFrame:
    s = _suppressed_drugs(prj).groupBy("drug_year", _area_or_other(), "is_focus_area").agg(
        F.sum("total_spending").alias("total_spending"),
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        _distinct(prj, "generic_name").alias("drug_count"),
        mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
        mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost"))
    reach = ["drug_year", "therapeutic_area"]
    seen = (prj.model("int_prescriber_drug_detail")
            .where((F.col("total_claims") > 0) & F.col("therapeutic_area").isNotNull())
            .withColumnRenamed("prescriber_drug_year", "drug_year"))
    p = distinct_per_group(seen, reach, "npi", "prescriber_count").join(
        distinct_per_group(seen, reach, "state", "state_reach"), reach)
    j = s.join(p, ["drug_year", "therapeutic_area"], "left")
    out = j.select(
        "drug_year", "therapeutic_area", "is_focus_area", "drug_count", "total_spending",
        "total_claims", "total_beneficiaries", "avg_cost_per_claim", "avg_monthly_cost",
        F.coalesce(F.col("prescriber_count"), F.lit(0)).alias("prescriber_count"),
        F.coalesce(F.col("state_reach"), F.lit(0)).alias("state_reach"))
    out = share_of_total(out, "total_spending", ["drug_year"], "spending_share_pct")
    return _with_key(out, "exec_summary_key", "drug_year", "therapeutic_area", "is_focus_area")


@model("marts", "executive", grain=("drug_year",),
       description="Top-level scorecard, one row per year")
def mart_kpi_scorecard(prj: Project) -> DataFrame:
    d = _suppressed_drugs(prj)
    spend = F.sum("total_spending")
    focus = F.col("is_focus_area")
    agg = d.groupBy("drug_year").agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_beneficiaries").alias("total_beneficiaries"),
        spend.alias("total_spending"),
        mean("cost_per_claim", 2).alias("avg_cost_per_claim"),
        mean("cost_per_beneficiary_monthly", 2).alias("avg_monthly_cost_per_bene"),
        ratio(sum_if(F.col("is_specialty_drug"), "total_spending", _zero()), spend, 1, 100)
        .alias("specialty_spending_pct"),
        ratio(sum_if(F.col("brand_generic_flag") == "Brand", "total_spending", _zero()),
              spend, 1, 100).alias("brand_spending_pct"),
        sum_if(focus, "total_spending", _zero()).alias("focus_area_spending"),
        sum_if(focus, "total_claims").alias("focus_area_claims"))
    return _with_distincts(prj, agg, d, ["drug_year"], {
        "total_drugs": F.col("generic_name"), "therapeutic_area_count": F.col("therapeutic_area")})


# ----------------------------------------------------------------------- data quality

@model("marts", "data_quality", grain=("source_model", "column_name"),
       description="Percent non-null of key columns per staging model")
def mart_dq_completeness(prj: Project) -> DataFrame:
    prm = prj.params
    res = completeness(prj.model("stg_drug_spending"), "stg_drug_spending", {
        "generic_name": None,
        "brand_name": F.col("brand_name").isNotNull() & (F.col("brand_name") != ""),
        "total_spending": None, "total_claims": None, "total_beneficiaries": None,
    }).unionByName(completeness(prj.model("stg_prescribers"), "stg_prescribers", {
        "npi": None, "specialty": None, "state": None, "total_claims": None,
        "total_drug_cost": None,
    }))
    v = F.col("completeness_pct")
    return res.withColumn("status", F.when(v >= prm.completeness_pass_pct, F.lit("Pass"))
                          .when(v >= prm.completeness_warn_pct, F.lit("Warning"))
                          .otherwise(F.lit("Fail")))


@model("marts", "data_quality", grain=("drug_year", "generic_name", "brand_name"),
       description="Cost outliers: z-scores within area and year beyond the warning cut")
def mart_dq_anomalies(prj: Project) -> DataFrame:
    prm = prj.params
    d = _suppressed_drugs(prj).where(F.col("total_claims") > 0).select(
        "drug_year", "generic_name", "brand_name", _area_or_other(), "total_spending",
        "cost_per_claim", "cost_per_beneficiary_monthly", "total_claims", "total_beneficiaries")
    # Stats come from rows with a cost per claim; one small row per year x area.
    z = group_zscores(d, ["drug_year", "therapeutic_area"],
                      {"cost_per_claim": "cost_per_claim_zscore",
                       "cost_per_beneficiary_monthly": "monthly_cost_zscore"},
                      prm.anomaly_min_group, where=F.col("cost_per_claim").isNotNull(), bounded=True)
    zcols = ["cost_per_claim_zscore", "monthly_cost_zscore"]
    flagged = anomaly_status(zcols, prm.anomaly_warning_z, prm.anomaly_z)
    return (z.withColumn("anomaly_status", flagged)
            .where(any_abs_above(zcols, prm.anomaly_warning_z)))

