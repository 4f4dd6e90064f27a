"""Staging models: typed, cleaned, one row per natural grain.

Casts at the raw boundary are ``try_cast``: a malformed value becomes NULL (and is then
filtered or counted by the checks) instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, nonblank, trim_upper
from ..operators.reshape import wide_to_long
from ..sources.fixtures import SPENDING_STUBS
from .project import Project, model


def _t(c: str, typ: str):
    return F.col(c).try_cast(typ)


@model("staging", grain=("generic_name", "brand_name", "manufacturer_name", "drug_year"),
       not_null=("generic_name", "total_spending", "total_claims", "drug_year"))
def stg_drug_spending(prj: Project) -> DataFrame:
    """Drug spending, unpivoted from year-suffixed columns to one row per year."""
    raw = prj.raw("raw_part_d_spending")
    src = raw.where(F.col("gnrc_name").isNotNull() & (F.trim(F.col("gnrc_name")) != ""))
    years = [str(y) for y in prj.params.analysis_years] or None
    long = wide_to_long(src, ["brnd_name", "gnrc_name", "mftr_name", "tot_mftr"],
                        SPENDING_STUBS, "drug_year", keys=years)
    return long.select(
        trim_upper(F.coalesce(F.col("brnd_name"), F.lit(""))).alias("brand_name"),
        trim_upper(F.col("gnrc_name")).alias("generic_name"),
        F.trim(F.coalesce(F.col("mftr_name"), F.lit(""))).alias("manufacturer_name"),
        _t("tot_mftr", "int").alias("manufacturer_count"),
        F.col("drug_year").cast("int").alias("drug_year"),
        _t("tot_spndng", "decimal(18,2)").alias("total_spending"),
        _t("tot_clms", "bigint").alias("total_claims"),
        _t("tot_benes", "bigint").alias("total_beneficiaries"),
        _t("tot_dsg_unts", "decimal(18,2)").alias("total_dosage_units"),
        _t("avg_spnd_per_clm", "decimal(12,2)").alias("avg_spending_per_claim"),
        _t("avg_spnd_per_bene", "decimal(12,2)").alias("avg_spending_per_beneficiary"),
        _t("avg_spnd_per_dsg_unt_wghtd", "decimal(12,2)").alias("avg_spending_per_dosage_unit"),
        # 30-day fills are not in the spending extract; claims stand in for them.
        _t("tot_clms", "bigint").alias("total_30day_fills"),
        # Any non-blank outlier marker (even "0") marks the row.
        flag(nonblank("outlier_flag")).alias("is_outlier"),
    ).where(F.col("total_spending").isNotNull() & (F.col("total_claims") > 0))


@model("staging", grain=("npi", "prescriber_year"), not_null=("npi", "specialty", "total_claims"))
def stg_prescribers(prj: Project) -> DataFrame:
    """Prescriber summary, one row per NPI for the release year."""
    raw = prj.raw("raw_prescribers")
    return raw.where(F.col("prscrbr_npi").isNotNull()).select(
        F.substring(F.col("prscrbr_npi").cast("string"), 1, 10).alias("npi"),
        F.trim("prscrbr_last_org_name").alias("last_name_or_org"),
        F.trim(F.coalesce(F.col("prscrbr_first_name"), F.lit(""))).alias("first_name"),
        F.trim(F.coalesce(F.col("prscrbr_crdntls"), F.lit(""))).alias("credentials"),
        F.trim("prscrbr_ent_cd").alias("entity_code"),
        F.trim("prscrbr_type").alias("specialty"),
        F.trim("prscrbr_state_abrvtn").alias("state"),
        F.trim(F.coalesce(F.col("prscrbr_city"), F.lit(""))).alias("city"),
        _t("tot_clms", "bigint").alias("total_claims"),
        _t("tot_benes", "int").alias("total_beneficiaries"),
        _t("tot_drug_cst", "decimal(18,2)").alias("total_drug_cost"),
        _t("tot_30day_fills", "decimal(12,2)").alias("total_30day_fills"),
        _t("brnd_tot_clms", "bigint").alias("brand_claims"),
        _t("gnrc_tot_clms", "bigint").alias("generic_claims"),
        _t("brnd_tot_drug_cst", "decimal(18,2)").alias("brand_drug_cost"),
        _t("gnrc_tot_drug_cst", "decimal(18,2)").alias("generic_drug_cost"),
        _t("opioid_tot_clms", "bigint").alias("opioid_claims"),
        _t("opioid_tot_benes", "int").alias("opioid_beneficiaries"),
        _t("antbtc_tot_clms", "bigint").alias("antibiotic_claims"),
        _t("bene_avg_age", "decimal(5,1)").alias("avg_beneficiary_age"),
        _t("bene_feml_cnt", "int").alias("female_beneficiary_count"),
        _t("bene_male_cnt", "int").alias("male_beneficiary_count"),
        F.lit(prj.params.prescriber_release_year).cast("int").alias("prescriber_year"),
    )


@model("staging", grain=("npi", "generic_name", "brand_name", "prescriber_drug_year"),
       not_null=("npi", "generic_name", "total_claims"))
def stg_prescriber_drugs(prj: Project) -> DataFrame:
    """Prescriber x drug detail for the release year."""
    raw = prj.raw("raw_prescribers_drug")
    return raw.where(F.col("gnrc_name").isNotNull() & F.col("tot_clms").isNotNull()).select(
        F.substring(F.col("prscrbr_npi").cast("string"), 1, 10).alias("npi"),
        F.trim("prscrbr_last_org_name").alias("last_name_or_org"),
        F.trim(F.coalesce(F.col("prscrbr_first_name"), F.lit(""))).alias("first_name"),
        F.trim("prscrbr_type").alias("specialty"),
        F.trim("prscrbr_state_abrvtn").alias("state"),
        F.trim(F.coalesce(F.col("prscrbr_city"), F.lit(""))).alias("city"),
        trim_upper(F.coalesce(F.col("brnd_name"), F.lit(""))).alias("brand_name"),
        trim_upper(F.col("gnrc_name")).alias("generic_name"),
        _t("tot_clms", "bigint").alias("total_claims"),
        _t("tot_benes", "int").alias("total_beneficiaries"),
        _t("tot_day_suply", "bigint").alias("total_day_supply"),
        _t("tot_30day_fills", "decimal(12,2)").alias("total_30day_fills"),
        _t("tot_drug_cst", "decimal(18,2)").alias("total_drug_cost"),
        flag(F.col("ge65_sprsn_flag").isNotNull()
             & (F.trim(F.col("ge65_sprsn_flag")) == "*")).alias("is_ge65_suppressed"),
        F.lit(prj.params.prescriber_release_year).cast("int").alias("prescriber_drug_year"),
    )
