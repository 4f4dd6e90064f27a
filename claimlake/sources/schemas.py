"""Explicit schemas of the raw extracts and reference maps (no schema inference).

Numbers are read as text and cast in staging with ``try_cast``, so a malformed value is a
NULL the checks count rather than a failed job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import BooleanType, StringType, StructField, StructType

# Column names of the raw extracts (after name clean-up).
PRESCRIBER_COLUMNS = (
    "prscrbr_npi", "prscrbr_last_org_name", "prscrbr_first_name", "prscrbr_crdntls",
    "prscrbr_ent_cd", "prscrbr_type", "prscrbr_state_abrvtn", "prscrbr_city", "tot_clms",
    "tot_benes", "tot_drug_cst", "tot_30day_fills", "brnd_tot_clms", "gnrc_tot_clms",
    "brnd_tot_drug_cst", "gnrc_tot_drug_cst", "opioid_tot_clms", "opioid_tot_benes",
    "antbtc_tot_clms", "bene_avg_age", "bene_feml_cnt", "bene_male_cnt",
)
PRESCRIBER_DRUG_COLUMNS = (
    "prscrbr_npi", "prscrbr_last_org_name", "prscrbr_first_name", "prscrbr_type",
    "prscrbr_state_abrvtn", "prscrbr_city", "brnd_name", "gnrc_name", "tot_clms", "tot_benes",
    "tot_day_suply", "tot_30day_fills", "tot_drug_cst", "ge65_sprsn_flag",
)
SPENDING_ID_COLUMNS = ("brnd_name", "gnrc_name", "mftr_name", "tot_mftr")


def _text(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def prescribers_schema() -> StructType:
    return _text(PRESCRIBER_COLUMNS)


def prescriber_drugs_schema() -> StructType:
    return _text(PRESCRIBER_DRUG_COLUMNS)


def spending_schema(years: Sequence[int], stubs: Sequence[str]) -> StructType:
    """Wide spending extract: id columns then ``{stub}_{year}`` for each year."""
    return _text(list(SPENDING_ID_COLUMNS) + [f"{s}_{y}" for y in years for s in stubs])


def area_map_schema() -> StructType:
    return StructType([StructField("generic_name", StringType()),
                       StructField("therapeutic_area", StringType()),
                       StructField("is_specialty", BooleanType()),
                       StructField("is_focus_area", BooleanType())])


def region_map_schema() -> StructType:
    return _text(("state_abbrev", "state_name", "census_region", "census_division"))


# Types that staging casts the text columns to; what does not cast is counted at ingest.
_MONEY, _RATE = "decimal(18,2)", "decimal(12,2)"
PRESCRIBER_CASTS = {
    "tot_clms": "bigint", "tot_benes": "int", "tot_drug_cst": _MONEY, "tot_30day_fills": _RATE,
    "brnd_tot_clms": "bigint", "gnrc_tot_clms": "bigint", "brnd_tot_drug_cst": _MONEY, "gnrc_tot_drug_cst": _MONEY,
    "opioid_tot_clms": "bigint", "opioid_tot_benes": "int", "antbtc_tot_clms": "bigint",
    "bene_avg_age": "decimal(5,1)", "bene_feml_cnt": "int", "bene_male_cnt": "int",
}
PRESCRIBER_DRUG_CASTS = {
    "tot_clms": "bigint", "tot_benes": "int", "tot_day_suply": "bigint", "tot_30day_fills": _RATE, "tot_drug_cst": _MONEY,
}
SPENDING_CASTS = {
    "tot_spndng": _MONEY, "tot_clms": "bigint", "tot_benes": "bigint", "tot_dsg_unts": _MONEY,
    "avg_spnd_per_clm": _RATE, "avg_spnd_per_bene": _RATE, "avg_spnd_per_dsg_unt_wghtd": _RATE,
}


def casts(name: str, schema: StructType) -> dict[str, str]:
    """Column -> type of every column of an input that is cast from text."""
    out = {f.name: f.dataType.simpleString() for f in schema.fields if f.dataType != StringType()}
    if name == "raw_part_d_spending":
        return out | {"tot_mftr": "int"} | {f.name: SPENDING_CASTS[f.name[:-5]] for f in schema.fields if f.name[:-5] in SPENDING_CASTS}
    return out | {"raw_prescribers": PRESCRIBER_CASTS, "raw_prescribers_drug": PRESCRIBER_DRUG_CASTS}.get(name, {})
