"""Model rules on hand-written raw rows: suppression, specialty threshold, brand rules,
percentile tiers, z-score cuts, completeness statuses."""

from decimal import Decimal

from pyspark.sql import functions as F

from claimlake.params import Params
from claimlake.plans.project import Project
from claimlake.sources.fixtures import SPENDING_STUBS
from claimlake.sources.raw import RawSources

YEAR = 2023
D = Decimal
PRESC_COLS = ("prscrbr_last_org_name", "prscrbr_first_name", "prscrbr_crdntls", "prscrbr_ent_cd",
              "prscrbr_city", "tot_benes", "tot_drug_cst", "tot_30day_fills", "brnd_tot_clms",
              "gnrc_tot_clms", "brnd_tot_drug_cst", "gnrc_tot_drug_cst", "opioid_tot_clms",
              "opioid_tot_benes", "antbtc_tot_clms", "bene_avg_age", "bene_feml_cnt", "bene_male_cnt")


def _wide_row(gnrc, brnd, mftr, spend, claims, benes, years=(YEAR,)):
    row = {"brnd_name": brnd, "gnrc_name": gnrc, "mftr_name": mftr, "tot_mftr": 1}
    for y in years:
        vals = {"tot_spndng": spend, "tot_clms": claims, "tot_benes": benes, "tot_dsg_unts": 1.0,
                "avg_spnd_per_clm": None, "avg_spnd_per_bene": None,
                "avg_spnd_per_dsg_unt_wghtd": None, "outlier_flag": None}
        for s in SPENDING_STUBS:
            row[f"{s}_{y}"] = vals[s]
    return row


WIDE_SCHEMA = ("brnd_name string, gnrc_name string, mftr_name string, tot_mftr int, "
               + ", ".join(f"{s}_{YEAR} {t}" for s, t in zip(
                   SPENDING_STUBS, ["decimal(18,2)", "bigint", "bigint", "double", "double",
                                    "double", "double", "string"])))


def _project(spark, wide_rows, area_rows=(), presc_rows=None, params=None):
    cols = [c.split()[0] for c in WIDE_SCHEMA.split(", ")]
    wide = spark.createDataFrame([tuple(r[c] for c in cols) for r in wide_rows], WIDE_SCHEMA)
    area = spark.createDataFrame(list(area_rows),
                                 "generic_name string, therapeutic_area string, is_specialty boolean, is_focus_area boolean")
    region = spark.createDataFrame([("S1", "State 1", "R1", "D1")],
                                   "state_abbrev string, state_name string, census_region string, census_division string")
    presc = presc_rows if presc_rows is not None else spark.createDataFrame(
        [("1", "S1", "T", 5)], "prscrbr_npi string, prscrbr_state_abrvtn string, prscrbr_type string, tot_clms bigint")
    for c in PRESC_COLS:
        if c not in presc.columns:
            presc = presc.withColumn(c, F.lit(None).cast("string"))
    builders = {"raw_part_d_spending": lambda: wide, "seed_therapeutic_area_map": lambda: area,
                "seed_state_region_map": lambda: region, "raw_prescribers": lambda: presc}
    p = params or Params(analysis_years=(YEAR,), prescriber_release_year=YEAR)
    return Project(spark, RawSources(spark, builders), p)


def test_blank_and_null_generics_dropped_and_names_cleaned(spark):
    prj = _project(spark, [_wide_row(None, "X", "M", D("10.00"), 1, 12),
                           _wide_row("   ", "X", "M", D("10.00"), 1, 12),
                           _wide_row(" abc ", None, None, D("10.00"), 1, 12)])
    rows = prj.model("stg_drug_spending").collect()
    assert [(r.generic_name, r.brand_name, r.manufacturer_name) for r in rows] == [("ABC", "", "")]


def test_zero_claims_and_null_spending_dropped(spark):
    prj = _project(spark, [_wide_row("a", "", "M", D("10.00"), 0, 12),
                           _wide_row("b", "", "M", None, 3, 12),
                           _wide_row("c", "", "M", D("10.00"), 3, 12)])
    assert [r.generic_name for r in prj.model("stg_drug_spending").collect()] == ["C"]


def test_suppression_threshold_rows(spark):
    rows = [_wide_row(f"d{b}", "", "M", D("100.00"), 5, b) for b in (10, 11, 12)]
    rows.append(_wide_row("dnull", "", "M", D("100.00"), 5, None))
    prj = _project(spark, rows)
    kept = sorted(r.generic_name for r in prj.model("mart_cost_per_claim").collect())
    assert kept == ["D11", "D12"]


def test_specialty_threshold_unrounded_vs_rounded(spark):
    # monthly cost = spend / benes / 12 with benes = 12 -> spend / 144
    def spend(monthly):
        return D(str(monthly)) * 144

    rows = [_wide_row("m1", "", "M", spend("829.99"), 1, 12),
            _wide_row("m2", "", "M", spend("830.00"), 1, 12),
            _wide_row("m3", "", "M", D("119520.58"), 1, 12),   # 830.004..., rounds to 830.00
            _wide_row("m4", "", "M", spend("830.01"), 1, 12)]
    prj = _project(spark, rows)
    got = {r.generic_name: (r.is_specialty_drug, r.exceeds_specialty_threshold)
           for r in prj.model("mart_cost_per_claim").collect()}
    assert got == {"M1": (False, False), "M2": (False, False), "M3": (True, False),
                   "M4": (True, True)}


def test_mapped_specialty_wins_and_focus_defaults_false(spark):
    rows = [_wide_row("mapped", "", "M", D("10.00"), 1, 12),
            _wide_row("unmapped", "", "M", D("10.00"), 1, 12)]
    prj = _project(spark, rows, [("Mapped", "Alpha", True, True)])
    got = {r.generic_name: (r.therapeutic_area, r.is_specialty_drug, r.is_focus_area)
           for r in prj.model("int_drug_enriched").collect()}
    assert got == {"MAPPED": ("Alpha", True, True), "UNMAPPED": (None, False, False)}


def test_brand_flag_rules(spark):
    rows = [_wide_row("g", "", "M1", D("10.00"), 1, 12),
            _wide_row("g", "g", "M2", D("10.00"), 1, 12),
            _wide_row("g", "brand x", "M3", D("10.00"), 1, 12)]
    prj = _project(spark, rows)
    got = {r.manufacturer_name: r.brand_generic_flag for r in prj.model("int_drug_enriched").collect()}
    assert got == {"M1": "Generic", "M2": "Brand", "M3": "Brand"}


def test_zscore_cuts_and_small_groups(spark):
    # Area "A" year 2023: cost per claim values; group of 4 in area "B" has no stats.
    vals = [100] * 14 + [1000]
    rows = [_wide_row(f"a{i}", "", "M", D(v), 1, 12) for i, v in enumerate(vals)]
    rows += [_wide_row(f"b{i}", "", "M", D(v), 1, 12) for i, v in enumerate([1, 1, 1, 100])]
    area = [(f"a{i}", "A", False, False) for i in range(len(vals))]
    area += [(f"b{i}", "B", False, False) for i in range(4)]
    prj = _project(spark, rows, area)
    out = prj.model("mart_dq_anomalies").collect()
    assert [(r.generic_name, r.anomaly_status) for r in out] == [("A14", "Anomaly")]
    assert out[0].cost_per_claim_zscore == 3.61


def test_zscore_equal_values_give_zero(spark):
    rows = [_wide_row(f"e{i}", "", "M", D("50.00"), 1, 12) for i in range(5)]
    area = [(f"e{i}", "E", False, False) for i in range(5)]
    prj = _project(spark, rows, area)
    assert prj.model("mart_dq_anomalies").count() == 0


def test_completeness_status_cuts(spark):
    # 1000 rows: 10 / 11 / 50 / 51 nulls -> 99.0 Pass, 98.9 Warning, 95.0 Warning, 94.9 Fail
    for nulls, status in ((0, "Pass"), (10, "Pass"), (11, "Warning"), (50, "Warning"), (51, "Fail")):
        rows = [_wide_row(f"x{i}", "", "M", D("1.00"), 1, None if i < nulls else 12)
                for i in range(1000)]
        prj = _project(spark, rows)
        got = {r.column_name: r.status for r in prj.model("mart_dq_completeness").collect()
               if r.source_model == "stg_drug_spending"}
        assert got["total_beneficiaries"] == status, (nulls, got)


def test_pareto_ranking_ties_are_deterministic(spark):
    rows = [_wide_row("b", "", "M", D("50.00"), 1, 12), _wide_row("a", "", "M", D("50.00"), 1, 12),
            _wide_row("c", "", "M", D("100.00"), 1, 12)]
    prj = _project(spark, rows)
    got = sorted((r.spending_rank, r.generic_name, r.cumulative_spending_pct, r.pareto_tier)
                 for r in prj.model("mart_specialty_vs_generic").collect())
    assert got == [(1, "C", 50.0, "Top 80%"), (2, "A", 75.0, "Top 80%"), (3, "B", 100.0, "Long Tail")]


def test_zero_and_null_denominators(spark):
    rows = [_wide_row("z0", "", "M", D("100.00"), 4, 0), _wide_row("zn", "", "M", D("100.00"), 4, None)]
    prj = _project(spark, rows)
    got = {r.generic_name: (r.cost_per_claim, r.cost_per_beneficiary,
                            r.cost_per_beneficiary_monthly, r.is_specialty_drug)
           for r in prj.model("int_drug_enriched").collect()}
    assert got == {"Z0": (25.0, None, None, False), "ZN": (25.0, None, None, False)}


def test_completeness_of_empty_table_fails(spark):
    prj = _project(spark, [_wide_row(None, "", "M", D("1.00"), 1, 12)])  # dropped in staging
    rows = [r for r in prj.model("mart_dq_completeness").collect()
            if r.source_model == "stg_drug_spending"]
    assert rows and all(r.total_rows == 0 and r.completeness_pct is None and r.status == "Fail"
                        for r in rows)
