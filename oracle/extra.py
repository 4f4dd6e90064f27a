"""Oracle statements for inputs, operators, checks, history, governance, explores, reports."""

from __future__ import annotations

import re

from .base import BASE_CTES, MEAN, R, SK, YEARS, with_base
from .sql import BODIES, _replace

REPORT_YEAR = 2001
EXTRA: dict[str, str] = {}


def q(name: str, body: str, marts=(), doubles=(), bigints=()) -> None:
    """Statement = shared CTEs + the marts it reads (as CTEs) + pinned-type select."""
    ctes = "".join(f"{m} AS ({BODIES[m]}),\n" for m in marts)
    EXTRA[name] = with_base(f"{ctes}{name}__out AS ({body})\n"
                            + _replace(f"SELECT * FROM {name}__out", doubles, bigints))


# ------------------------------------------------------------------- inputs and ingest

q("raw_part_d_spending", "SELECT * FROM raw_part_d_spending",
  doubles=[f"tot_spndng_{y}" for y in YEARS])

_PRESC_COLS = """prscrbr_npi, prscrbr_last_org_name, prscrbr_first_name, prscrbr_crdntls,
    prscrbr_ent_cd, prscrbr_type, prscrbr_state_abrvtn, prscrbr_city, tot_clms, tot_benes,
    tot_drug_cst, tot_30day_fills, brnd_tot_clms, gnrc_tot_clms, brnd_tot_drug_cst,
    gnrc_tot_drug_cst, opioid_tot_clms, opioid_tot_benes, antbtc_tot_clms, bene_avg_age,
    bene_feml_cnt, bene_male_cnt"""
_PRESC_D = ("tot_drug_cst", "brnd_tot_drug_cst", "gnrc_tot_drug_cst")

q("raw_prescribers", f"SELECT {_PRESC_COLS} FROM raw_prescribers", doubles=_PRESC_D)
q("raw_prescribers_drug", "SELECT * FROM raw_prescribers_drug", doubles=("tot_drug_cst",))
q("seed_therapeutic_area_map", "SELECT * FROM seed_therapeutic_area_map")
q("seed_state_region_map", "SELECT * FROM seed_state_region_map")

q("ingest_prescribers_by_specialty", f"""
    SELECT {_PRESC_COLS} FROM raw_prescribers
    WHERE prscrbr_type IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')""", doubles=_PRESC_D)

q("ingest_prescriber_drugs_in_map", """
    SELECT * FROM raw_prescribers_drug
    WHERE upper(trim(gnrc_name)) IN
          (SELECT upper(trim(generic_name)) FROM seed_therapeutic_area_map)""",
  doubles=("tot_drug_cst",))

_CAST_COLUMNS = ("malformed row", "tot_clms", "tot_benes", "tot_drug_cst", "tot_30day_fills", "brnd_tot_clms", "gnrc_tot_clms",
                 "brnd_tot_drug_cst", "gnrc_tot_drug_cst", "opioid_tot_clms", "opioid_tot_benes", "antbtc_tot_clms",
                 "bene_avg_age", "bene_feml_cnt", "bene_male_cnt")
q("ingest_rejected_casts", f"""
    WITH bad AS (SELECT count(*) AS n FROM raw_prescribers WHERE CAST(prscrbr_npi AS VARCHAR) LIKE '%7' AND tot_clms IS NOT NULL),
    c AS (SELECT unnest([{', '.join(repr(c) for c in _CAST_COLUMNS)}]) AS column_name)
    SELECT column_name, CAST(CASE WHEN column_name = 'tot_clms' THEN n ELSE 0 END AS BIGINT) AS violations,
           CASE WHEN column_name = 'tot_clms' AND n > 0 THEN 'warn' ELSE 'pass' END AS status,
           CAST(CASE WHEN column_name = 'tot_clms' THEN n ELSE 0 END AS BIGINT) AS listed
    FROM c, bad""")

# ------------------------------------------------------------------- generic operators

q("suppressed_cells_drug_spending", """
    SELECT drug_spending_key, drug_year, generic_name, brand_name, manufacturer_name,
           CASE WHEN total_beneficiaries < 11 THEN NULL ELSE total_beneficiaries END
                AS total_beneficiaries,
           CASE WHEN total_claims < 11 THEN NULL ELSE total_claims END AS total_claims
    FROM int_drug_enriched""")

q("spending_trends_yoy", f"""
    SELECT drug_year, therapeutic_area, is_focus_area, total_spending, prev_year_spending,
           {R('total_spending - prev_year_spending', 'prev_year_spending', 1, '100')} AS yoy_change_pct
    FROM (
        SELECT drug_year, therapeutic_area, is_focus_area, total_spending,
               CASE WHEN lag(drug_year) OVER w = drug_year - 1
                    THEN lag(total_spending) OVER w END AS prev_year_spending
        FROM mart_drug_spending_trends
        WINDOW w AS (PARTITION BY therapeutic_area, is_focus_area ORDER BY drug_year)
    ) t""", marts=("mart_drug_spending_trends",),
  doubles=("total_spending", "prev_year_spending"))

# ------------------------------------------------------------------------------ checks


def _check_row(name, model, column, violations_sql, severity="error"):
    bad = "'warn'" if severity == "warn" else "'fail'"
    col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{name}' AS check_name, '{model}' AS model, {col} AS column_name, "
            f"CAST(v AS BIGINT) AS violations, '{severity}' AS severity, "
            f"CASE WHEN v = 0 THEN 'pass' ELSE {bad} END AS status "
            f"FROM ({violations_sql}) x")


def _not_null(model, column):
    return _check_row(f"not_null_{model}_{column}", model, column,
                      f"SELECT count(*) FILTER (WHERE {column} IS NULL) AS v FROM {model}")


def _unique(model, column):
    return _check_row(f"unique_{model}_{column}", model, column,
                      f"SELECT count(*) AS v FROM (SELECT {column} FROM {model} "
                      f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d")


def _accepted(model, column, values):
    vals = ", ".join(str(v) for v in values)
    return _check_row(f"accepted_values_{model}_{column}", model, column,
                      f"SELECT count(*) FILTER (WHERE {column} IS NOT NULL "
                      f"AND {column} NOT IN ({vals})) AS v FROM {model}")


_STG_CHECKS = [
    _not_null("stg_drug_spending", "generic_name"),
    _not_null("stg_drug_spending", "total_spending"),
    _not_null("stg_drug_spending", "total_claims"),
    _not_null("stg_drug_spending", "drug_year"),
    _accepted("stg_drug_spending", "drug_year", YEARS),
    _not_null("stg_prescribers", "npi"),
    _unique("stg_prescribers", "npi"),
    _not_null("stg_prescribers", "specialty"),
    _not_null("stg_prescribers", "total_claims"),
    _not_null("stg_prescriber_drugs", "npi"),
    _not_null("stg_prescriber_drugs", "generic_name"),
    _not_null("stg_prescriber_drugs", "total_claims"),
]
q("checks_staging", "\n    UNION ALL ".join(_STG_CHECKS))

_MART_KEYS = {
    "mart_drug_spending_trends": "spending_trend_key",
    "mart_therapeutic_area_mix": "ta_mix_key",
    "mart_specialty_vs_generic": "specialty_key",
    "mart_prescriber_engagement": "prescriber_key",
    "mart_specialty_adoption_funnel": "adoption_key",
    "mart_prescriber_retention_cohort": "cohort_key",
    "mart_fill_volume_trends": "fill_trend_key",
    "mart_cost_per_claim": "cost_claim_key",
    "mart_day_supply_efficiency": "day_supply_key",
    "mart_brand_generic_ratio": "brand_generic_key",
    "mart_manufacturer_performance_report": "mfr_report_key",
    "mart_therapeutic_area_kpis": "ta_kpi_key",
    "mart_geographic_distribution": "geo_key",
    "mart_kpi_scorecard": "drug_year",
    "mart_executive_summary": "exec_summary_key",
}
_MART_NN = [("mart_drug_spending_trends", "total_spending"),
            ("mart_specialty_vs_generic", "spending_rank"),
            ("mart_prescriber_engagement", "npi"),
            ("mart_cost_per_claim", "cost_per_claim")]
_mart_checks = []
for _m, _k in _MART_KEYS.items():
    _mart_checks += [_unique(_m, _k), _not_null(_m, _k)]
    _mart_checks += [_not_null(m, c) for m, c in _MART_NN if m == _m]
q("checks_marts", "\n    UNION ALL ".join(_mart_checks), marts=tuple(_MART_KEYS))

_NEG = "SELECT generic_name, brand_name, total_spending FROM stg_drug_spending WHERE total_spending < 0"
_BGS = """SELECT npi, total_claims, brand_claims, generic_claims,
           (brand_claims + generic_claims) AS computed_total,
           abs(total_claims - (brand_claims + generic_claims)) AS diff
    FROM stg_prescribers
    WHERE total_claims > 100 AND brand_claims IS NOT NULL AND generic_claims IS NOT NULL
      AND CAST(abs(total_claims - (brand_claims + generic_claims)) AS DOUBLE) / total_claims > 0.20"""
q("check_negative_spending", _NEG, doubles=("total_spending",))
q("check_brand_generic_sum", _BGS)
q("checks_custom", _check_row("assert_no_negative_spending", "stg_drug_spending", None,
                              f"SELECT count(*) AS v FROM ({_NEG}) a")
  + "\n    UNION ALL " + _check_row("assert_brand_generic_sum", "stg_prescribers", None,
                                    f"SELECT count(*) AS v FROM ({_BGS}) b", "warn"))

# ----------------------------------------------------------------------------- history

_SNAP_COLS = """generic_name, brand_name, manufacturer_name, drug_year, total_claims,
    total_beneficiaries, total_spending, avg_spending_per_claim, avg_spending_per_beneficiary"""
_T1, _T2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2025-01-01 00:00:00'"
_KEYS = ("generic_name", "brand_name", "manufacturer_name", "drug_year")
_ON = " AND ".join(f"h.{k} = c.{k}" for k in _KEYS)
_SAME = " AND ".join(f"h.{c} IS NOT DISTINCT FROM c.{c}" for c in
                     ("avg_spending_per_claim", "avg_spending_per_beneficiary", "total_spending"))
_HCOLS = ", ".join(f"h.{c.strip()}" for c in _SNAP_COLS.split(","))
_CCOLS = ", ".join(f"c.{c.strip()}" for c in _SNAP_COLS.split(","))


def _sk_ts(prefix: str, ts: str) -> str:
    return SK(*[f"{prefix}{k}" for k in _KEYS], ts)


# The staged spending of the orders up to a day: the same statements over fewer orders, under other names.
_STEPS = BASE_CTES[:BASE_CTES.index("cust AS (")].rstrip().rstrip(",")
_EARLY = re.sub(r"\b(lines|spend_lines|spend_long2?|spend_wide0|raw_part_d_spending|spend_src|spend_unpivoted|stg_drug_spending)\b",
                r"\1_early", _STEPS).replace(
    "ON l.l_orderkey = o.o_orderkey", "ON l.l_orderkey = o.o_orderkey WHERE o.o_orderdate <= DATE '1997-06-30'", 1)


_SNAPSHOT = f"""
    WITH {_EARLY},
    load1 AS (SELECT {_SNAP_COLS} FROM stg_drug_spending_early),
    load2 AS (SELECT {_SNAP_COLS} FROM stg_drug_spending),
    h1 AS (
        SELECT l.*, {_sk_ts('l.', _T1)} AS scd_id, {_T1} AS updated_at, {_T1} AS valid_from,
               CAST(NULL AS TIMESTAMP) AS valid_to
        FROM load1 l)
    SELECT h.* FROM h1 h LEFT JOIN load2 c ON {_ON}
    WHERE c.generic_name IS NULL OR ({_SAME})
    UNION ALL
    SELECT {_HCOLS}, h.scd_id, h.updated_at, h.valid_from, {_T2} AS valid_to
    FROM h1 h JOIN load2 c ON {_ON} WHERE NOT ({_SAME})
    UNION ALL
    SELECT {_CCOLS}, {_sk_ts('c.', _T2)}, {_T2}, {_T2}, CAST(NULL AS TIMESTAMP)
    FROM load2 c LEFT JOIN h1 h ON {_ON}
    WHERE h.generic_name IS NULL OR NOT ({_SAME})"""
_SNAP_D = ("total_spending", "avg_spending_per_claim", "avg_spending_per_beneficiary")
_TS_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("updated_at", "valid_from", "valid_to"))
q("snapshot_drug_spending", f"SELECT * REPLACE ({_TS_TEXT}) FROM ({_SNAPSHOT}) s",
  doubles=_SNAP_D)
q("snapshot_drug_spending_merged", f"SELECT * REPLACE ({_TS_TEXT}) FROM ({_SNAPSHOT}) s", doubles=_SNAP_D)
q("snapshot_drug_spending_as_of", f"""
    SELECT * REPLACE ({_TS_TEXT}) FROM ({_SNAPSHOT}) s
    WHERE valid_from <= TIMESTAMP '2024-06-30 00:00:00'
      AND (valid_to IS NULL OR TIMESTAMP '2024-06-30 00:00:00' < valid_to)""", doubles=_SNAP_D)

# -------------------------------------------------------------------------- governance

q("partner_area_report", """
    SELECT drug_year, therapeutic_area, brand_generic_flag, count(*) AS row_count,
           sum(total_claims) AS total_claims, sum(total_spending) AS total_spending
    FROM mart_manufacturer_performance_report
    WHERE therapeutic_area IN (SELECT ta FROM (VALUES ('A', 'Alpha'), ('A', 'Beta'), ('B', 'Gamma'))
                               AS pa(partner_id, ta) WHERE partner_id = 'A')
    GROUP BY 1, 2, 3 HAVING sum(total_beneficiaries) >= 11""", marts=("mart_manufacturer_performance_report",),
  doubles=("total_spending",), bigints=("total_claims",))

q("partner_area_kpis", """
    SELECT * EXCLUDE (top_drug_by_spending) FROM mart_therapeutic_area_kpis
    WHERE therapeutic_area IN (SELECT ta FROM (VALUES ('A', 'Alpha'), ('A', 'Beta'), ('B', 'Gamma'))
                               AS pa(partner_id, ta) WHERE partner_id = 'B')""",
  marts=("mart_therapeutic_area_kpis",), doubles=("total_spending",),
  bigints=("total_claims", "total_beneficiaries", "total_30day_fills"))

q("engagement_without_pii", """
    SELECT * EXCLUDE (npi, last_name_or_org, first_name, credentials, prescriber_key)
    FROM mart_prescriber_engagement""", marts=("mart_prescriber_engagement",),
  doubles=("total_drug_cost", "avg_beneficiary_age"))

_MASK = ("regexp_replace(regexp_replace(regexp_replace(last_name_or_org, '[A-Z]', 'X', 'g'), "
         "'[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')")
q("engagement_pii_protected", f"""
    SELECT sha256('claimlake' || npi) AS npi, {_MASK} AS last_name_or_org, specialty, state,
           engagement_tier, total_claims
    FROM mart_prescriber_engagement""", marts=("mart_prescriber_engagement",))

q("engagement_for_region_group", """
    SELECT * FROM mart_prescriber_engagement
    WHERE state IN (SELECT state_abbrev FROM seed_state_region_map WHERE census_region = 'AMERICA')""",
  marts=("mart_prescriber_engagement",), doubles=("total_drug_cost", "avg_beneficiary_age"))

q("retained_spending_trends", f"""
    SELECT * FROM mart_drug_spending_trends WHERE drug_year >= {REPORT_YEAR} - 5""",
  marts=("mart_drug_spending_trends",),
  doubles=("total_spending", "specialty_spending", "non_specialty_spending", "brand_spending",
           "generic_spending"), bigints=("total_claims", "total_beneficiaries"))

# ---------------------------------------------------------------------- semantic layer

q("explore_drug_spending", f"""
    SELECT d.*, k.ta_total_spending, k.ta_drug_count, k.ta_specialty_spending_pct
    FROM (
        SELECT drug_year, therapeutic_area, sum(total_spending) AS total_spending,
               sum(total_claims) AS total_claims,
               {MEAN('cost_per_claim', 2)} AS avg_cost_per_claim,
               {MEAN('cost_per_beneficiary_monthly', 2)} AS avg_monthly_cost,
               count(DISTINCT generic_name) AS unique_drugs
        FROM mart_cost_per_claim GROUP BY 1, 2
    ) d LEFT JOIN (
        SELECT drug_year, therapeutic_area, sum(total_spending) AS ta_total_spending,
               sum(drug_count) AS ta_drug_count,
               {MEAN('specialty_spending_pct', 1)} AS ta_specialty_spending_pct
        FROM mart_therapeutic_area_kpis GROUP BY 1, 2
    ) k ON d.drug_year = k.drug_year AND d.therapeutic_area = k.therapeutic_area""",
  marts=("mart_cost_per_claim", "mart_therapeutic_area_kpis"),
  doubles=("total_spending", "ta_total_spending"), bigints=("total_claims", "ta_drug_count"))

q("explore_prescriber_geography", f"""
    SELECT p.*, g.geo_total_drug_cost, g.geo_prescriber_count
    FROM (
        SELECT prescriber_year, state, engagement_tier, count(DISTINCT npi) AS prescriber_count,
               {MEAN('brand_prescribing_rate_pct', 1)} AS avg_brand_rate
        FROM mart_prescriber_engagement GROUP BY 1, 2, 3
    ) p LEFT JOIN (
        SELECT drug_year, state, sum(total_drug_cost) AS geo_total_drug_cost,
               sum(prescriber_count) AS geo_prescriber_count
        FROM mart_geographic_distribution GROUP BY 1, 2
    ) g ON p.prescriber_year = g.drug_year AND p.state = g.state""",
  marts=("mart_prescriber_engagement", "mart_geographic_distribution"),
  doubles=("geo_total_drug_cost",), bigints=("geo_prescriber_count",))

q("bi_drug_spending_source", f"""
    SELECT cost_claim_key, generic_name, therapeutic_area, total_spending,
           cost_per_beneficiary_monthly,
           CASE WHEN is_specialty_drug THEN 'Specialty' ELSE 'Non-Specialty' END
                AS specialty_flag_label,
           CASE WHEN cost_per_beneficiary_monthly > 830 THEN 'High Cost'
                WHEN cost_per_beneficiary_monthly > 100 THEN 'Moderate'
                ELSE 'Low Cost' END AS cost_tier,
           CASE WHEN cost_per_beneficiary_monthly IS NULL THEN NULL
                WHEN cost_per_beneficiary_monthly < 0 THEN 0
                WHEN cost_per_beneficiary_monthly >= 2500 THEN 11
                ELSE CAST(floor(10 * (cost_per_beneficiary_monthly - 0.0) / (2500.0 - 0.0)) AS BIGINT) + 1
           END AS cost_bucket
    FROM mart_cost_per_claim
    WHERE drug_year = {REPORT_YEAR} AND total_beneficiaries >= 11""",
  marts=("mart_cost_per_claim",), doubles=("total_spending",), bigints=("cost_bucket",))

q("bi_prescriber_engagement_source", """
    SELECT prescriber_key, npi, specialty, state, engagement_tier, total_claims,
           CASE engagement_tier WHEN 'High' THEN '#059669' WHEN 'Medium' THEN '#D97706'
                ELSE '#DC2626' END AS engagement_color
    FROM mart_prescriber_engagement""", marts=("mart_prescriber_engagement",))

q("bi_geographic_source", """
    SELECT geo_key, drug_year, state, therapeutic_area, cost_per_beneficiary,
           CASE WHEN cost_per_beneficiary IS NULL THEN NULL
                WHEN cost_per_beneficiary < r.lo THEN 0
                WHEN cost_per_beneficiary >= r.hi THEN 11
                ELSE CAST(floor(10 * (cost_per_beneficiary - r.lo) / (r.hi - r.lo)) AS BIGINT) + 1
           END AS cost_per_bene_bucket
    FROM mart_geographic_distribution,
         (SELECT min(cost_per_beneficiary) AS lo, max(cost_per_beneficiary) AS hi
          FROM mart_geographic_distribution) r""",
  marts=("mart_geographic_distribution",), bigints=("cost_per_bene_bucket",))

q("bi_pharmacy_operations_source", "SELECT * FROM mart_fill_volume_trends WHERE is_focus_area",
  marts=("mart_fill_volume_trends",), doubles=("total_spending",),
  bigints=("total_claims", "total_30day_fills", "total_beneficiaries"))

q("bi_executive_source", "SELECT * FROM mart_executive_summary", marts=("mart_executive_summary",),
  doubles=("total_spending",), bigints=("total_claims", "total_beneficiaries"))

q("kpis_by_area", f"""
    SELECT drug_year, therapeutic_area, {R('sum(total_spending)', 'sum(total_claims)', 2)} AS cost_per_claim,
           {R('sum(total_spending)', '(12 * sum(total_beneficiaries))', 2)} AS cost_per_beneficiary_per_month,
           sum(total_claims) AS total_claims
    FROM mart_cost_per_claim GROUP BY ALL""", marts=("mart_cost_per_claim",), bigints=("total_claims",))

q("kpis_dispensing_by_state", f"""
    SELECT drug_year, state, {R('sum(generic_claims)', 'sum(total_claims)', 1, '100')} AS generic_dispensing_rate
    FROM mart_brand_generic_ratio GROUP BY ALL""", marts=("mart_brand_generic_ratio",))

q("measures_drug_by_flag", f"""
    SELECT drug_year, is_specialty_drug, sum(total_spending) AS total_spending,
           sum(total_claims) AS total_claims,
           {MEAN('cost_per_claim', 2)} AS avg_cost_per_claim,
           {MEAN('cost_per_beneficiary_monthly', 2)} AS avg_monthly_cost,
           count(DISTINCT generic_name) AS unique_drugs
    FROM mart_cost_per_claim WHERE brand_generic_flag = 'Brand' GROUP BY 1, 2""",
  marts=("mart_cost_per_claim",), doubles=("total_spending",), bigints=("total_claims",))

# ----------------------------------------------------------------------------- reports

_TRENDS_D = ("total_spending", "specialty_spending", "non_specialty_spending", "brand_spending",
             "generic_spending")
_TRENDS_B = ("total_claims", "total_beneficiaries")

q("report_kpi_scorecard", "SELECT * FROM mart_kpi_scorecard", marts=("mart_kpi_scorecard",),
  doubles=("total_spending", "focus_area_spending"),
  bigints=("total_claims", "total_beneficiaries", "focus_area_claims"))
q("report_executive_summary", "SELECT * FROM mart_executive_summary",
  marts=("mart_executive_summary",), doubles=("total_spending",),
  bigints=("total_claims", "total_beneficiaries"))
q("report_spending_trends", "SELECT * FROM mart_drug_spending_trends",
  marts=("mart_drug_spending_trends",), doubles=_TRENDS_D, bigints=_TRENDS_B)

_ANOM_ORDER = """abs(cost_per_claim_zscore) DESC, drug_year, generic_name, brand_name,
    therapeutic_area, total_spending, cost_per_claim, cost_per_beneficiary_monthly, total_claims"""
q("report_top_anomalies", f"""
    SELECT * FROM mart_dq_anomalies WHERE anomaly_status = 'Anomaly'
    ORDER BY {_ANOM_ORDER} LIMIT 20""", marts=("mart_dq_anomalies",), doubles=("total_spending",))
q("report_area_mix", "SELECT * FROM mart_therapeutic_area_mix",
  marts=("mart_therapeutic_area_mix",), doubles=("total_spending",),
  bigints=("total_claims", "total_beneficiaries"))
q("report_pareto_curve", f"""
    SELECT * FROM mart_specialty_vs_generic WHERE drug_year = {REPORT_YEAR}
    ORDER BY spending_rank LIMIT 50""", marts=("mart_specialty_vs_generic",),
  doubles=("total_spending",))
q("report_top_drugs", f"""
    SELECT generic_name, brand_name, manufacturer_name, therapeutic_area, total_spending,
           total_claims, cost_per_claim, cost_per_beneficiary_monthly, is_specialty_drug
    FROM mart_cost_per_claim WHERE drug_year = {REPORT_YEAR}
    ORDER BY total_spending DESC, generic_name, brand_name, manufacturer_name LIMIT 25""",
  marts=("mart_cost_per_claim",), doubles=("total_spending",))
q("report_engagement_by_specialty_tier", f"""
    SELECT specialty, engagement_tier, count(*) AS prescriber_count,
           {MEAN('total_claims', 0)} AS avg_claims,
           {MEAN('brand_prescribing_rate_pct', 1)} AS avg_brand_rate,
           {MEAN('total_drug_cost', 2)} AS avg_drug_cost
    FROM mart_prescriber_engagement GROUP BY 1, 2""", marts=("mart_prescriber_engagement",))
q("report_tier_distribution", """
    SELECT engagement_tier, count(*) AS prescriber_count
    FROM mart_prescriber_engagement GROUP BY 1""", marts=("mart_prescriber_engagement",))
q("report_specialty_counts", f"""
    SELECT specialty, count(*) AS prescriber_count, sum(total_claims) AS total_claims,
           {MEAN('brand_prescribing_rate_pct', 1)} AS avg_brand_rate
    FROM mart_prescriber_engagement GROUP BY 1""", marts=("mart_prescriber_engagement",),
  bigints=("total_claims",))
q("report_focus_adoption", "SELECT * FROM mart_specialty_adoption_funnel WHERE is_focus_area = true",
  marts=("mart_specialty_adoption_funnel",), doubles=("total_drug_cost", "specialty_drug_cost"),
  bigints=("total_claims", "total_beneficiaries", "total_day_supply", "specialty_claims"))
q("report_cohorts", "SELECT * FROM mart_prescriber_retention_cohort",
  marts=("mart_prescriber_retention_cohort",), doubles=("total_drug_cost",),
  bigints=("total_claims",))
q("report_completeness", "SELECT * FROM mart_dq_completeness", marts=("mart_dq_completeness",))
q("report_anomalies", "SELECT * FROM mart_dq_anomalies", marts=("mart_dq_anomalies",),
  doubles=("total_spending",))
q("report_anomaly_summary", f"""
    SELECT anomaly_status, count(*) AS drug_count,
           {MEAN('abs(cost_per_claim_zscore)', 2)} AS avg_zscore
    FROM mart_dq_anomalies GROUP BY 1""", marts=("mart_dq_anomalies",))
q("report_area_kpis", f"SELECT * FROM mart_therapeutic_area_kpis WHERE drug_year = {REPORT_YEAR}",
  marts=("mart_therapeutic_area_kpis",), doubles=("total_spending",),
  bigints=("total_claims", "total_beneficiaries", "total_30day_fills"))
q("report_focus_geography", f"""
    SELECT state, sum(total_claims) AS total_claims, sum(total_drug_cost) AS total_drug_cost,
           sum(prescriber_count) AS prescriber_count,
           {R('sum(total_drug_cost)', 'sum(total_claims)', 2)} AS avg_cost_per_claim
    FROM mart_geographic_distribution WHERE is_focus_area = true GROUP BY 1""",
  marts=("mart_geographic_distribution",), doubles=("total_drug_cost",),
  bigints=("total_claims", "prescriber_count"))
# Sketches of this few values are exact; the error of large ones is tested against its bound.
q("focus_geography_from_sketches", """
    SELECT state, count(DISTINCT npi) AS prescriber_count FROM int_prescriber_drug_detail
    WHERE total_claims > 0 AND state IS NOT NULL AND is_focus_area GROUP BY state""")
q("report_focus_geography_exact", """
    SELECT state, count(DISTINCT npi) AS prescriber_count
    FROM int_prescriber_drug_detail
    WHERE total_claims > 0 AND state IS NOT NULL AND is_focus_area = true
    GROUP BY 1""")
q("report_manufacturer_focus", f"""
    SELECT generic_name, brand_name, manufacturer_name, therapeutic_area, total_spending,
           total_claims, total_beneficiaries, cost_per_claim, cost_per_beneficiary_monthly,
           ta_spending_share_pct, ta_claims_share_pct
    FROM mart_manufacturer_performance_report
    WHERE drug_year = {REPORT_YEAR} AND is_focus_area = true
    ORDER BY total_spending DESC, generic_name, brand_name, manufacturer_name LIMIT 50""",
  marts=("mart_manufacturer_performance_report",), doubles=("total_spending",))
q("report_focus_fill_trends", "SELECT * FROM mart_fill_volume_trends WHERE is_focus_area = true",
  marts=("mart_fill_volume_trends",), doubles=("total_spending",),
  bigints=("total_claims", "total_30day_fills", "total_beneficiaries"))
q("report_cost_per_claim_by_area", f"""
    SELECT therapeutic_area, drug_year, count(*) AS drug_count,
           {MEAN('cost_per_claim', 2)} AS avg_cost_per_claim,
           {MEAN('cost_per_beneficiary_monthly', 2)} AS avg_monthly_cost,
           sum(total_claims) AS total_claims, sum(total_spending) AS total_spending
    FROM mart_cost_per_claim WHERE therapeutic_area != 'Other' GROUP BY 1, 2""",
  marts=("mart_cost_per_claim",), doubles=("total_spending",), bigints=("total_claims",))
q("report_day_supply_by_area", f"""
    SELECT therapeutic_area, {MEAN('avg_day_supply_per_claim', 1)} AS avg_day_supply,
           {MEAN('cost_per_day_of_therapy', 2)} AS avg_cost_per_day,
           sum(total_claims) AS total_claims
    FROM mart_day_supply_efficiency WHERE therapeutic_area != 'Other' GROUP BY 1""",
  marts=("mart_day_supply_efficiency",), bigints=("total_claims",))
q("report_focus_brand_generic", "SELECT * FROM mart_brand_generic_ratio WHERE is_focus_area = true",
  marts=("mart_brand_generic_ratio",), doubles=("total_drug_cost", "brand_cost", "generic_cost"),
  bigints=("total_claims", "brand_claims", "generic_claims"))
q("report_brand_generic_summary", f"""
    SELECT therapeutic_area, sum(total_claims) AS total_claims,
           {R('sum(generic_claims)', 'sum(total_claims)', 1, '100')} AS generic_rate,
           {R('sum(brand_claims)', 'sum(total_claims)', 1, '100')} AS brand_rate
    FROM mart_brand_generic_ratio WHERE is_focus_area = true GROUP BY 1""",
  marts=("mart_brand_generic_ratio",), bigints=("total_claims",))
q("extract_engagement_summary", f"""
    SELECT specialty, engagement_tier, state, census_region, count(*) AS prescriber_count,
           sum(total_claims) AS total_claims,
           {MEAN('total_drug_cost', 2)} AS avg_drug_cost,
           {MEAN('brand_prescribing_rate_pct', 1)} AS avg_brand_rate,
           {MEAN('avg_cost_per_claim', 2)} AS avg_cost_per_claim,
           sum(opioid_claims) AS opioid_claims, sum(antibiotic_claims) AS antibiotic_claims,
           {MEAN('avg_beneficiary_age', 1)} AS avg_patient_age
    FROM mart_prescriber_engagement GROUP BY 1, 2, 3, 4""",
  marts=("mart_prescriber_engagement",),
  bigints=("total_claims", "opioid_claims", "antibiotic_claims"))
q("extract_pareto_top50", f"""
    SELECT * FROM mart_specialty_vs_generic WHERE drug_year = {REPORT_YEAR}
    ORDER BY total_spending DESC, generic_name, brand_name, manufacturer_name LIMIT 50""",
  marts=("mart_specialty_vs_generic",), doubles=("total_spending",))

# ------------------------------------------------------------------- the KPI catalogue, at each KPI's governed grain


def _kpi(name, mart, dims, value, where="true", bigints=()):
    q(f"kpi_{name}", f"SELECT {dims}, {value} AS {name} FROM {mart} WHERE {where} GROUP BY ALL", marts=(mart,), bigints=bigints)


_kpi("cost_per_claim", "mart_cost_per_claim", "drug_year, generic_name",
     R("sum(total_spending)", "sum(total_claims)", 2), "total_beneficiaries >= 11")
_kpi("cost_per_beneficiary_per_month", "mart_cost_per_claim", "drug_year, generic_name",
     R("sum(total_spending)", "(12 * sum(total_beneficiaries))", 2), "total_beneficiaries >= 11")
_kpi("cost_per_day_of_therapy", "mart_day_supply_efficiency", "drug_year, generic_name, state",
     R("sum(total_drug_cost)", "sum(total_day_supply)", 2), "total_day_supply > 0")
_kpi("total_claims", "mart_geographic_distribution", "drug_year, state", "sum(total_claims)", bigints=("total_claims",))
_kpi("fills_per_beneficiary", "mart_fill_volume_trends", "drug_year, therapeutic_area",
     R("sum(total_30day_fills)", "sum(total_beneficiaries)", 2), "total_beneficiaries >= 11")
_kpi("generic_dispensing_rate", "mart_brand_generic_ratio", "drug_year, therapeutic_area, state",
     R("sum(generic_claims)", "sum(brand_claims) + sum(generic_claims)", 1, "100"), "total_claims > 0")
_kpi("specialty_adoption_rate", "mart_specialty_adoption_funnel", "drug_year, prescriber_specialty, therapeutic_area",
     R("sum(prescribers_with_specialty_rx)", "sum(prescriber_count)", 1, "100"))
q("kpi_specialty_drug_flag", """
    SELECT drug_year, generic_name, brand_name, manufacturer_name, exceeds_specialty_threshold AS specialty_drug_flag
    FROM mart_cost_per_claim""", marts=("mart_cost_per_claim",))
q("kpi_brand_prescribing_rate", """
    SELECT npi, prescriber_year, brand_prescribing_rate_pct AS brand_prescribing_rate
    FROM mart_prescriber_engagement""", marts=("mart_prescriber_engagement",))
q("kpi_area_spending_share", f"""
    SELECT a.drug_year, a.therapeutic_area, {R('a.s', 'y.s', 1, '100')} AS area_spending_share
    FROM (SELECT drug_year, therapeutic_area, sum(total_spending) AS s FROM mart_therapeutic_area_mix GROUP BY ALL) a
    JOIN (SELECT drug_year, sum(total_spending) AS s FROM mart_therapeutic_area_mix GROUP BY ALL) y USING (drug_year)""",
  marts=("mart_therapeutic_area_mix",))
q("kpi_market_share", f"""
    SELECT m.drug_year, m.therapeutic_area, m.generic_name, m.brand_name, m.manufacturer_name,
           {R('m.total_spending', 't.s', 2, '100')} AS market_share
    FROM mart_manufacturer_performance_report m
    JOIN (SELECT drug_year, therapeutic_area, sum(total_spending) AS s
          FROM mart_manufacturer_performance_report GROUP BY ALL) t USING (drug_year, therapeutic_area)
    WHERE m.total_beneficiaries >= 11""", marts=("mart_manufacturer_performance_report",))
q("kpi_prescriber_engagement_tier", """
    SELECT npi, prescriber_year, engagement_tier AS prescriber_engagement_tier
    FROM mart_prescriber_engagement""", marts=("mart_prescriber_engagement",))
q("kpi_data_completeness", " UNION ALL ".join(
    f"SELECT '{m}' AS source_model, '{c}' AS column_name, {R(f'count({c})', 'count(*)', 2, '100')} AS data_completeness FROM {m}"
    for m, cs in (("stg_drug_spending", "generic_name total_spending total_claims total_beneficiaries"),
                  ("stg_prescribers", "npi specialty state total_claims total_drug_cost")) for c in cs.split()))
q("kpi_spending_anomaly", """
    SELECT drug_year, generic_name, brand_name, anomaly_status AS spending_anomaly FROM mart_dq_anomalies""",
  marts=("mart_dq_anomalies",))

# ------------------------------------------------------------------- role views

q("role_view_partner_report", """
    SELECT drug_year, therapeutic_area, brand_generic_flag, count(*) AS row_count,
           sum(total_claims) AS total_claims, sum(total_spending) AS total_spending
    FROM mart_manufacturer_performance_report WHERE therapeutic_area IN ('Alpha', 'Beta')
    GROUP BY 1, 2, 3 HAVING sum(total_beneficiaries) >= 11""",
  marts=("mart_manufacturer_performance_report",), doubles=("total_spending",), bigints=("total_claims",))
q("role_view_executive_anomalies", """
    SELECT drug_year, therapeutic_area, anomaly_status, count(*) AS row_count,
           sum(total_claims) AS total_claims, sum(total_spending) AS total_spending
    FROM mart_dq_anomalies GROUP BY 1, 2, 3 HAVING sum(total_beneficiaries) >= 11""",
  marts=("mart_dq_anomalies",), doubles=("total_spending",), bigints=("total_claims",))
EXTRA["role_view_partner_area_kpis"] = EXTRA["partner_area_kpis"].replace("partner_area_kpis", "role_view_partner_area_kpis")
