"""Shared CTE text: the fixture extracts, staging and intermediate layers in DuckDB SQL.

Written from the model rules (UNION ALL unpivot, join-back totals, ...), not from the
Spark plans, so the comparison checks the Spark operators rather than echoing them.
Views ``region nation customer supplier part orders lineitem`` are provided by the caller.
"""

from __future__ import annotations

YEARS = (1995, 1996, 1997, 1998, 1999, 2000, 2001)
RELEASE_YEAR = 2001
MIN_BENES = 11
SPECIALTY_COST = 830
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def _dec(x: str) -> str:
    # double -> decimal through the shortest decimal text of the double (as Spark does),
    # so a quotient that is an exact half (1724143.505) rounds away from zero.
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))"


def R(num: str, den: str, n: int, scale: str | None = None) -> str:
    """round(num/den [*scale], n): double quotient, decimal rounding half away from zero."""
    q = f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"
    if scale:
        q = f"({q} * {scale})"
    return f"CAST(ROUND({_dec(q)}, {n}) AS DOUBLE)"


def RD(x: str, n: int) -> str:
    return f"CAST(ROUND({_dec(x)}, {n}) AS DOUBLE)"


def MEAN(x: str, n: int) -> str:
    return R(f"SUM(CAST({x} AS DECIMAL(38,4)))", f"COUNT({x})", n)


def SK(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"




STUBS = ("tot_spndng", "tot_clms", "tot_benes", "tot_dsg_unts", "avg_spnd_per_clm",
         "avg_spnd_per_bene", "avg_spnd_per_dsg_unt_wghtd", "outlier_flag")

_pivot = ",\n        ".join(
    f"max(CASE WHEN ship_year = {y} THEN {s} END) AS {s}_{y}" for y in YEARS for s in STUBS)

_unpivot = "\n    UNION ALL\n".join(f"""    SELECT trim(upper(coalesce(brnd_name, ''))) AS brand_name,
           trim(upper(gnrc_name)) AS generic_name,
           trim(coalesce(mftr_name, '')) AS manufacturer_name,
           TRY_CAST(tot_mftr AS INTEGER) AS manufacturer_count,
           {y} AS drug_year,
           tot_spndng_{y} AS total_spending, tot_clms_{y} AS total_claims,
           tot_benes_{y} AS total_beneficiaries, tot_dsg_unts_{y} AS total_dosage_units,
           avg_spnd_per_clm_{y} AS avg_spending_per_claim,
           avg_spnd_per_bene_{y} AS avg_spending_per_beneficiary,
           avg_spnd_per_dsg_unt_wghtd_{y} AS avg_spending_per_dosage_unit,
           outlier_flag_{y} AS outlier_flag
    FROM spend_src""" for y in YEARS)

BASE_CTES = f"""
lines AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
           l.l_extendedprice, l.l_returnflag, l.l_linestatus,
           CAST(year(l.l_shipdate) AS INTEGER) AS ship_year, o.o_custkey
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
spend_lines AS (
    SELECT ln.*,
           p.p_name AS gnrc_name,
           CASE p.p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN p.p_name
                ELSE ' Brand ' || p.p_name END AS brnd_name,
           r.r_name AS mftr_name
    FROM lines ln
    JOIN part p ON ln.l_partkey = p.p_partkey
    JOIN supplier s ON ln.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
spend_long AS (
    SELECT gnrc_name, brnd_name, mftr_name, ship_year,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * CAST(0.2 AS DECIMAL(2,1))
                AS DECIMAL(18,2)) AS tot_spndng,
           COUNT(*) AS tot_clms,
           CASE WHEN COUNT(DISTINCT o_custkey) >= 4 THEN COUNT(DISTINCT o_custkey) END AS tot_benes,
           SUM(l_quantity) AS tot_dsg_unts,
           CASE WHEN SUM(l_quantity) > 400 THEN '1' WHEN SUM(l_quantity) > 300 THEN ' ' END
                AS outlier_flag
    FROM spend_lines
    GROUP BY gnrc_name, brnd_name, mftr_name, ship_year
),
spend_long2 AS (
    SELECT *, {R('tot_spndng', 'tot_clms', 2)} AS avg_spnd_per_clm,
              {R('tot_spndng', 'tot_benes', 2)} AS avg_spnd_per_bene,
              {R('tot_spndng', 'tot_dsg_unts', 2)} AS avg_spnd_per_dsg_unt_wghtd
    FROM spend_long
),
spend_wide0 AS (
    SELECT gnrc_name, brnd_name, mftr_name,
        {_pivot}
    FROM spend_long2
    GROUP BY gnrc_name, brnd_name, mftr_name
),
raw_part_d_spending AS (
    SELECT *, CAST(count(*) OVER (PARTITION BY gnrc_name, brnd_name) AS INTEGER) AS tot_mftr
    FROM spend_wide0
),
spend_src AS (
    SELECT * FROM raw_part_d_spending
    WHERE gnrc_name IS NOT NULL AND trim(gnrc_name) != ''
),
spend_unpivoted AS (
{_unpivot}
),
stg_drug_spending AS (
    SELECT brand_name, generic_name, manufacturer_name, manufacturer_count, drug_year,
           TRY_CAST(total_spending AS DECIMAL(18,2)) AS total_spending,
           TRY_CAST(total_claims AS BIGINT) AS total_claims,
           TRY_CAST(total_beneficiaries AS BIGINT) AS total_beneficiaries,
           TRY_CAST(total_dosage_units AS DECIMAL(18,2)) AS total_dosage_units,
           TRY_CAST(avg_spending_per_claim AS DECIMAL(12,2)) AS avg_spending_per_claim,
           TRY_CAST(avg_spending_per_beneficiary AS DECIMAL(12,2)) AS avg_spending_per_beneficiary,
           TRY_CAST(avg_spending_per_dosage_unit AS DECIMAL(12,2)) AS avg_spending_per_dosage_unit,
           TRY_CAST(total_claims AS BIGINT) AS total_30day_fills,
           CASE WHEN outlier_flag IS NOT NULL AND trim(CAST(outlier_flag AS VARCHAR)) != ''
                THEN true ELSE false END AS is_outlier
    FROM spend_unpivoted
    WHERE total_spending IS NOT NULL AND TRY_CAST(total_claims AS BIGINT) > 0
),
cust AS (
    SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
presc_agg AS (
    SELECT o_custkey,
           COUNT(*) AS claims,
           COUNT(*) FILTER (WHERE l_partkey % 3 = 2) AS brnd_tot_clms,
           COUNT(*) FILTER (WHERE l_partkey % 3 <> 2) AS gnrc_tot_clms,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS tot_drug_cst,
           CAST(SUM(CASE WHEN l_partkey % 3 = 2 THEN CAST(l_extendedprice AS DECIMAL(18,2))
                         ELSE 0 END) AS DECIMAL(18,2)) AS brnd_tot_drug_cst,
           CAST(SUM(CASE WHEN l_partkey % 3 <> 2 THEN CAST(l_extendedprice AS DECIMAL(18,2))
                         ELSE 0 END) AS DECIMAL(18,2)) AS gnrc_tot_drug_cst,
           COUNT(DISTINCT l_orderkey) AS tot_benes,
           {R('SUM(l_quantity)', '30', 2)} AS tot_30day_fills,
           COUNT(*) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'F') AS opioid_tot_clms,
           COUNT(DISTINCT CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_orderkey END)
                AS opioid_tot_benes,
           COUNT(*) FILTER (WHERE l_returnflag = 'A') AS antbtc_tot_clms,
           {R('SUM(l_quantity)', 'COUNT(*)', 1)} AS bene_avg_age,
           COUNT(*) FILTER (WHERE l_linenumber % 2 = 1) AS bene_feml_cnt,
           COUNT(*) FILTER (WHERE l_linenumber % 2 = 0) AS bene_male_cnt
    FROM lines GROUP BY o_custkey
),
raw_prescribers AS (
    SELECT CAST(c.c_custkey AS VARCHAR) AS prscrbr_npi, c.c_name AS prscrbr_last_org_name,
           CAST(NULL AS VARCHAR) AS prscrbr_first_name, CAST(NULL AS VARCHAR) AS prscrbr_crdntls,
           'I' AS prscrbr_ent_cd, c.c_mktsegment AS prscrbr_type,
           c.n_name AS prscrbr_state_abrvtn, CAST(NULL AS VARCHAR) AS prscrbr_city,
           a.claims AS tot_clms,
           a.*
    FROM presc_agg a JOIN cust c ON a.o_custkey = c.c_custkey
),
stg_prescribers AS (
    SELECT substring(CAST(prscrbr_npi AS VARCHAR), 1, 10) AS npi,
           trim(prscrbr_last_org_name) AS last_name_or_org,
           trim(coalesce(prscrbr_first_name, '')) AS first_name,
           trim(coalesce(prscrbr_crdntls, '')) AS credentials,
           trim(prscrbr_ent_cd) AS entity_code,
           trim(prscrbr_type) AS specialty,
           trim(prscrbr_state_abrvtn) AS state,
           trim(coalesce(prscrbr_city, '')) AS city,
           TRY_CAST(tot_clms AS BIGINT) AS total_claims,
           TRY_CAST(tot_benes AS INTEGER) AS total_beneficiaries,
           TRY_CAST(tot_drug_cst AS DECIMAL(18,2)) AS total_drug_cost,
           TRY_CAST(tot_30day_fills AS DECIMAL(12,2)) AS total_30day_fills,
           TRY_CAST(brnd_tot_clms AS BIGINT) AS brand_claims,
           TRY_CAST(gnrc_tot_clms AS BIGINT) AS generic_claims,
           TRY_CAST(brnd_tot_drug_cst AS DECIMAL(18,2)) AS brand_drug_cost,
           TRY_CAST(gnrc_tot_drug_cst AS DECIMAL(18,2)) AS generic_drug_cost,
           TRY_CAST(opioid_tot_clms AS BIGINT) AS opioid_claims,
           TRY_CAST(opioid_tot_benes AS INTEGER) AS opioid_beneficiaries,
           TRY_CAST(antbtc_tot_clms AS BIGINT) AS antibiotic_claims,
           TRY_CAST(bene_avg_age AS DECIMAL(5,1)) AS avg_beneficiary_age,
           TRY_CAST(bene_feml_cnt AS INTEGER) AS female_beneficiary_count,
           TRY_CAST(bene_male_cnt AS INTEGER) AS male_beneficiary_count,
           {RELEASE_YEAR} AS prescriber_year
    FROM raw_prescribers WHERE prscrbr_npi IS NOT NULL
),
pd_agg AS (
    SELECT ln.o_custkey, p.p_name,
           CASE p.p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN p.p_name
                ELSE ' Brand ' || p.p_name END AS brnd_name,
           COUNT(*) AS tot_clms,
           COUNT(DISTINCT ln.l_orderkey) AS tot_benes,
           CAST(SUM(ln.l_quantity) AS BIGINT) AS tot_day_suply,
           {R('SUM(ln.l_quantity)', '30', 2)} AS tot_30day_fills,
           CAST(SUM(CAST(ln.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS tot_drug_cst
    FROM lines ln JOIN part p ON ln.l_partkey = p.p_partkey
    GROUP BY 1, 2, 3
),
raw_prescribers_drug AS (
    SELECT CAST(c.c_custkey AS VARCHAR) AS prscrbr_npi, c.c_name AS prscrbr_last_org_name,
           CAST(NULL AS VARCHAR) AS prscrbr_first_name, c.c_mktsegment AS prscrbr_type,
           c.n_name AS prscrbr_state_abrvtn, CAST(NULL AS VARCHAR) AS prscrbr_city,
           a.brnd_name, a.p_name AS gnrc_name, a.tot_clms, a.tot_benes, a.tot_day_suply,
           a.tot_30day_fills, a.tot_drug_cst,
           CASE WHEN c.c_custkey % 7 = 0 THEN '*' END AS ge65_sprsn_flag
    FROM pd_agg a JOIN cust c ON a.o_custkey = c.c_custkey
),
stg_prescriber_drugs AS (
    SELECT substring(CAST(prscrbr_npi AS VARCHAR), 1, 10) AS npi,
           trim(prscrbr_last_org_name) AS last_name_or_org,
           trim(coalesce(prscrbr_first_name, '')) AS first_name,
           trim(prscrbr_type) AS specialty,
           trim(prscrbr_state_abrvtn) AS state,
           trim(coalesce(prscrbr_city, '')) AS city,
           trim(upper(coalesce(brnd_name, ''))) AS brand_name,
           trim(upper(gnrc_name)) AS generic_name,
           TRY_CAST(tot_clms AS BIGINT) AS total_claims,
           TRY_CAST(tot_benes AS INTEGER) AS total_beneficiaries,
           TRY_CAST(tot_day_suply AS BIGINT) AS total_day_supply,
           TRY_CAST(tot_30day_fills AS DECIMAL(12,2)) AS total_30day_fills,
           TRY_CAST(tot_drug_cst AS DECIMAL(18,2)) AS total_drug_cost,
           CASE WHEN ge65_sprsn_flag IS NOT NULL AND trim(ge65_sprsn_flag) = '*'
                THEN true ELSE false END AS is_ge65_suppressed,
           {RELEASE_YEAR} AS prescriber_drug_year
    FROM raw_prescribers_drug
    WHERE gnrc_name IS NOT NULL AND tot_clms IS NOT NULL
),
seed_therapeutic_area_map AS (
    SELECT p_name AS generic_name,
           CASE split_part(p_name, ' ', 2)
                WHEN 'anvil' THEN 'Alpha' WHEN 'bolt' THEN 'Alpha'
                WHEN 'gear' THEN 'Beta' WHEN 'gizmo' THEN 'Beta'
                WHEN 'plate' THEN 'Gamma' WHEN 'ring' THEN 'Delta' END AS therapeutic_area,
           split_part(p_name, ' ', 1) IN ('cold', 'hot') AS is_specialty,
           (split_part(p_name, ' ', 2) = 'plate'
            OR split_part(p_name, ' ', 1) IN ('blue', 'red', 'new')) AS is_focus_area
    FROM (SELECT DISTINCT p_name FROM part) d
    WHERE split_part(p_name, ' ', 2) NOT IN ('rod', 'widget')
),
seed_state_region_map AS (
    SELECT n.n_name AS state_abbrev, n.n_name AS state_name, r.r_name AS census_region,
           'Division ' || CAST(n.n_nationkey % 9 AS VARCHAR) AS census_division
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE n.n_nationkey <> 24
),
tmap AS (
    SELECT upper(trim(generic_name)) AS generic_name, therapeutic_area,
           CAST(is_specialty AS BOOLEAN) AS is_specialty_mapped,
           CAST(is_focus_area AS BOOLEAN) AS is_focus_mapped
    FROM seed_therapeutic_area_map
),
int_drug_enriched AS (
    SELECT {SK('drug_year', 'generic_name', 'brand_name', 'manufacturer_name')} AS drug_spending_key, e.*
    FROM (
        SELECT s.*, t.therapeutic_area,
               coalesce(t.is_focus_mapped, false) AS is_focus_area,
               coalesce(t.is_specialty_mapped,
                        CASE WHEN s.total_beneficiaries > 0
                              AND (s.total_spending / s.total_beneficiaries) / 12 > {SPECIALTY_COST}
                             THEN true ELSE false END) AS is_specialty_drug,
               CASE WHEN s.total_claims > 0
                    THEN {R('s.total_spending', 's.total_claims', 2)} END AS cost_per_claim,
               CASE WHEN s.total_beneficiaries > 0
                    THEN {R('s.total_spending', 's.total_beneficiaries', 2)} END AS cost_per_beneficiary,
               CASE WHEN s.total_beneficiaries > 0
                    THEN {R('(CAST(s.total_spending AS DOUBLE) / CAST(s.total_beneficiaries AS DOUBLE))', '12', 2)}
                    END AS cost_per_beneficiary_monthly,
               CASE WHEN s.brand_name IS NOT NULL AND s.brand_name != '' THEN 'Brand'
                    ELSE 'Generic' END AS brand_generic_flag
        FROM stg_drug_spending s LEFT JOIN tmap t ON s.generic_name = t.generic_name
    ) e
),
presc_region AS (
    SELECT p.*, r.census_region, r.census_division,
           CASE WHEN (p.brand_claims + p.generic_claims) > 0
                THEN {R('p.brand_claims', '(p.brand_claims + p.generic_claims)', 1, '100')} END
                AS brand_prescribing_rate_pct,
           CASE WHEN p.total_claims > 0 THEN {R('p.total_drug_cost', 'p.total_claims', 2)} END
                AS avg_cost_per_claim,
           CASE WHEN p.total_beneficiaries > 0
                THEN {R('p.total_claims', 'p.total_beneficiaries', 1)} END AS claims_per_beneficiary
    FROM stg_prescribers p LEFT JOIN seed_state_region_map r ON p.state = r.state_abbrev
),
presc_pct AS (
    SELECT quantile_cont(total_claims, 0.75) AS p75, quantile_cont(total_claims, 0.25) AS p25
    FROM presc_region WHERE total_claims > 0
),
int_prescriber_summary AS (
    SELECT {SK('w.prescriber_year', 'w.npi')} AS prescriber_key, w.*,
           CASE WHEN w.total_claims >= q.p75 THEN 'High'
                WHEN w.total_claims >= q.p25 THEN 'Medium' ELSE 'Low' END AS engagement_tier
    FROM presc_region w CROSS JOIN presc_pct q
),
int_prescriber_drug_detail AS (
    SELECT {SK('e.prescriber_drug_year', 'e.npi', 'e.generic_name', 'e.brand_name')} AS prescriber_drug_key, e.*
    FROM (
        SELECT pd.*, t.therapeutic_area,
               coalesce(t.is_specialty_mapped, false) AS is_specialty_drug,
               coalesce(t.is_focus_mapped, false) AS is_focus_area,
               r.census_region,
               CASE WHEN pd.total_claims > 0
                    THEN {R('pd.total_drug_cost', 'pd.total_claims', 2)} END AS cost_per_claim,
               CASE WHEN pd.total_claims > 0
                    THEN {R('pd.total_day_supply', 'pd.total_claims', 1)} END AS avg_day_supply_per_claim
        FROM stg_prescriber_drugs pd
        LEFT JOIN tmap t ON pd.generic_name = t.generic_name
        LEFT JOIN seed_state_region_map r ON pd.state = r.state_abbrev
    ) e
),
drugs_kept AS (
    SELECT * FROM int_drug_enriched WHERE total_beneficiaries >= {MIN_BENES}
)
"""


def with_base(body: str) -> str:
    """Full statement: shared CTEs + ``body`` (which may add CTEs after a comma)."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {BASE_CTES}\n{body}"
    return f"WITH {BASE_CTES},\n{body}"
