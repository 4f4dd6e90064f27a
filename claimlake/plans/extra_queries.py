"""Registered queries beyond the 23 models: inputs, ingest filters, generic operators,
checks, history, governance, semantic-layer explores and dashboard reports.

Every query reads the driver tables (through the fixture adapter and the models).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cost_tier, legend_bin, suppress_small_cells
from ..operators import access, quality
from ..operators.aggregates import distinct_sketches, merged_distinct
from ..operators.history import as_of, scd2_apply
from ..operators.kpis import KPI_CATALOG, evaluate, kpi_query
from ..operators.measures import VIEWS, explore, measure_query
from ..operators.windows import year_over_year
from ..session import shared_dir
from ..sources import ingest
from ..sources.raw import INPUTS, RawSources
from ..sources.sinks import write_csv, write_table
from .project import MODELS, Project, _ensure_loaded
from .governance import governed_view
from .reports import REPORTS
from .role_views import publish_role, register_assignments, role_database
from .maintained import MAINTAINED, maintained_mart, refresh_mart, start_mart
from .snapshots import SNAPSHOT_CHECK_COLS, SNAPSHOT_KEYS, run_snapshot, snapshot_source, written_once
from .snapshots import history as stored_history

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _prj(spark, sf_dir) -> Project:
    from .catalog import project
    return project(spark, sf_dir)


def query(fn: Callable[[Project], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .catalog import comparable
        return comparable(fn(_prj(spark, sf_dir)))
    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


# ------------------------------------------------------------------ inputs and ingest

def _input_query(name: str):
    def fn(prj: Project) -> DataFrame:
        return prj.raw(name)
    fn.__name__ = name
    return query(fn)


for _n in INPUTS:
    _input_query(_n)

# Fixture analogue of the ingest specialty list (prescriber types are market segments).
FIXTURE_TARGET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")


@query
def ingest_prescribers_by_specialty(prj):
    """Normalised column names, specialty column found by candidates, value-list filter."""
    raw = ingest.normalise_columns(prj.raw("raw_prescribers"))
    return ingest.filter_values(raw, ingest.SPECIALTY_CANDIDATES, FIXTURE_TARGET_SEGMENTS)


@query
def ingest_prescriber_drugs_in_map(prj):
    """Prescriber-drug rows whose generic name is in the therapeutic-area map."""
    raw = ingest.normalise_columns(prj.raw("raw_prescribers_drug"))
    return ingest.filter_to_reference(raw, ingest.GENERIC_CANDIDATES,
                                      prj.raw("seed_therapeutic_area_map"), "generic_name")


# ------------------------------------------------------------------ generic operators

@query
def suppressed_cells_drug_spending(prj):
    """Cell-form suppression: counts below the threshold blanked, rows kept."""
    t = prj.params.min_beneficiaries
    d = prj.model("int_drug_enriched")
    return d.select("drug_spending_key", "drug_year", "generic_name", "brand_name",
                    "manufacturer_name",
                    suppress_small_cells("total_beneficiaries", t).alias("total_beneficiaries"),
                    suppress_small_cells("total_claims", t).alias("total_claims"))


@query
def spending_trends_yoy(prj):
    """Year-over-year spending change per area and focus flag (previous year only)."""
    t = prj.model("mart_drug_spending_trends").select(
        "drug_year", "therapeutic_area", "is_focus_area", "total_spending")
    return year_over_year(t, ["therapeutic_area", "is_focus_area"], "drug_year",
                          "total_spending", "prev_year_spending", "yoy_change_pct", 1)


# ------------------------------------------------------------------------------ checks

def staging_checks(prj: Project) -> list[quality.Check]:
    years = tuple(prj.params.analysis_years)
    C = quality.Check
    return [
        C("not_null", "stg_drug_spending", "generic_name"),
        C("not_null", "stg_drug_spending", "total_spending"),
        C("not_null", "stg_drug_spending", "total_claims"),
        C("not_null", "stg_drug_spending", "drug_year"),
        C("accepted_values", "stg_drug_spending", "drug_year", values=years),
        C("not_null", "stg_prescribers", "npi"),
        C("unique", "stg_prescribers", "npi"),
        C("not_null", "stg_prescribers", "specialty"),
        C("not_null", "stg_prescribers", "total_claims"),
        C("not_null", "stg_prescriber_drugs", "npi"),
        C("not_null", "stg_prescriber_drugs", "generic_name"),
        C("not_null", "stg_prescriber_drugs", "total_claims"),
    ]


# Extra not-null columns declared on marts (besides every mart key).
MART_NOT_NULL = (("mart_drug_spending_trends", "total_spending"),
                 ("mart_specialty_vs_generic", "spending_rank"),
                 ("mart_prescriber_engagement", "npi"),
                 ("mart_cost_per_claim", "cost_per_claim"))


def mart_checks() -> list[quality.Check]:
    _ensure_loaded()
    out = []
    for spec in MODELS.values():
        if spec.layer != "marts":
            continue
        key = spec.key or ("drug_year" if spec.name == "mart_kpi_scorecard" else None)
        if key:
            out.append(quality.Check("unique", spec.name, key))
            out.append(quality.Check("not_null", spec.name, key))
        out += [quality.Check("not_null", m, c) for m, c in MART_NOT_NULL if m == spec.name]
    return out


def _run_checks(prj: Project, checks: list[quality.Check]) -> DataFrame:
    out = None
    for model in dict.fromkeys(c.model for c in checks):
        part = quality.run_column_checks(prj.model(model), [c for c in checks if c.model == model])
        out = part if out is None else out.unionByName(part)
    return out


@query
def checks_staging(prj):
    return _run_checks(prj, staging_checks(prj))


@query
def checks_marts(prj):
    # 15 marts read the three intermediate models: compute those once.
    prj.checkpoint(["int_drug_enriched", "int_prescriber_summary", "int_prescriber_drug_detail"])
    return _run_checks(prj, mart_checks())


@query
def check_negative_spending(prj):
    """Bad rows: negative total spending (severity error)."""
    return (prj.model("stg_drug_spending").where(F.col("total_spending") < 0)
            .select("generic_name", "brand_name", "total_spending"))


@query
def check_brand_generic_sum(prj):
    """Bad rows (severity warn): brand + generic claims off total by more than 20 %."""
    p = prj.model("stg_prescribers")
    bg = F.col("brand_claims") + F.col("generic_claims")
    diff = F.abs(F.col("total_claims") - bg)
    return (p.where((F.col("total_claims") > 100) & F.col("brand_claims").isNotNull()
                    & F.col("generic_claims").isNotNull()
                    & (diff * 5 > F.col("total_claims")))
            .select("npi", "total_claims", "brand_claims", "generic_claims",
                    bg.alias("computed_total"), diff.alias("diff")))


@query
def checks_custom(prj):
    return quality.custom_check(QUERY_FNS["check_negative_spending"](prj),
                                "assert_no_negative_spending", "stg_drug_spending").unionByName(
        quality.custom_check(QUERY_FNS["check_brand_generic_sum"](prj),
                             "assert_brand_generic_sum", "stg_prescribers", "warn"))


@query
def ingest_rejected_casts(prj):
    """Rejected values of a delivery, counted per column in the pass that reads it: the prescriber extract as CSV, with
    the claims of every npi that ends in 7 written in words."""
    from ..operators.quality import rejection_checks
    from ..sources.raw import REASONS
    path = shared_dir(prj.spark, f"delivery-{uuid.uuid4().hex}")
    words = F.when(F.col("prscrbr_npi").cast("string").endswith("7"), F.concat(F.col("tot_clms").cast("string"), F.lit(" claims")))
    write_csv(prj.raw("raw_prescribers").withColumn("tot_clms", F.coalesce(words, F.col("tot_clms").cast("string"))), path)
    seen: dict = {}
    src = RawSources.from_csv(prj.spark, {"raw_prescribers": path}, (), filters=False, rows=seen)
    src["raw_prescribers"].write.format("noop").mode("overwrite").save()
    counts = {k: v for k, v in seen["raw_prescribers"][0].get.items() if k != "rows"}
    listed = src.rejected("raw_prescribers").select(F.explode(REASONS).alias("column_name")).groupBy("column_name").agg(F.count(F.lit(1)).alias("listed"))
    return (rejection_checks(prj.spark, {"raw_prescribers": counts}).join(listed, "column_name", "left")
            .select("column_name", "violations", "status", F.coalesce("listed", F.lit(0).cast("bigint")).alias("listed")))


# ----------------------------------------------------------------------------- history

# Fixture loads: a delivery of the orders up to a day, then a later delivery of all orders. New keys and changed
# values arise from the orders in between.
FIRST_LOAD_AT, SECOND_LOAD_AT = "2024-01-01 00:00:00", "2025-01-01 00:00:00"
FIRST_LOAD_ORDERED_UNTIL = "1997-06-30"


def snapshot_loads(prj: Project) -> tuple[DataFrame, DataFrame]:
    early = Project(prj.spark, RawSources.from_driver_tables(prj.spark, prj.sources.origin, FIRST_LOAD_ORDERED_UNTIL), prj.params)
    return snapshot_source(early), snapshot_source(prj)


def snapshot_history(prj: Project) -> DataFrame:
    first, second = (written_once(prj.spark, load) for load in snapshot_loads(prj))
    h1 = scd2_apply(None, first, SNAPSHOT_KEYS, SNAPSHOT_CHECK_COLS, F.lit(FIRST_LOAD_AT))
    return scd2_apply(h1, second, SNAPSHOT_KEYS, SNAPSHOT_CHECK_COLS, F.lit(SECOND_LOAD_AT))


@query
def snapshot_drug_spending(prj):
    return snapshot_history(prj)


@query
def snapshot_drug_spending_merged(prj):
    """The same two loads merged year by year into a stored history, read back from its newest version."""
    root = shared_dir(prj.spark, f"snapshot-{uuid.uuid4().hex}")
    first, second = snapshot_loads(prj)
    run_snapshot(prj, root, FIRST_LOAD_AT, first)
    run_snapshot(prj, root, SECOND_LOAD_AT, second)
    return stored_history(prj, root)


@query
def snapshot_drug_spending_as_of(prj):
    """State between the two loads (as-of read on the history)."""
    return as_of(snapshot_history(prj), "2024-06-30 00:00:00")


# -------------------------------------------------------------------------- governance

# Fixed values of the fixture: partner -> contracted therapeutic areas.
PARTNER_ASSIGNMENTS = (("A", "Alpha"), ("A", "Beta"), ("B", "Gamma"))
PII_SALT = "claimlake"


def partner_assignments(prj: Project) -> DataFrame:
    return prj.spark.createDataFrame(list(PARTNER_ASSIGNMENTS), "partner_id string, therapeutic_area string")


@query
def partner_area_report(prj):
    """Partner A: rows of its areas only, aggregated (no drug-level detail)."""
    return governed_view(prj, "partner_manufacturer", "mart_manufacturer_performance_report",
                         "A", partner_assignments(prj),
                         aggregate_by=["drug_year", "therapeutic_area", "brand_generic_flag"],
                         sums=["total_claims", "total_spending"])


@query
def partner_area_kpis(prj):
    """Partner B: the area KPI mart restricted to its contracted areas."""
    return governed_view(prj, "partner_manufacturer", "mart_therapeutic_area_kpis", "B",
                         partner_assignments(prj))


def _read_as(prj: Project, model: str, role: str, principal: str | None = None) -> DataFrame:
    """A model, written and registered, as a role's view shows it. The databases go again; the files stay."""
    spark, name = prj.spark, f"claimlake_{uuid.uuid4().hex}"
    root = shared_dir(spark, name)
    own = role_database(name, role, principal)
    write_table(prj.model(model), f"{root}/{model}")
    try:
        spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/_catalog'")
        spark.sql(f"CREATE TABLE {name}.{model} USING parquet LOCATION '{root}/{model}'")
        register_assignments(spark, partner_assignments(prj), name, f"{root}/assignments")
        publish_role(prj, name, role, principal)
        return spark.table(f"{own}.{model}")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {own} CASCADE")
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@query
def role_view_partner_report(prj):
    """Partner A's view of the detail mart: its areas only, summed, small groups left out."""
    return _read_as(prj, "mart_manufacturer_performance_report", "partner_manufacturer", "A")


@query
def role_view_executive_anomalies(prj):
    """The executive viewer's view of the anomaly list: counts and sums by area and status, no drug."""
    return _read_as(prj, "mart_dq_anomalies", "viewer_executive")


@query
def role_view_partner_area_kpis(prj):
    """Partner B's view of a summary mart: its areas, without competitors' columns."""
    return _read_as(prj, "mart_therapeutic_area_kpis", "partner_manufacturer", "B")


@query
def engagement_without_pii(prj):
    """Column filter for a role without personal-data access."""
    return access.columns_for_role(prj.model("mart_prescriber_engagement"), "analyst_commercial")


@query
def engagement_pii_protected(prj):
    """Names masked, NPI replaced by a salted SHA-256."""
    m = prj.model("mart_prescriber_engagement").select(
        "npi", "last_name_or_org", "specialty", "state", "engagement_tier", "total_claims")
    return access.hash_columns(access.mask_columns(m, ["last_name_or_org"]), ["npi"], PII_SALT)


@query
def engagement_for_region_group(prj):
    """Row filter by state for a user group (states of one census region)."""
    m = prj.model("mart_prescriber_engagement")
    states = (prj.raw("seed_state_region_map").where(F.col("census_region") == "AMERICA")
              .select(F.col("census_region").alias("group_id"),
                      F.col("state_abbrev").alias("state")))
    return access.row_filter(m, states, "AMERICA", "state", "group_id", "state")


@query
def retained_spending_trends(prj):
    """Retention: the current year and five years before it."""
    return access.retention_filter(prj.model("mart_drug_spending_trends"), "drug_year",
                                   prj.params.prescriber_release_year, 5)


# ----------------------------------------------------------------------------- delivery

@query
def stg_drug_spending_from_csv(prj):
    """Staging of a CSV delivery: the extract written as CSV, columns in another order and one
    more, then read back by header name."""
    path = shared_dir(prj.spark, f"csv-{uuid.uuid4().hex}")
    raw = prj.raw("raw_part_d_spending")
    write_csv(raw.select(F.lit("x").alias("Not In / The Extract"), *[
        F.col(c).alias(c.upper().replace("_", " ")) for c in reversed(raw.columns)]), path)
    src = RawSources.from_csv(prj.spark, {"raw_part_d_spending": path}, prj.params.analysis_years, filters=False)
    return Project(prj.spark, src, prj.params).model("stg_drug_spending")


# ---------------------------------------------------------------------- semantic layer

@query
def explore_drug_spending(prj):
    """Drug view measures by year x area, joined to area KPI measures at that grain."""
    return explore(prj.model("mart_cost_per_claim"), ["drug_year", "therapeutic_area"],
                   VIEWS["drug_spending"], prj.model("mart_therapeutic_area_kpis"),
                   {"drug_year": "drug_year", "therapeutic_area": "therapeutic_area"},
                   VIEWS["therapeutic_area_kpis"], "ta_")


@query
def explore_prescriber_geography(prj):
    """Prescriber view measures by year x state x tier, joined to geography measures."""
    return explore(prj.model("mart_prescriber_engagement"),
                   ["prescriber_year", "state", "engagement_tier"],
                   VIEWS["prescriber_engagement"], prj.model("mart_geographic_distribution"),
                   {"prescriber_year": "drug_year", "state": "state"},
                   VIEWS["geographic_distribution"], "geo_")


@query
def bi_drug_spending_source(prj):
    """Published source: default filters (current year, >= 11 beneficiaries) and
    calculated fields (specialty label, cost tier, legend bucket)."""
    m = prj.model("mart_cost_per_claim")
    yr = prj.params.prescriber_release_year
    return (m.where((F.col("drug_year") == yr)
                    & (F.col("total_beneficiaries") >= prj.params.min_beneficiaries))
            .select("cost_claim_key", "generic_name", "therapeutic_area", "total_spending",
                    "cost_per_beneficiary_monthly",
                    F.when(F.col("is_specialty_drug"), F.lit("Specialty"))
                    .otherwise(F.lit("Non-Specialty")).alias("specialty_flag_label"),
                    cost_tier("cost_per_beneficiary_monthly").alias("cost_tier"),
                    legend_bin("cost_per_beneficiary_monthly", 0.0, 2500.0, 10)
                    .alias("cost_bucket")))


# Engagement tier colours of the prescriber published source.
TIER_COLORS = (("High", "#059669"), ("Medium", "#D97706"))
OTHER_TIER_COLOR = "#DC2626"
LEGEND_BINS = 10


@query
def bi_prescriber_engagement_source(prj):
    """Published source over the engagement mart with the tier colour field."""
    m = prj.model("mart_prescriber_engagement")
    color = F.when(F.col("engagement_tier") == TIER_COLORS[0][0], F.lit(TIER_COLORS[0][1]))
    for tier, c in TIER_COLORS[1:]:
        color = color.when(F.col("engagement_tier") == tier, F.lit(c))
    return m.select("prescriber_key", "npi", "specialty", "state", "engagement_tier",
                    "total_claims", color.otherwise(F.lit(OTHER_TIER_COLOR)).alias("engagement_color"))


@query
def bi_geographic_source(prj):
    """Published geographic source: cost per beneficiary in equal-width legend bins
    between the column's minimum and maximum (one scalar subquery for both)."""
    g = prj.model("mart_geographic_distribution")
    rng = g.select(F.struct(F.min("cost_per_beneficiary").alias("lo"),
                            F.max("cost_per_beneficiary").alias("hi")).alias("r")).scalar()
    # The range is referenced once (through a one-element array) so its subquery runs once.
    bucket = F.transform(F.array(F.col("_r")),
                         lambda r: legend_bin("cost_per_beneficiary", r["lo"], r["hi"],
                                              LEGEND_BINS))[0]
    return (g.withColumn("_r", rng)
            .select("geo_key", "drug_year", "state", "therapeutic_area", "cost_per_beneficiary",
                    bucket.alias("cost_per_bene_bucket")))


@query
def bi_pharmacy_operations_source(prj):
    """Published source over fill volume with its default filter (focus areas)."""
    return prj.model("mart_fill_volume_trends").where(F.col("is_focus_area"))


@query
def bi_executive_source(prj):
    """Published executive summary, as the viewer role may read it."""
    return governed_view(prj, "viewer_executive", "mart_executive_summary")


@query
def kpis_by_area(prj):
    """Governed KPIs evaluated from their catalogue formulas, by year and area."""
    return kpi_query(prj.model("mart_cost_per_claim"), ["drug_year", "therapeutic_area"],
                     ["cost_per_claim", "cost_per_beneficiary_per_month", "total_claims"], prj.params)


@query
def kpis_dispensing_by_state(prj):
    """Generic dispensing rate by state, from the catalogue formula."""
    return kpi_query(prj.model("mart_brand_generic_ratio"), ["drug_year", "state"],
                     ["generic_dispensing_rate"], prj.params)


def _kpi_query(name: str, model: str):
    def fn(prj: Project) -> DataFrame:
        return evaluate(prj, name, model=model)
    fn.__name__ = f"kpi_{name}"
    fn.__doc__ = f"The KPI {name} at its governed grain, from its catalogue text."
    return query(fn)


for _k in KPI_CATALOG:
    _kpi_query(_k.name, _k.model or "mart_geographic_distribution")


@query
def measures_drug_by_flag(prj):
    """A single-view measure query with a filter (brand rows only)."""
    return measure_query(prj.model("mart_cost_per_claim"),
                         ["drug_year", "is_specialty_drug"], VIEWS["drug_spending"],
                         F.col("brand_generic_flag") == "Brand")


# ---------------------------------------------------------------------------- reports

for _name, _fn in REPORTS.items():
    query(_fn)

QUERY_FNS = {"check_negative_spending": check_negative_spending,
             "check_brand_generic_sum": check_brand_generic_sum}


# ------------------------------------------------------------------- distinct counts that re-aggregate

@query
def focus_geography_from_sketches(prj):
    """Focus-area prescribers per state from the sketches of (year, state, area) alone, written and read back; the
    summed column of the geography mart counts a prescriber once an area."""
    d = (prj.model("int_prescriber_drug_detail").where((F.col("total_claims") > 0) & F.col("state").isNotNull())
         .select(F.col("prescriber_drug_year").alias("drug_year"), "state", "therapeutic_area", "is_focus_area", "npi"))
    path = shared_dir(prj.spark, f"sketches-{uuid.uuid4().hex}")
    distinct_sketches(d, ["drug_year", "state", "therapeutic_area", "is_focus_area"], "npi", "prescribers").write.parquet(path)
    stored = prj.spark.read.parquet(path).where("is_focus_area")
    return merged_distinct(stored, ["state"], "prescribers", "prescriber_count")


# ------------------------------------------------------------------- marts refreshed from changed rows

def _maintained_query(mart: str):
    def fn(prj: Project) -> DataFrame:
        early = Project(prj.spark, RawSources.from_driver_tables(prj.spark, prj.sources.origin, FIRST_LOAD_ORDERED_UNTIL), prj.params)
        root, source = shared_dir(prj.spark, f"maintained-{uuid.uuid4().hex}"), MAINTAINED[mart].source
        early.materialize([source], os.path.join(root, "stored"), compression="zstd")      # a table, read several times
        stored, delivered = early.model(source), prj.model(source)
        start_mart(prj, root, mart, FIRST_LOAD_AT, stored)
        refresh_mart(prj, root, mart, SECOND_LOAD_AT, stored, delivered)
        return maintained_mart(prj, root, mart)
    fn.__name__ = mart.replace("mart_", "maintained_", 1)
    fn.__doc__ = f"{mart} from the orders of the first load, then refreshed from the rows that all orders change."
    return query(fn)


for _m in MAINTAINED:
    _maintained_query(_m)
