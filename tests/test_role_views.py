"""Role views: for each of the six roles every mart is readable or refused as the access matrix says; denied columns,
partners' areas and small groups are not shown; filters reach the scan of the base table."""

import os

import pytest
from pyspark.errors import AnalysisException

from claimlake.operators import access
from claimlake.plans import metadata
from claimlake.plans.build import build, ingest
from claimlake.plans.extra_queries import partner_assignments
from claimlake.plans.governance import governed_view
from claimlake.plans.project import MODELS
from claimlake.plans.role_views import denied_columns, publish_role, register_assignments, role_database, role_session
from tests.conftest import SF_CHECK

DB = "claimlake_test_roles"
# What each role may read, mart by mart: (domains read row by row, marts read as summaries only).
MATRIX = {
    "analyst_commercial": {"commercial", "executive"},
    "analyst_customer_success": {"customer_success", "executive"},
    "analyst_pharmacy_ops": {"pharmacy_ops", "executive"},
    "admin_data": {"commercial", "customer_success", "pharmacy_ops", "enterprise", "executive", "data_quality"},
}
SUMMARISED = {
    "partner_manufacturer": {"mart_therapeutic_area_kpis", "mart_manufacturer_performance_report"},
    "viewer_executive": {"mart_executive_summary", "mart_kpi_scorecard", "mart_dq_completeness", "mart_dq_anomalies"},
}


@pytest.fixture(scope="module")
def prj(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("roles"))
    raw, wh = os.path.join(root, "raw"), os.path.join(root, "wh")
    ingest(spark, SF_CHECK, raw)
    p, _ = build(spark, raw, wh, run_checks=False)
    metadata.register_tables(p, wh, DB)
    register_assignments(spark, partner_assignments(p), DB, os.path.join(root, "assignments"))
    yield p
    for d in [d.name for d in spark.catalog.listDatabases() if d.name.startswith(DB)]:
        spark.sql(f"DROP DATABASE IF EXISTS {d} CASCADE")


def marts():
    return {n: s for n, s in MODELS.items() if s.layer == "marts"}


@pytest.mark.parametrize("role", sorted(access.ROLE_DOMAINS))
def test_matrix(prj, role):
    who = "A" if role == "partner_manufacturer" else None
    views = publish_role(prj, DB, role, who)
    expected = SUMMARISED.get(role) or {n for n, s in marts().items() if s.domain in MATRIX[role]}
    assert {v for v in views if v in marts()} == expected
    assert ("int_drug_enriched" in views) == (role == "admin_data")
    session = role_session(prj, DB, role, who)
    for name, spec in marts().items():
        if name not in expected:
            with pytest.raises(AnalysisException):
                session.sql(f"SELECT * FROM {name}").count()
            continue
        shown = session.sql(f"SELECT * FROM {name}")
        base = prj.spark.table(f"{DB}.{name}")
        assert not denied_columns(spec, role, base.columns) & set(shown.columns)
        if role in MATRIX:
            assert shown.count() == base.count()


def test_keys_made_of_denied_columns_are_denied(prj):
    spec = MODELS["mart_dq_anomalies"]
    assert denied_columns(MODELS["mart_prescriber_engagement"], "viewer_executive", ["npi", "state", "prescriber_key"]) == {"npi", "prescriber_key"}
    # The Pareto mart's key hashes the drug's names, which partners may not see; its own key is on no list.
    own = MODELS["mart_specialty_vs_generic"]
    assert own.key not in access.COMPETITOR_COLUMNS
    assert own.key in denied_columns(own, "partner_manufacturer", [own.key, "generic_name"])
    assert denied_columns(spec, "analyst_commercial", ["generic_name"]) == set()


def test_partners_see_their_areas_only(prj, spark):
    for who, areas in (("A", {"Alpha", "Beta"}), ("B", {"Gamma"}), ("a", set()), ("o'x", set())):
        publish_role(prj, DB, "partner_manufacturer", who)
        own = f"`{role_database(DB, 'partner_manufacturer', who)}`"
        assert {r[0] for r in spark.sql(f"SELECT DISTINCT therapeutic_area FROM {own}.mart_therapeutic_area_kpis").collect()} == areas
        shown = spark.table(f"{own}.mart_manufacturer_performance_report")
        assert {r[0] for r in shown.select("therapeutic_area").distinct().collect()} == areas
        same = governed_view(prj, "partner_manufacturer", "mart_manufacturer_performance_report", who, partner_assignments(prj),
                             aggregate_by=["drug_year", "therapeutic_area", "brand_generic_flag"], sums=["total_claims", "total_spending"])
        assert sorted(map(tuple, shown.collect())) == sorted(map(tuple, same.select(*shown.columns).collect()))


def test_filters_reach_the_scan(prj, spark, capsys):
    publish_role(prj, DB, "analyst_commercial")
    own = role_database(DB, "analyst_commercial")
    spark.sql(f"SELECT generic_name FROM {own}.mart_specialty_vs_generic WHERE pareto_tier = 'Top' AND drug_year = 1997").explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(pareto_tier,Top)" in plan
    assert "drug_year" in plan.split("PartitionFilters")[1].split("\n")[0] or "EqualTo(drug_year,1997)" in plan
    assert "cumulative_spending_pct" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_publishing_again_follows_the_matrix(prj, spark):
    publish_role(prj, DB, "viewer_executive")
    own = role_database(DB, "viewer_executive")
    spark.sql(f"CREATE VIEW {own}.left_over AS SELECT * FROM {DB}.mart_prescriber_engagement")
    publish_role(prj, DB, "viewer_executive")
    assert {t.name for t in spark.catalog.listTables(own) if not t.isTemporary} == SUMMARISED["viewer_executive"]
    with pytest.raises(PermissionError):
        publish_role(prj, DB, "partner_manufacturer")
    with pytest.raises(PermissionError):
        publish_role(prj, DB, "intern")
