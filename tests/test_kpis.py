"""KPIs from their catalogue text: exclusions, zero denominators, wrong models, percentiles, columns."""

import pytest

from claimlake.operators.kpis import KPI_CATALOG, evaluate, kpi_of_columns, kpi_query, kpi_rows
from claimlake.params import FIXTURE
from claimlake.plans.project import Project
from tests.conftest import SF_CHECK


def test_exclusions_are_applied_each_to_its_own_kpi(spark):
    df = spark.createDataFrame([("a", 100.0, 10, 20), ("a", 900.0, 10, 3), ("b", 50.0, 0, 11), ("c", 7.0, 1, None)],
                               "k string, total_spending double, total_claims long, total_beneficiaries long")
    got = {r["k"]: r for r in kpi_query(df, ["k"], ["cost_per_claim", "total_claims"]).collect()}
    assert (got["a"]["cost_per_claim"], got["a"]["total_claims"]) == (10.0, 20)      # 3 beneficiaries: left out of the cost only
    assert (got["b"]["cost_per_claim"], got["c"]["cost_per_claim"], got["c"]["total_claims"]) == (None, None, 1)
    # Alone, the exclusion also leaves out groups without a kept row.
    assert sorted(r["k"] for r in kpi_query(df, ["k"], ["cost_per_claim"]).collect()) == ["a", "b"]
    assert kpi_query(df.limit(0), ["k"], ["cost_per_claim"]).count() == 0


def test_row_kpis_and_their_percentiles(spark):
    df = spark.createDataFrame([(str(i), 2001, i) for i in range(11)], "npi string, prescriber_year int, total_claims long")
    got = {r["npi"]: r["prescriber_engagement_tier"] for r in kpi_rows(df, "prescriber_engagement_tier").collect()}
    assert "0" not in got                                   # no claims: excluded, and not part of the percentiles
    assert [got[str(i)] for i in (1, 3, 4, 7, 8, 10)] == ["Low", "Low", "Medium", "Medium", "High", "High"]
    rate = spark.createDataFrame([("x", 2001, 1, 3), ("y", 2001, 0, 0)],
                                 "npi string, prescriber_year int, brand_claims long, generic_claims long")
    assert [r[2] for r in kpi_rows(rate, "brand_prescribing_rate").orderBy("npi").collect()] == [25.0, None]


def test_columns_of_a_model(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y"), (4, "z")], "a int, b string")
    got = {r["column_name"]: r["data_completeness"] for r in kpi_of_columns(df, "data_completeness", "m", ["a", "b"]).collect()}
    assert got == {"a": 75.0, "b": 75.0}
    assert kpi_of_columns(df.limit(0), "data_completeness", "m", ["a"]).first()["data_completeness"] is None


def test_wrong_models_and_grains_raise(spark):
    prj = Project.from_driver_tables(spark, SF_CHECK, FIXTURE)
    with pytest.raises(ValueError, match="governed on mart_cost_per_claim"):
        evaluate(prj, "cost_per_claim", model="int_drug_enriched")
    with pytest.raises(ValueError, match="needs the name of a model"):
        evaluate(prj, "total_claims")
    with pytest.raises(ValueError, match="can't be evaluated"):
        kpi_query(prj.model("mart_prescriber_engagement"), ["npi"], ["cost_per_day_of_therapy"])
    with pytest.raises(ValueError, match="can't be evaluated"):
        kpi_rows(spark.createDataFrame([(1,)], "npi int"), "market_share")
    with pytest.raises(ValueError, match="not defined over groups"):
        kpi_query(prj.model("mart_cost_per_claim"), ["drug_year"], ["specialty_drug_flag"])
    with pytest.raises(ValueError, match="defined over groups"):
        kpi_rows(prj.model("mart_cost_per_claim"), "cost_per_claim")


def test_every_kpi_analyses_on_its_model(spark):
    prj = Project.from_driver_tables(spark, SF_CHECK, FIXTURE)
    for kpi in KPI_CATALOG:
        out = evaluate(prj, kpi.name, model=kpi.model or "mart_geographic_distribution")
        assert out.columns == [*kpi.grain, kpi.name]


def test_a_kpi_on_unsuppressed_rows_equals_the_suppressed_mart(spark):
    """The catalogue forbids small cells: they count on no table."""
    prj = Project.from_driver_tables(spark, SF_CHECK, FIXTURE)
    rows = prj.model("int_drug_enriched").where("total_claims > 0")
    assert rows.where("total_beneficiaries < 11").count() > 0
    a = kpi_query(rows, ["drug_year"], ["cost_per_claim"]).orderBy("drug_year").collect()
    assert a == evaluate(prj, "cost_per_claim", ["drug_year"]).orderBy("drug_year").collect()
