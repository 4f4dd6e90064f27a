"""Model metadata in the catalog: every model has an owner; registered tables show it and read back whole."""

import os

from claimlake.operators.kpis import KPI_CATALOG
from claimlake.plans import metadata
from claimlake.plans.build import build, ingest
from claimlake.plans.project import MODELS, _ensure_loaded
from tests.conftest import SF_SMALL


def test_every_model_is_described():
    _ensure_loaded()
    assert [n for n, s in MODELS.items() if not metadata.owner(s)] == []
    assert [n for n, s in MODELS.items() if s.layer == "marts" and not s.description] == []
    known = {k.name for s in MODELS.values() for k in metadata.kpis(s)}
    assert {k.name for k in KPI_CATALOG if k.model in MODELS} == known and len(known) >= 12


def test_registered_tables_show_their_metadata(spark, tmp_dir):
    raw, wh, db = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "wh"), "claimlake_test_meta"
    ingest(spark, SF_SMALL, raw)
    prj, _ = build(spark, raw, wh, run_checks=False)
    try:
        names = metadata.register_tables(prj, wh, db)
        assert len(names) == 20
        for name in names:
            spec, shown = MODELS[name], metadata.described(spark, db, name)
            assert shown["Comment"] == " ".join((spec.description or name).split())
            for key, value in metadata.properties(spec).items():
                assert f"{key}={value}" in shown["Table Properties"], (name, key)
            if spec.key:
                assert shown[spec.key] == f"Surrogate key of {', '.join(spec.grain)}"
            table = spark.table(f"{db}.{name}")
            assert set(prj.model(name).columns) <= set(table.columns)
            assert table.count() == prj.model(name).count()
        assert "fewer than 11 beneficiaries" in metadata.described(spark, db, "mart_cost_per_claim")["Table Properties"]
        # Registering again replaces the entries, not the files.
        assert metadata.register_tables(prj, wh, db) == names
        assert spark.table(f"{db}.mart_kpi_scorecard").count() == prj.model("mart_kpi_scorecard").count()
        rows = {r["model"]: r for r in metadata.catalogue_frame(prj).collect()}
        assert len(rows) == len(MODELS) and rows["mart_cost_per_claim"]["kpis"].startswith("cost_per_claim")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    assert os.path.isdir(os.path.join(wh, "marts", "mart_kpi_scorecard"))
