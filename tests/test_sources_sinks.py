"""Ingest helpers, fixture shapes and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from claimlake.sources import ingest, sinks
from claimlake.sources.raw import RawSources
from tests.conftest import SF_SMALL


def test_csv_round_trip_with_schema_and_name_cleanup(spark, tmp_dir):
    df = spark.createDataFrame([("1", "Rheumatology", "A, B"), ("2", "Dentist", None)],
                               "`Prscrbr NPI` string, `Prscrbr Type` string, `Note/Text` string")
    path = os.path.join(tmp_dir, "csv")
    sinks.write_csv(df, path, single_file=True)
    back = ingest.normalise_columns(ingest.read_csv(spark, path, df.schema))
    assert back.columns == ["prscrbr_npi", "prscrbr_type", "note_text"]
    assert sorted(map(tuple, back.collect())) == [("1", "Rheumatology", "A, B"), ("2", "Dentist", None)]
    kept = ingest.filter_values(back, ingest.SPECIALTY_CANDIDATES, ingest.TARGET_SPECIALTIES)
    assert [r.prscrbr_npi for r in kept.collect()] == ["1"]


def test_filter_fallback_keeps_all_rows(spark):
    df = spark.createDataFrame([("x",)], "other string")
    with pytest.warns(UserWarning):
        assert ingest.filter_values(df, ingest.SPECIALTY_CANDIDATES, ["x"]).count() == 1


def test_filter_to_reference_is_case_and_space_insensitive(spark):
    rows = spark.createDataFrame([(" adalimumab ",), ("ASPIRIN",), ("Adalimumab",)], "gnrc_name string")
    ref = spark.createDataFrame([("Adalimumab",)], "generic_name string")
    assert ingest.filter_to_reference(rows, ingest.GENERIC_CANDIDATES, ref, "generic_name").count() == 2


def test_observe_counts(spark):
    from claimlake.operators.quality import observe_counts
    df, obs = observe_counts(spark.range(10), "m", F.col("id") < 3)
    df.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows_read": 10, "rows_kept": 3}


def test_partitioned_write_and_refresh(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(2019, "a", 1), (2020, "b", 2)], "drug_year int, k string, v int")
    sinks.write_table(df, path, partition_by=("drug_year",), sort_within=("k",), audit=True)
    assert {"drug_year=2019", "drug_year=2020"} <= set(os.listdir(path))
    new = spark.createDataFrame([(2020, "b", 20)], "drug_year int, k string, v int")
    sinks.refresh_partitions(new, path, ("drug_year",))
    back = spark.read.parquet(path)
    assert sorted((r.drug_year, r.v) for r in back.collect()) == [(2019, 1), (2020, 20)]


def test_clustered_files_span_few_values(spark, tmp_dir):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        path = os.path.join(tmp_dir, "c")
        sinks.write_table(spark.range(4000).selectExpr("id % 40 AS state", "id AS v"), path, sort_within=("state",))
    finally:
        spark.conf.set(key, old)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min("state").alias("a"), F.max("state").alias("b")).collect()
    assert len(files) > 1 and all(r.b - r.a < 40 / len(files) * 2 for r in files)


def test_write_to_configured_target(spark, tmp_dir):
    path = os.path.join(tmp_dir, "out")
    sinks.write_to(spark.range(3), {"format": "json", "path": path})
    assert spark.read.json(path).count() == 3


def test_fixture_inputs_have_expected_shapes(spark):
    src = RawSources.from_driver_tables(spark, SF_SMALL)
    wide = src["raw_part_d_spending"]
    assert {"tot_spndng_1995", "outlier_flag_2001", "tot_mftr"} <= set(wide.columns)
    area = src["seed_therapeutic_area_map"]
    assert area.groupBy("generic_name").count().where("count > 1").count() == 0
    assert set(r.therapeutic_area for r in area.collect()) <= {"Alpha", "Beta", "Gamma", "Delta"}
    assert src["seed_state_region_map"].count() == 24


def test_written_line_base_gives_same_extracts(spark, tmp_dir):
    lazy = RawSources.from_driver_tables(spark, SF_SMALL)
    via = RawSources.from_driver_tables_via(spark, SF_SMALL, os.path.join(tmp_dir, "base"))
    for name in ("raw_part_d_spending", "raw_prescribers", "raw_prescribers_drug"):
        a, b = lazy[name], via[name].select(*lazy[name].columns)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_csv_extracts_give_same_staging(spark, tmp_dir):
    from claimlake.params import FIXTURE
    from claimlake.plans.project import Project
    from claimlake.sources.raw import INPUTS
    lazy = RawSources.from_driver_tables(spark, SF_SMALL)
    paths = {}
    for name in INPUTS:
        paths[name] = os.path.join(tmp_dir, "csv", name)
        sinks.write_csv(lazy[name], paths[name])
    csv = RawSources.from_csv(spark, paths, FIXTURE.analysis_years, filters=False)
    a = Project(spark, lazy, FIXTURE)
    b = Project(spark, csv, FIXTURE)
    for m in ("stg_drug_spending", "stg_prescribers", "stg_prescriber_drugs",
              "int_prescriber_drug_detail"):
        x, y = a.model(m), b.model(m).select(*a.model(m).columns)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, m


def test_hot_year_is_written_by_many_tasks(spark, tmp_dir):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")  # tiny test data would otherwise be merged into one task
    try:
        df = spark.range(4000).select(
            F.when(F.col("id") < 3600, F.lit(2001)).otherwise(F.lit(2000)).alias("drug_year"),
            F.col("id").alias("k"))
        path = os.path.join(tmp_dir, "hot")
        sinks.write_table(df, path, partition_by=("drug_year",), sort_within=("k",))
        hot = [f for f in os.listdir(os.path.join(path, "drug_year=2001")) if f.endswith(".parquet")]
        assert len(hot) > 1
        assert spark.read.parquet(path).count() == 4000
    finally:
        spark.conf.set(key, old)


def _delivery(tmp_dir):
    """Delivered files: columns in another order, further columns, other candidate names, 2019-2023."""
    stubs = ("Tot_Spndng", "Tot_Clms", "Tot_Benes", "Tot_Dsg_Unts", "Avg_Spnd_Per_Clm", "Avg_Spnd_Per_Bene",
             "Avg_Spnd_Per_Dsg_Unt_Wghtd", "Outlier_Flag")
    years = range(2019, 2024)
    from claimlake.sources import schemas

    def write(name, header, rows):
        path = os.path.join(tmp_dir, f"{name}.csv")
        with open(path, "w") as f:
            f.write("\n".join(",".join(r) for r in [header, *rows]) + "\n")
        return path
    spend = [f"{s}_{y}" for s in stubs for y in years]
    header = ["Extra", "Tot Mftr", *spend, "Mftr/Name", "Gnrc Name", "Brnd Name"]
    values = [str(100 * (i + 1)) if "Outlier" not in c else "" for i, c in enumerate(spend)]
    who = list(schemas.PRESCRIBER_COLUMNS)
    drug = list(schemas.PRESCRIBER_DRUG_COLUMNS)

    def person(npi, kind, cols):
        return [{"prscrbr_npi": npi, "prscrbr_type": kind, "provider_type": kind, "prscrbr_last_org_name": '"Doe, J"',
                 "tot_clms": "7", "generic_name": kind, "gnrc_name": kind}.get(c, "") for c in cols]
    who2 = ["provider_type" if c == "prscrbr_type" else c for c in reversed(who)]
    drug2 = ["generic_name" if c == "gnrc_name" else c for c in reversed(drug)]
    return list(years), {
        "raw_part_d_spending": write("spend", header, [["x", "3", *values, "Acme", "aspirin", "Aspirin X"]]),
        "raw_prescribers": write("who", who2, [person("1", "Dermatology", who2), person("2", "Dentist", who2)]),
        "raw_prescribers_drug": write("drug", drug2, [person("1", " ASPIRIN ", drug2), person("2", "other", drug2)]),
        "seed_therapeutic_area_map": write("area", ["is_focus_area", "therapeutic_area", "generic_name", "is_specialty"],
                                           [["true", "Pain", "Aspirin", "false"]]),
        "seed_state_region_map": write("state", ["census_division", "state_abbrev", "state_name", "census_region"],
                                       [["d", "NY", "New York", "r"]])}


def test_delivered_csv_is_bound_by_header(spark, tmp_dir):
    from claimlake.plans.build import ingest_csv, params_for
    from claimlake.plans.project import Project
    from claimlake.sources.ingest import MissingColumnError
    years, paths = _delivery(tmp_dir)
    out = os.path.join(tmp_dir, "raw")
    counts = ingest_csv(spark, paths, years, out)
    assert counts["raw_prescribers"] == {"rows_read": 2, "rows_kept": 1}
    assert counts["raw_prescribers_drug"] == {"rows_read": 2, "rows_kept": 1}
    params = params_for(spark, out)
    assert params.analysis_years == tuple(years) and params.prescriber_release_year == 2023
    prj = Project(spark, RawSources.from_directory(spark, out), params)
    rows = prj.model("stg_drug_spending").orderBy("drug_year").collect()
    assert [(r.drug_year, r.manufacturer_name, r.manufacturer_count, int(r.total_spending)) for r in rows] == [
        (y, "Acme", 3, 100 * (i + 1)) for i, y in enumerate(years)]
    assert [(r.npi, r.last_name_or_org, r.specialty) for r in prj.model("stg_prescribers").collect()] == [("1", "Doe, J", "Dermatology")]
    assert [r.generic_name for r in prj.model("stg_prescriber_drugs").collect()] == ["ASPIRIN"]
    with open(paths["seed_state_region_map"], "w") as f:
        f.write("state_abbrev,state_name\nNY,x\n")
    with pytest.raises(MissingColumnError):
        RawSources.from_csv(spark, paths, years)["seed_state_region_map"]


def test_rejected_rows_and_casts_are_counted(spark, tmp_dir):
    from claimlake.plans.build import ingest_checks, ingest_csv
    years, paths = _delivery(tmp_dir)
    with open(paths["raw_prescribers"]) as f:
        header, first, second = f.read().splitlines()
    cells = first.split(",")
    at = header.split(",").index("tot_clms")
    wrong = [",".join([*cells[:at], "seven", *cells[at + 1:]]), ",".join([*cells[:at], "7.5x", *cells[at + 1:]])]
    blank = ",".join([*cells[:at], "  ", *cells[at + 1:]])
    with open(paths["raw_prescribers"], "w") as f:
        f.write("\n".join([header, first, second, *wrong, blank, "only,three,fields"]) + "\n")
    with open(paths["seed_therapeutic_area_map"], "a") as f:
        f.write("perhaps,Pain,Ibuprofen,false\n")
    out = os.path.join(tmp_dir, "raw")
    counts = ingest_csv(spark, paths, years, out)
    assert counts["raw_prescribers"]["rows_read"] == 6
    found = {(r.model, r.column_name): (r.violations, r.status) for r in ingest_checks(spark, out).collect()}
    assert {k: v for k, v in found.items() if v[0]} == {
        ("raw_prescribers", "tot_clms"): (2, "warn"), ("raw_prescribers", "malformed row"): (1, "warn"),
        ("seed_therapeutic_area_map", "is_focus_area"): (1, "warn")}
    assert found["raw_prescribers", "tot_benes"] == (0, "pass")
    rejected = spark.read.parquet(os.path.join(out, "_rejected", "raw_prescribers"))
    assert sorted(r._rejected_for for r in rejected.collect()) == [["malformed row"], ["tot_clms"], ["tot_clms"]]
    assert sorted(os.listdir(os.path.join(out, "_rejected"))) == ["raw_prescribers", "seed_therapeutic_area_map"]
    assert "_rejected_for" not in spark.read.parquet(os.path.join(out, "raw_prescribers")).columns


def test_order_lines_are_dealt_by_their_number(spark, tmp_dir, monkeypatch):
    """Twice the lines go to twice the tasks, each with about as many lines; nothing is lost or repeated."""
    from claimlake.sources import fixtures, tables
    monkeypatch.setattr(tables, "LINES_PER_TASK", 50)
    monkeypatch.setattr(tables, "LEAST_TASKS", 2)
    for n in (1000, 2000):
        path = os.path.join(tmp_dir, str(n))
        k = spark.range(n).repartition(3)
        k.selectExpr("id div 2 as l_orderkey", "id % 7 as l_partkey", "id % 3 as l_suppkey", "cast(id % 2 as int) as l_linenumber",
                     "1d as l_quantity", "2d as l_extendedprice", "'R' as l_returnflag", "'F' as l_linestatus",
                     "timestamp'1996-01-01' as l_shipdate").write.parquet(f"{path}/lineitem.parquet")
        spark.range(n // 2).selectExpr("id as o_orderkey", "id % 11 as o_custkey").write.parquet(f"{path}/orders.parquet")
        dealt = [len(x) for x in fixtures._order_lines(tables.DriverTables(spark, path)).rdd.glom().collect()]
        assert len(dealt) == n // 50 and sum(dealt) == n and max(dealt) < 200
    assert tables.DriverTables(spark, path).line_tasks() == 40


def test_prescriber_lines_are_shuffled_once(spark):
    """Before: by order, by drug and by customer. Null and unknown customers, null drugs, a hot customer, repeated customers."""
    import random
    from types import SimpleNamespace

    from claimlake.sources import fixtures
    rng = random.Random(2)
    people = [(i, f"C{i}", i % 3, "X") for i in range(1, 9)] + [(3, "C3", 0, "X"), (None, "none", 1, "X")]
    lines = [(rng.choice([1, 1, 1, 2, 3, 4, 99, None]), rng.choice(["red ring", "old bolt", "", None]), rng.choice([None, "b", " Brand c"]),
              rng.choice([1, 2, 3, 3, None]), rng.choice([1.0, 2.0, None]), rng.choice([10.25, 3.0, None])) for _ in range(600)]
    t = SimpleNamespace(line_tasks=lambda: 8, customer=spark.createDataFrame(people, "c_custkey long, c_name string, c_nationkey long, c_mktsegment string"),
                        nation=spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey long, n_name string"))
    base = spark.createDataFrame(lines, "o_custkey long, p_name string, brnd_name string, o_orderkey long, l_quantity double, l_extendedprice double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = fixtures.prescriber_drugs(t, base)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(repr((r.prscrbr_npi, r.prscrbr_last_org_name, r.prscrbr_state_abrvtn, r.gnrc_name, r.brnd_name, r.tot_clms, r.tot_benes,
                           r.tot_day_suply, r.tot_drug_cst and float(r.tot_drug_cst))) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    groups = {}
    for cust, *rest in lines:
        groups.setdefault((cust, *rest[:2]), []).append(rest[2:])

    def total(values):
        seen = [v for v in values if v is not None]
        return sum(seen) if seen else None
    want = []
    for key, name, nation, _ in people:
        for (cust, drug, brand), own in groups.items():
            if cust == key and key is not None and nation < 2:
                days, cost = total(q for _, q, _ in own), total(p for _, _, p in own)
                want.append(repr((str(key), name, "AB"[nation], drug, brand, len(own), len({o for o, _, _ in own if o is not None}),
                                  days if days is None else int(days), cost)))
    assert got == sorted(want) != []
    # The lines' shuffle and the customers'.
    assert plan.count("Exchange hashpartitioning") == 2
