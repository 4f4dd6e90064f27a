"""Marts refreshed from changed rows: equal to a rebuild, only touched years rewritten."""

import random

import pytest
from pyspark.sql import functions as F

from claimlake.operators.maintained import (SIGN, Grouped, changed_sources, grouped_result, merge_state, partial_results,
                                            signed_changes, signed_rows)
from claimlake.plans.catalog import comparable, project
from claimlake.plans.extra_queries import FIRST_LOAD_ORDERED_UNTIL
from claimlake.plans.maintained import MAINTAINED, maintained_mart, refresh_mart, start_mart
from claimlake.plans.project import Project
from claimlake.plans.snapshots import _folders
from claimlake.sources.raw import RawSources
from tests.conftest import SF_SMALL

SCHEMA = "id string, g string, y int, v decimal(18,2), w bigint, d string"


def spec():
    return Grouped(["y", "g"], {"v": F.col("v"), "w": F.col("w")}, {"ds": F.col("d"), "ws": F.col("w")})


def rebuilt(df):
    return df.groupBy("y", "g").agg(F.sum("v").alias("v"), F.sum("w").alias("w"), F.count("v").alias("v__n"),
                                    F.count("w").alias("w__n"), F.count_distinct("d").alias("ds"), F.count_distinct("w").alias("ws"))


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, (tuple(r) for r in df.select(*cols).collect())))


def made(rng, n):
    g = [None, "hot", "hot", "hot", "a", "b", ""]
    return {f"k{i}": (f"k{i}", rng.choice(g), rng.choice([2020, 2021, 2022]), rng.choice([None, 1, 2.5, -3]),
                      rng.choice([None, 0, 7, 9]), rng.choice([None, "", "x", "y"])) for i in range(n)}


def frame(spark, data):
    from decimal import Decimal
    return spark.createDataFrame([(*r[:3], None if r[3] is None else Decimal(str(r[3])), *r[4:]) for r in data.values()], SCHEMA)


def test_changes_add_up_to_a_rebuild(spark):
    """New, changed, equal and vanished rows; null keys, measures and values; groups and values that end."""
    rng = random.Random(3)
    data = made(rng, 60)
    state = merge_state(None, partial_results(signed_rows(None, frame(spark, data), "id"), spec()), spec())
    for _ in range(2):
        after = {k: v for k, v in data.items() if rng.random() < 0.7}
        after |= {k: v for k, v in made(rng, 80).items() if rng.random() < 0.3}
        old, new = frame(spark, data), frame(spark, after)
        gone = old.join(new.select("id"), "id", "left_anti")
        change = partial_results(signed_rows(old, changed_sources(old, new, "id"), "id", gone), spec())
        state, data = merge_state(state, change, spec()), after
        assert rows(grouped_result(state, spec())) == rows(rebuilt(new))
    old = frame(spark, data)
    none = old.limit(0)
    change = partial_results(signed_rows(old, changed_sources(none, none, "id"), "id", old), spec())
    assert merge_state(state, change, spec()).count() == 0


def test_equal_rows_change_nothing(spark):
    df = frame(spark, made(random.Random(5), 50))
    assert changed_sources(df, df, "id").count() == 0


def test_unknown_rows_and_floats_are_refused(spark):
    one = frame(spark, {"a": ("a", "g", 2020, 1, 1, "x")})
    minus = partial_results(one.withColumn(SIGN, F.lit(-1)), spec())
    with pytest.raises(Exception, match="not stored"):
        merge_state(None, minus, spec()).collect()
    with pytest.raises(ValueError, match="floating-point"):
        partial_results(one.withColumn(SIGN, F.lit(1)), Grouped(["y"], {"v": F.col("v").cast("double")}))


@pytest.fixture(scope="module")
def loads(spark):
    late = project(spark, SF_SMALL)
    early = Project(spark, RawSources.from_driver_tables(spark, SF_SMALL, FIRST_LOAD_ORDERED_UNTIL), late.params)
    for p in (early, late):
        p.checkpoint(["int_drug_enriched", "int_prescriber_drug_detail"])
    return early, late


@pytest.mark.parametrize("name", sorted(MAINTAINED))
def test_refreshed_mart_equals_rebuild(loads, name, tmp_dir):
    early, late = loads
    source = MAINTAINED[name].source
    stored, delivered = early.model(source), late.model(source)
    start_mart(late, tmp_dir, name, "2024-01-01 00:00:00", stored)
    before = _folders(late.spark, tmp_dir, 1)
    assert refresh_mart(late, tmp_dir, name, "2025-01-01 00:00:00", stored, delivered) == 2
    after = _folders(late.spark, tmp_dir, 2)
    got = maintained_mart(late, tmp_dir, name)
    assert got.columns == late.model(name).columns and got.dtypes == late.model(name).dtypes
    assert rows(comparable(got)) == rows(comparable(late.model(name))) != []
    assert rows(comparable(maintained_mart(late, tmp_dir, name, 1))) == rows(comparable(early.model(name)))
    key = MAINTAINED[name].source_year
    changed = {r[0] for r in changed_sources(stored, delivered, "drug_spending_key" if source == "int_drug_enriched" else
                                             "prescriber_drug_key").select(key).distinct().collect()}
    # Years without a changed row keep their folder.
    assert all(after[y] == before[y] for y in before if y not in changed)
    # A delivery of what is stored writes a version and no data.
    assert refresh_mart(late, tmp_dir, name, "2026-01-01 00:00:00", delivered, delivered) == 3
    assert _folders(late.spark, tmp_dir, 3) == after
    # Back to the first load by a complete delivery.
    refresh_mart(late, tmp_dir, name, "2027-01-01 00:00:00", delivered, stored, complete=True)
    assert rows(comparable(maintained_mart(late, tmp_dir, name))) == rows(comparable(early.model(name)))


def test_untouched_years_are_kept(loads, tmp_dir):
    _, late = loads
    name = "mart_drug_spending_trends"
    stored = late.model("int_drug_enriched")
    start_mart(late, tmp_dir, name, "2024-01-01 00:00:00")
    before = _folders(late.spark, tmp_dir, 1)
    year = stored.where("total_beneficiaries >= 11").agg(F.max("drug_year")).first()[0]
    delivered = stored.where(F.col("drug_year") == year).withColumn("total_claims", F.col("total_claims") + 1)
    refresh_mart(late, tmp_dir, name, "2025-01-01 00:00:00", stored, delivered)
    after = _folders(late.spark, tmp_dir, 2)
    assert {y for y in after if after[y] != before.get(y)} == {year} and set(after) == set(before)
    with pytest.raises(ValueError, match="already"):
        start_mart(late, tmp_dir, name, "2026-01-01 00:00:00")


@pytest.mark.parametrize("name", sorted(MAINTAINED))
def test_queries_derive_the_stored_rows_once(spark, name, monkeypatch):
    from claimlake.plans import extra_queries as E
    given = []
    monkeypatch.setattr(E, "start_mart", lambda prj, root, mart, at, stored: given.append(stored))
    monkeypatch.setattr(E, "refresh_mart", lambda prj, root, mart, at, stored, delivered: given.append(stored))
    monkeypatch.setattr(E, "maintained_mart", lambda prj, root, mart: prj.spark.range(1))
    E.QUERIES[name.replace("mart_", "maintained_", 1)](spark, SF_SMALL)
    assert len(given) == 2 and all(files and all("/stored/" in f for f in files) for files in (g.inputFiles() for g in given))


@pytest.mark.parametrize("complete", [False, True])
def test_one_pass_finds_the_same_changes(spark, complete):
    """Repeated rows and keys, null keys and values, vanished keys: as the comparison and the two joins find them."""
    rng = random.Random(11)
    def table(n):
        return [(None if rng.random() < 0.05 else f"k{rng.randrange(n)}", rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]))
                for _ in range(2 * n)]
    for _ in range(3):
        old, new = (spark.createDataFrame(table(40), "id string, g string, w bigint") for _ in range(2))
        gone = old.join(new.select("id"), "id", "left_anti") if complete else None
        want = signed_rows(old, changed_sources(old, new, "id"), "id", gone)
        got = signed_changes(old, new, "id", complete)
        assert rows(got) == rows(want) != [] and got.dtypes == want.dtypes


def test_a_refresh_shuffles_each_source_row_once(loads, tmp_dir, monkeypatch):
    """Before: the delivered rows whole, the stored rows' keys and fingerprints, then the stored rows again for every aggregate."""
    from claimlake.plans import maintained as M
    _, late = loads
    name, plans = "mart_geographic_distribution", []
    detail = late.model("int_prescriber_drug_detail")
    monkeypatch.setattr(M, "_apply", lambda prj, root, mart, signed, at: plans.append(signed))
    monkeypatch.setattr(M, "signed_changes", lambda *a: plans.append(signed_changes(*a)) or plans[0])
    refresh_mart(late, tmp_dir, name, "2025-01-01 00:00:00", detail, detail.withColumn("specialty", F.lit("x")))
    pass_, applied = plans
    assert pass_._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert len(pass_.columns) == 13 and "Join" not in applied._jdf.queryExecution().executedPlan().toString()
    assert applied.isEmpty()                # no column that the mart reads differs


def test_a_refresh_compares_keys_by_16_bytes(loads, tmp_dir, monkeypatch):
    """Before: the key as text, 32 characters of 83 bytes a shuffled row; many stored rows are dealt over more tasks."""
    from claimlake.plans import maintained as M
    _, late = loads
    name, passes = "mart_geographic_distribution", []
    detail = late.model("int_prescriber_drug_detail")
    monkeypatch.setattr(M, "STORED_PER_TASK", 20)
    monkeypatch.setattr(M, "_apply", lambda prj, root, mart, signed, at: passes.append(signed))
    monkeypatch.setattr(M, "signed_changes", lambda *a: passes.append(signed_changes(*a)) or passes[0])
    changed = detail.withColumn("total_claims", F.when(F.col("npi") > "2", F.col("total_claims") + 1).otherwise(F.col("total_claims")))
    refresh_mart(late, tmp_dir, name, "2025-01-01 00:00:00", detail, changed)
    pass_, applied = passes
    assert pass_.schema["prescriber_drug_key"].dataType.typeName() == "binary" and pass_.agg(F.max(F.length("prescriber_drug_key"))).first()[0] == 16
    n = detail.where("npi > '2'").count()
    assert 0 < n < detail.count() and pass_.rdd.getNumPartitions() == -(-detail.count() // 20) > 4
    assert {(r[0], r[1]) for r in applied.groupBy(SIGN).count().collect()} == {(1, n), (-1, n)}


def test_a_state_is_merged_and_dealt_by_year_in_one_shuffle(spark):
    """Before: a shuffle for the sums and one for the folders of the years."""
    rng = random.Random(9)
    old, new = (partial_results(frame(spark, made(rng, 60)).withColumn(SIGN, F.lit(1)), spec()).localCheckpoint() for _ in range(2))
    plain, dealt = merge_state(old, new, spec()), merge_state(old, new, spec(), ranged_by="y")
    assert rows(dealt) == rows(plain) and dealt.dtypes == plain.dtypes
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning(y") == 1
