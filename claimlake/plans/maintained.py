"""Marts refreshed from changed rows instead of rebuilt.

Each mart here has a state (``operators/maintained.py``) kept in one folder for each year and rewrite, with the
version log of ``snapshots.py``: a refresh reads and writes the years that hold a changed row and
names the old folders for all others; a refresh without changes writes a manifest and no data; the
second of two simultaneous runs fails and changes nothing. The mart's own columns are computed
from the state when it is read, by the same functions as in a full build.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..operators.maintained import (SEEN, Grouped, grouped_result, merge_state, partial_results,
                                    signed_changes, signed_rows)
from ..session import shared_dir
from . import marts
from .project import MODELS, Project
from .snapshots import _commit, _folders, current_version

YEAR = "drug_year"
#: A task of a refresh holds its rows twice, to count and to sort them: nothing spills.
STORED_PER_TASK = 100_000


@dataclass(frozen=True)
class MaintainedMart:
    """``rows`` turns rows of the model ``source`` (signed or not) into those that the mart counts, from the columns ``reads``;
    ``spec`` says what is kept; ``finish`` makes the mart of one row per group."""
    source: str
    source_year: str
    reads: tuple[str, ...]
    rows: Callable[[Project, DataFrame], DataFrame]
    spec: Callable[[], Grouped]
    finish: Callable[[DataFrame], DataFrame]


def _drug_rows(prj: Project, drugs: DataFrame) -> DataFrame:
    return marts.suppressed(prj, drugs)


def _drug_rows_by_area(prj: Project, drugs: DataFrame) -> DataFrame:
    return marts.suppressed(prj, drugs).withColumn("therapeutic_area", marts._area_or_other())


def _exact(c: str):
    return F.col(c).cast("decimal(38,4)")


def _if(cond, c: str, zero=None):
    return F.when(cond, F.col(c)).otherwise(marts._zero() if zero is None else zero)


def _mean(name: str, out: str):
    return ratio(F.col(name), F.col(name + SEEN), 2).alias(out)


def _drug_sums() -> dict:
    return {"total_claims": F.col("total_claims"), "total_beneficiaries": F.col("total_beneficiaries"),
            "total_spending": F.col("total_spending"), "cost_per_claim": _exact("cost_per_claim"),
            "monthly": _exact("cost_per_beneficiary_monthly")}


def _trends_spec() -> Grouped:
    spec, brand = F.col("is_specialty_drug"), F.col("brand_generic_flag")
    return Grouped([YEAR, "therapeutic_area", "is_focus_area"], _drug_sums() | {
        "specialty_spending": _if(spec, "total_spending"), "non_specialty_spending": _if(~spec, "total_spending"),
        "brand_spending": _if(brand == "Brand", "total_spending"),
        "generic_spending": _if(brand == "Generic", "total_spending")}, {"distinct_drugs": F.col("generic_name")})


def _trends(g: DataFrame) -> DataFrame:
    return marts.spending_trends_columns(g.select(
        YEAR, "therapeutic_area", "is_focus_area", "distinct_drugs", "total_claims", "total_beneficiaries",
        "total_spending", _mean("cost_per_claim", "avg_cost_per_claim"), _mean("monthly", "avg_monthly_cost_per_bene"),
        "specialty_spending", "non_specialty_spending", "brand_spending", "generic_spending"))


def _mix_spec() -> Grouped:
    return Grouped([YEAR, "therapeutic_area", "brand_generic_flag"], _drug_sums(), {"drug_count": F.col("generic_name")})


def _mix(g: DataFrame) -> DataFrame:
    return marts.area_mix_columns(g.select(
        YEAR, "therapeutic_area", "brand_generic_flag", "drug_count", "total_claims", "total_spending",
        "total_beneficiaries", _mean("cost_per_claim", "avg_cost_per_claim"), _mean("monthly", "avg_monthly_cost")))


_GEO_KEYS = [YEAR, "state", "census_region", "therapeutic_area", "is_focus_area"]
_GEO_SUMS = ["total_claims", "total_drug_cost", "total_beneficiaries", "total_day_supply"]


def _geo_spec() -> Grouped:
    return Grouped(_GEO_KEYS, {c: F.col(c) for c in _GEO_SUMS},
                   {"prescriber_count": F.col("npi"), "distinct_drugs": F.col("generic_name")})


def _geo(g: DataFrame) -> DataFrame:
    sums = [F.col(c).cast("decimal(38,2)").alias(c) if c == "total_drug_cost" else c for c in _GEO_SUMS]   # as the mart has it
    return marts.geography_columns(g.select(*_GEO_KEYS, "prescriber_count", *sums, "distinct_drugs"))


def _scorecard_spec() -> Grouped:
    focus = F.col("is_focus_area")
    return Grouped([YEAR], _drug_sums() | {
        "specialty_spending": _if(F.col("is_specialty_drug"), "total_spending"),
        "brand_spending": _if(F.col("brand_generic_flag") == "Brand", "total_spending"),
        "focus_area_spending": _if(focus, "total_spending"), "focus_area_claims": _if(focus, "total_claims", F.lit(0))},
        {"total_drugs": F.col("generic_name"), "therapeutic_area_count": F.col("therapeutic_area")})


def _scorecard(g: DataFrame) -> DataFrame:
    return g.select(
        YEAR, "total_claims", "total_beneficiaries", "total_spending", _mean("cost_per_claim", "avg_cost_per_claim"),
        _mean("monthly", "avg_monthly_cost_per_bene"),
        ratio("specialty_spending", "total_spending", 1, 100).alias("specialty_spending_pct"),
        ratio("brand_spending", "total_spending", 1, 100).alias("brand_spending_pct"),
        "focus_area_spending", "focus_area_claims", "total_drugs", "therapeutic_area_count")


_DRUG_READS = ("generic_name", "brand_generic_flag", "therapeutic_area", "is_specialty_drug", "is_focus_area", "total_claims",
               "total_beneficiaries", "total_spending", "cost_per_claim", "cost_per_beneficiary_monthly")
#: What goes together stands together: a shuffled row is smaller.
_GEO_READS = ("npi", "state", "census_region", "generic_name", "therapeutic_area", "is_focus_area", *_GEO_SUMS)

MAINTAINED = {
    "mart_drug_spending_trends": MaintainedMart("int_drug_enriched", YEAR, _DRUG_READS, _drug_rows_by_area, _trends_spec, _trends),
    "mart_therapeutic_area_mix": MaintainedMart("int_drug_enriched", YEAR, _DRUG_READS, _drug_rows_by_area, _mix_spec, _mix),
    "mart_geographic_distribution": MaintainedMart("int_prescriber_drug_detail", "prescriber_drug_year", _GEO_READS,
                                                   lambda prj, d: marts.geography_rows(d), _geo_spec, _geo),
    "mart_kpi_scorecard": MaintainedMart("int_drug_enriched", YEAR, _DRUG_READS, _drug_rows, _scorecard_spec, _scorecard),
}


def _state(spark: SparkSession, folders, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders)


def _apply(prj: Project, root: str, name: str, signed: DataFrame, load_ts: str) -> int:
    """Add signed source rows to the state under ``root``; return the new version's number."""
    spark, mart = prj.spark, MAINTAINED[name]
    spec = mart.spec()
    version = current_version(spark, root)
    folders = _folders(spark, root, version)
    change = partial_results(mart.rows(prj, signed), spec)
    schema, target = change.schema, os.path.join(root, f"data-{uuid.uuid4().hex}")
    # The change is written once: its years are read from it, then its rows.
    aside = shared_dir(spark, f"change-{uuid.uuid4().hex}")
    change.write.parquet(aside, compression="zstd")
    change = spark.read.schema(schema).parquet(aside)
    touched = [r[0] for r in change.select(YEAR).distinct().collect()]        # years, not rows
    if None in touched:
        raise ValueError("a changed row has no year")
    if touched:
        before = [folders[y] for y in touched if y in folders]
        merged = merge_state(_state(spark, before, schema) if before else None, change, spec, ranged_by=YEAR)
        merged.withColumn("_year", F.col(YEAR)).write.partitionBy("_year").parquet(target)
        left = {r[0] for r in spark.read.schema(schema).parquet(target).select(YEAR).distinct().collect()}
        folders = {y: p for y, p in folders.items() if y not in touched} | {
            y: os.path.join(target, f"_year={y}") for y in left}
    _commit(spark, root, version + 1, load_ts, folders)
    return version + 1


def start_mart(prj: Project, root: str, name: str, load_ts: str, source: DataFrame | None = None) -> int:
    """The first version of a mart's state, from all rows of its source."""
    if current_version(prj.spark, root):
        raise ValueError(f"{root} holds a mart already")
    rows = source if source is not None else prj.model(MAINTAINED[name].source)
    return _apply(prj, root, name, signed_rows(None, rows, MODELS[MAINTAINED[name].source].key), load_ts)


def refresh_mart(prj: Project, root: str, name: str, load_ts: str, stored: DataFrame, delivered: DataFrame,
                 complete: bool = False) -> int:
    """Bring a mart's state from the source rows ``stored`` to those after a delivery.

    A delivered row replaces the stored row of its key; an equal one changes nothing; stored rows of other keys stay, or
    go if the delivery is ``complete``. Both tables are read once, in the key and the columns that the mart reads; a row
    that differs elsewhere only is equal. The state needs the very
    ``stored`` rows it was built from: a change that takes away others than these is an error where it shows."""
    mart, spark = MAINTAINED[name], prj.spark
    key = MODELS[mart.source].key
    # Keys are compared by 128 bits of them: as text they would be the better part of a shuffled row.
    counted = [F.unhex(F.md5(F.col(key).cast("string"))).alias(key), mart.source_year, *mart.reads]
    tasks = -(-stored.count() // STORED_PER_TASK)
    signed = signed_changes(stored.select(*counted), delivered.select(*counted), key, complete, tasks).drop(key)
    # Written once: sums and counted values are read from it apart.
    aside = shared_dir(spark, f"changed-{uuid.uuid4().hex}")
    signed.write.parquet(aside, compression="zstd")
    return _apply(prj, root, name, spark.read.schema(signed.schema).parquet(aside), load_ts)


def maintained_mart(prj: Project, root: str, name: str, version: int | None = None) -> DataFrame:
    """The mart as its newest state has it, or an earlier version."""
    spark, mart = prj.spark, MAINTAINED[name]
    spec = mart.spec()
    version = current_version(spark, root) if version is None else version
    folders = list(_folders(spark, root, version).values())
    empty = prj.model(mart.source).limit(0).withColumn("_sign", F.lit(1))
    schema = partial_results(mart.rows(prj, empty), spec).schema
    state = _state(spark, folders, schema) if folders else spark.createDataFrame([], schema)
    return mart.finish(grouped_result(state, spec))
