"""Full project build: ingest inputs, then staging views, intermediate and mart tables.

Mirrors the layer materialisation of the original project: staging models stay lazy
(views), intermediate models are written once and re-read by every mart that uses them,
marts are written as tables (with a load timestamp). Independent tables of a layer are
written concurrently from ``threads`` driver threads (the original runs its models on 4
to 8 threads); Spark interleaves the jobs' tasks on the free cores.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import rejection_checks
from ..params import DEFAULT, FIXTURE, Params
from ..sources.raw import INPUTS, RawSources
from ..sources.sinks import AUDIT_COLUMN, with_audit, write_table
from .project import MODELS, Project, _ensure_loaded, select_models


# Physical layout of the large, year-grained tables: year partitions (pruned by the
# reports' year filters) and a clustering sort across and inside files (file and row-group skipping).
LAYOUT = {
    "int_drug_enriched": (("drug_year",), ("therapeutic_area", "generic_name")),
    # One release year per load: clustered by what its marts group and filter on.
    "int_prescriber_drug_detail": ((), ("therapeutic_area", "state", "npi")),
    "mart_cost_per_claim": (("drug_year",), ("therapeutic_area", "generic_name")),
    "mart_specialty_vs_generic": (("drug_year",), ("spending_rank",)),
    "mart_manufacturer_performance_report": (("drug_year",), ("therapeutic_area", "generic_name")),
    "mart_dq_anomalies": (("drug_year",), ("therapeutic_area", "generic_name")),
    "mart_day_supply_efficiency": ((), ("drug_year", "state")),
    "mart_geographic_distribution": ((), ("drug_year", "state")),
    "mart_brand_generic_ratio": ((), ("drug_year", "state")),
}


INGEST_CHECKS = "_ingest_checks"


def _run_concurrently(jobs: dict[str, Callable[[], None]], threads: int) -> dict[str, float]:
    """Run independent write jobs; seconds per job (jobs overlap when threads > 1)."""
    def timed(item):
        name, fn = item
        t0 = time.time()
        fn()
        return name, time.time() - t0

    if threads <= 1:
        return dict(map(timed, jobs.items()))
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(pool.map(timed, jobs.items()))


def ingest(spark: SparkSession, sf_dir: str, out_dir: str,
           rows: dict[str, int] | None = None, threads: int = 4) -> dict[str, float]:
    """Derive the five inputs from the driver tables and write them as tables.

    The order-line join shared by the three extracts is written once (``_line_base``).
    Row counts are observed while each table is written (no extra pass) into ``rows``.
    """
    from ..operators.quality import observe_counts
    times = {}
    t0 = time.time()
    src = RawSources.from_driver_tables_via(spark, sf_dir, os.path.join(out_dir, "_line_base"))
    times["_line_base"] = time.time() - t0
    observed = {name: observe_counts(src[name], name) for name in INPUTS}
    # Each raw table carries its load time (the source freshness check reads it).
    jobs = {name: (lambda df=df, name=name: write_table(df, os.path.join(out_dir, name),
                                                         audit=True))
            for name, (df, _) in observed.items()}
    times.update(_run_concurrently(jobs, threads))
    if rows is not None:
        rows.update({name: obs.get["rows_read"] for name, (_, obs) in observed.items()})
    return times


def ingest_csv(spark: SparkSession, paths: dict[str, str], years: Sequence[int], out_dir: str,
               ) -> dict[str, dict[str, int]]:
    """Read delivered CSV files, filter them and write the five inputs as tables.

    Returns rows read and rows kept per input, observed while each table is written. The same pass counts the
    rows that are malformed and the values that do not cast; the counts are written as check rows
    (``_ingest_checks``, which the build adds to its check table), and the rows themselves to
    ``_rejected/<input>`` with their reasons, for inputs that have any.
    """
    seen: dict = {}
    src = RawSources.from_csv(spark, paths, years, rows=seen)
    for name in INPUTS:
        write_table(src[name], os.path.join(out_dir, name), audit=True)
    rejected = {n: {k: v for k, v in a.get.items() if k != "rows"} for n, (a, _) in seen.items()}
    write_table(rejection_checks(spark, rejected), os.path.join(out_dir, INGEST_CHECKS))
    for name, counts in rejected.items():
        if any(counts.values()):
            write_table(src.rejected(name), os.path.join(out_dir, "_rejected", name))
    return {n: {"rows_read": a.get["rows"], "rows_kept": b.get["rows"]} for n, (a, b) in seen.items()}


def ingest_checks(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """The check rows that a CSV ingest wrote beside its tables, if it did."""
    try:
        return spark.read.parquet(os.path.join(raw_dir, INGEST_CHECKS))
    except AnalysisException:
        return None


def params_for(spark: SparkSession, raw_dir: str, years: Sequence[int] = (),
               release_year: int | None = None) -> Params:
    """Project parameters of written inputs: the years asked for, else those the spending extract has
    columns for; the prescriber release year is the last of them unless given."""
    from ..operators.reshape import suffixes
    from ..sources.fixtures import SPENDING_STUBS
    if not years:
        wide = spark.read.parquet(os.path.join(raw_dir, "raw_part_d_spending"))
        years = [int(y) for y in suffixes(wide, SPENDING_STUBS) if y.isdigit()]
    if not years:
        raise ValueError(f"{raw_dir}: the spending extract has no year columns")
    return replace(DEFAULT, analysis_years=tuple(years), prescriber_release_year=release_year or max(years))


def build(spark: SparkSession, raw_dir: str, warehouse: str, params: Params = FIXTURE,
          tags: Sequence[str] = (), register_views: bool = True,
          run_checks: bool = True, threads: int = 4,
          snapshot_at: str | None = None) -> tuple[Project, dict[str, float]]:
    """Run every selected model layer by layer; return the project and seconds per model."""
    _ensure_loaded()
    prj = Project(spark, RawSources.from_directory(spark, raw_dir), params)
    times: dict[str, float] = {}
    specs = select_models(tags) if tags else list(MODELS.values())
    if register_views:
        for spec in [s for s in specs if s.layer == "staging"]:
            prj.model(spec.name).createOrReplaceTempView(spec.name)
    for layer in ("intermediate", "marts"):
        # Plans are built in this thread (reference-map checks run once, in order); the
        # writes of the layer's independent tables then run concurrently.
        frames = {s.name: prj.model(s.name) for s in specs if s.layer == layer}
        jobs = {name: (lambda name=name, df=df: _write_model(prj, layer, name, df, warehouse))
                for name, df in frames.items()}
        t0 = time.time()
        times.update(_run_concurrently(jobs, threads))
        times[f"layer_{layer}"] = time.time() - t0
    if run_checks and not tags:
        t0 = time.time()
        results, delivered = check_results(prj), ingest_checks(spark, raw_dir)
        write_table(results if delivered is None else results.unionByName(delivered), os.path.join(warehouse, "_check_results"))
        write_table(source_freshness(prj), os.path.join(warehouse, "_source_freshness"))
        times["checks"] = time.time() - t0
    if snapshot_at and not tags:
        from .snapshots import run_snapshot
        t0 = time.time()
        run_snapshot(prj, os.path.join(warehouse, "snapshots", "snap_drug_spending"), snapshot_at)
        times["snapshot"] = time.time() - t0
    return prj, times


def open_warehouse(spark: SparkSession, raw_dir: str, warehouse: str,
                   params: Params = FIXTURE) -> Project:
    """A project whose intermediate and mart models are served from a built warehouse."""
    _ensure_loaded()
    prj = Project(spark, RawSources.from_directory(spark, raw_dir), params)
    for spec in MODELS.values():
        path = os.path.join(warehouse, spec.layer, spec.name)
        if spec.layer == "staging":
            continue
        lazy = prj.model(spec.name)
        schema = with_audit(lazy).schema if spec.layer == "marts" else lazy.schema
        try:
            # Known schema: an empty partitioned table has no files to infer one from.
            df = spark.read.schema(schema).parquet(path)
        except AnalysisException:       # not built (a subset was selected): computed when read
            continue
        prj.use_table(spec.name, df.select(*lazy.columns))
    return prj


def _write_model(prj: Project, layer: str, name: str, df: DataFrame, warehouse: str) -> None:
    part, sort = LAYOUT.get(name, ((), ()))
    path = os.path.join(warehouse, layer, name)
    audit = layer == "marts"
    write_table(df, path, partition_by=part, sort_within=sort, audit=audit)
    # Read back with the known schema (an empty partitioned table has no files).
    schema = with_audit(df).schema if audit else df.schema
    back = prj.spark.read.schema(schema).parquet(path)
    prj.use_table(name, back.drop(AUDIT_COLUMN).select(*df.columns))


def source_freshness(prj: Project) -> DataFrame:
    """Freshness of each raw extract from its load timestamp (warn / error thresholds from
    the project parameters); a source without the column is reported as skipped."""
    from pyspark.sql import functions as F

    from ..operators.quality import freshness
    from ..sources.raw import RAW_TABLES
    out = None
    for name in RAW_TABLES:
        src = prj.raw(name)
        if AUDIT_COLUMN not in src.columns:
            src = src.withColumn(AUDIT_COLUMN, F.lit(None).cast("string"))
        part = freshness(src, AUDIT_COLUMN, prj.params.freshness_warn_days,
                         prj.params.freshness_error_days).select(
            F.lit(name).alias("source"), "max_loaded_at", "age_days", "status")
        out = part if out is None else out.unionByName(part)
    return out


def check_results(prj: Project) -> DataFrame:
    """All declared checks (12 staging, 34 mart, 2 custom) as one result table, reading
    the written tables (marts) and the staging views."""
    from .extra_queries import _run_checks, checks_custom, mart_checks, staging_checks
    return (_run_checks(prj, staging_checks(prj) + mart_checks())
            .unionByName(checks_custom(prj)))
