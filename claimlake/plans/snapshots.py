"""Snapshot runs: merge a load into the history, year by year, as a new version.

The history is kept in one folder for each year and rewrite. A load is first reduced to its new and
changed rows; only the years that hold one are read, merged with ``scd2_apply`` and written to new
folders. A version is a small manifest (JSON lines: year, folder) that names the new folders for
these years and the old ones for all others; an unchanged load writes a manifest and no data. The manifest
is created under its version number without overwriting, so of two runs that start from the same version the
second fails and changes nothing. No job overwrites what any version reads: every version stays
readable by number or by time.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import VALID_TO, as_of, assert_unique_keys, changed_rows, fingerprint, scd2_apply
from ..session import shared_dir
from .project import Project

SNAPSHOT_KEYS = ("generic_name", "brand_name", "manufacturer_name", "drug_year")
SNAPSHOT_CHECK_COLS = ("avg_spending_per_claim", "avg_spending_per_beneficiary", "total_spending")
SNAPSHOT_COLS = SNAPSHOT_KEYS + ("total_claims", "total_beneficiaries", "total_spending",
                                 "avg_spending_per_claim", "avg_spending_per_beneficiary")
YEAR, PRINT, LOG = "drug_year", "_fingerprint", "_versions"
_ENTRY = "version int, load_ts string, year int, path string"


class VersionTakenError(RuntimeError):
    """Another run has committed the version this run was about to write."""


def snapshot_source(prj: Project) -> DataFrame:
    """The watched columns of the staged drug spending (unique per key)."""
    return prj.model("stg_drug_spending").select(*SNAPSHOT_COLS)


def written_once(spark: SparkSession, load: DataFrame) -> DataFrame:
    """A load as a table of the shared folder: its key check, comparison and merge read that, not what it is derived from."""
    path = shared_dir(spark, f"load-{uuid.uuid4().hex}")
    load.write.parquet(path)
    return _read(spark, load.schema, [path])


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The version log: ``version``, ``load_ts``, ``year`` and ``path`` (one row a year; a version of an empty
    history has one row without a year)."""
    try:
        return spark.read.schema(_ENTRY).json(os.path.join(root, LOG))
    except AnalysisException:               # no run yet
        return spark.createDataFrame([], _ENTRY)


def current_version(spark: SparkSession, root: str) -> int:
    return versions(spark, root).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def _folders(spark: SparkSession, root: str, version: int) -> dict[int, str]:
    """Year -> folder of one version (as many rows as the history has years)."""
    rows = versions(spark, root).where((F.col("version") == version) & F.col("year").isNotNull()).collect()
    return {r["year"]: r["path"] for r in rows}


def _commit(spark: SparkSession, root: str, version: int, load_ts: str, folders: dict[int, str]) -> None:
    """Create the manifest; the file system refuses a second file of the name."""
    entries = [{"version": version, "load_ts": load_ts, "year": y, "path": p} for y, p in sorted(folders.items())]
    text = "\n".join(map(json.dumps, entries or [{"version": version, "load_ts": load_ts}])) + "\n"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(root, LOG, f"v{version:06d}.json"))
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        out = fs.create(path, False)
    except Exception as e:
        if fs.exists(path):
            raise VersionTakenError(f"{root}: version {version} exists already") from e
        raise
    out.write(bytearray(text.encode()))
    out.close()


def _read(spark: SparkSession, schema, folders: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders)


def run_snapshot(prj: Project, root: str, load_ts: str, load: DataFrame | None = None) -> int:
    """Merge one load at ``load_ts``; return the new version's number. Null years can't be kept and fail."""
    spark = prj.spark
    src = written_once(spark, (load if load is not None else snapshot_source(prj)).select(*SNAPSHOT_COLS))
    assert_unique_keys(src, SNAPSHOT_KEYS)
    version = current_version(spark, root)
    folders = _folders(spark, root, version)
    ts = F.lit(load_ts)
    schema = scd2_apply(None, src, SNAPSHOT_KEYS, SNAPSHOT_CHECK_COLS, ts, check_duplicates=False).withColumn(PRINT, F.lit("")).schema
    if folders:
        whole = _read(spark, schema, list(folders.values()))
        fresh = changed_rows(whole.where(F.col(VALID_TO).isNull()), src, SNAPSHOT_KEYS, SNAPSHOT_CHECK_COLS, PRINT)
    else:
        fresh = src
    touched = [r[0] for r in fresh.select(YEAR).distinct().collect()]        # years, not rows
    if None in touched:
        raise ValueError("a row of the load has no year")
    if touched:
        old = [folders[y] for y in touched if y in folders]
        before = _read(spark, schema, old).drop(PRINT) if old else None
        merged = scd2_apply(before, src.where(F.col(YEAR).isin(*touched)), SNAPSHOT_KEYS, SNAPSHOT_CHECK_COLS, ts, check_duplicates=False)
        target = os.path.join(root, f"data-{uuid.uuid4().hex}")
        (merged.withColumn(PRINT, fingerprint(*SNAPSHOT_CHECK_COLS)).withColumn("_year", F.col(YEAR))
         .repartitionByRange("_year", F.xxhash64(*SNAPSHOT_KEYS)).write.partitionBy("_year").parquet(target))
        folders = folders | {y: os.path.join(target, f"_year={y}") for y in touched}
    _commit(spark, root, version + 1, load_ts, folders)
    return version + 1


def version_at(spark: SparkSession, root: str, ts: str) -> int:
    """The newest version whose load time is not after ``ts``."""
    t = F.to_timestamp_ntz(F.lit(ts))
    found = versions(spark, root).where(F.to_timestamp_ntz("load_ts") <= t).agg(F.max("version")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no version of {root} at {ts}")
    return found


def history(prj: Project, root: str, version: int | None = None, at: str | None = None) -> DataFrame:
    """The history as the newest version has it, or an earlier one by number or by time."""
    spark = prj.spark
    if version is None:
        version = version_at(spark, root, at) if at is not None else current_version(spark, root)
    known = versions(spark, root).where(F.col("version") == version)
    if known.isEmpty():
        raise FileNotFoundError(f"no version {version} of {root}")
    schema = scd2_apply(None, snapshot_source(prj), SNAPSHOT_KEYS, SNAPSHOT_CHECK_COLS, F.lit("2000-01-01 00:00:00"),
                        check_duplicates=False).schema
    folders = list(_folders(spark, root, version).values())
    return _read(spark, schema, folders) if folders else spark.createDataFrame([], schema)


def history_as_of(prj: Project, root: str, ts: str) -> DataFrame:
    """Rows as they were at ``ts`` (for example, the cost of a drug in an earlier year)."""
    return as_of(history(prj, root), ts)
