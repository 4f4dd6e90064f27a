"""Sinks: table writes by layer, CSV extracts, configurable targets, partition refresh."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clustering import cluster

AUDIT_COLUMN = "_loaded_at"


def with_audit(df: DataFrame, column: str = AUDIT_COLUMN) -> DataFrame:
    """Load timestamp added by the sink only (never part of compared query output)."""
    return df.withColumn(column, F.current_timestamp())


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), sort_within: Sequence[str] = (),
                audit: bool = False, interleave: Sequence[str] = (), files: int | None = None) -> str:
    """Full-replace table write; optional partition columns and clustering sort.

    ``partition_by=("drug_year",)`` lets year filters prune whole directories;
    ``sort_within`` clusters rows (for example by area or state) across and inside files so
    min/max statistics skip files and row groups. Rows are range-partitioned on the partition
    columns followed by the clustering columns (or a row hash), so a year holding a third
    of the table is written by many tasks, each producing its own file in that year's
    folder, instead of by one. ``interleave`` clusters by several columns at once instead, so that a filter
    on any of them skips files (``operators/clustering.py``).
    """
    out = with_audit(df) if audit else df
    if interleave:
        out = cluster(out, interleave, partition_by, files)
    elif partition_by:
        tail = [F.col(c) for c in sort_within] or [F.xxhash64(*[F.col(c) for c in df.columns])]
        out = out.repartitionByRange(*[F.col(c) for c in partition_by], *tail)
        out = out.sortWithinPartitions(*partition_by, *sort_within)
    elif sort_within:
        out = out.repartitionByRange(*sort_within).sortWithinPartitions(*sort_within)
    w = out.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       fmt: str = "parquet") -> str:
    """Incremental refresh: replace only the partitions present in ``df`` (delete+insert).

    Uses dynamic partition overwrite, so other years already in ``path`` stay untouched.
    """
    (df.write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).save(path))
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> str:
    """CSV extract with header (processed data copies, partner report exports)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", header).csv(path)
    return path


def write_to(df: DataFrame, target: Mapping) -> None:
    """Write to a configured target: ``{"format": ..., "path"|"table": ..., "options": {...}}``.

    Covers local files, catalog tables and external warehouses reached through a Spark
    data source (JDBC with ``batchsize``, or a connector format on the classpath).
    """
    fmt = target.get("format", "parquet")
    mode = target.get("mode", "overwrite")
    w = df.write.mode(mode).format(fmt).options(**dict(target.get("options", {})))
    if "table" in target and fmt != "jdbc":
        w.saveAsTable(target["table"])
    elif fmt == "jdbc":
        w.option("dbtable", target["table"]).save()
    else:
        w.save(target["path"])
