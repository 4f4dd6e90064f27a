"""Incremental refresh of a year-partitioned table from newly delivered extract files.

The data arrives as annual releases, so there is no continuous stream to follow. What an
incremental refresh needs is "process only the files not seen yet, then bring the affected
partitions up to date". Structured Streaming's file source with an ``availableNow``
trigger gives exactly that: the checkpoint (in the shared folder) remembers processed
files, each micro-batch is transformed with the normal batch operators, and
``foreachBatch`` merges it on the business key: a delivered row replaces the row of its key,
rows of other keys stay, so a year may come in any number of files, batches and runs. The merged
partitions are written aside before they replace the old ones; a batch that is replayed
after a failure starts from that copy.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_dir
from ..sources.sinks import refresh_partitions

_TIME, _FILE, _NTH = "_delivered_at", "_delivered_in", "_nth"


def merge_on_key(old: DataFrame | None, new: DataFrame, keys: Sequence[str],
                 partition_by: Sequence[str]) -> DataFrame:
    """The partitions that ``new`` touches, complete: its rows, the last delivered of each key,
    and the rows of ``old`` with other keys. Null keys match."""
    on = list(dict.fromkeys([*partition_by, *keys]))
    last = Window.partitionBy(*on).orderBy(F.desc(_TIME), F.desc(_FILE))
    new = new.withColumn(_NTH, F.row_number().over(last)).filter(F.col(_NTH) == 1).drop(_NTH, _TIME, _FILE)
    if old is None:
        return new

    def equal(cols: Sequence[str]):
        cond = None
        for c in cols:
            e = F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
            cond = e if cond is None else cond & e
        return cond
    touched = new.select(*partition_by).distinct().alias("n")
    kept = (old.alias("o").join(touched, equal(partition_by), "left_semi").alias("o")
            .join(new.select(*on).alias("n"), equal(on), "left_anti"))
    return new.unionByName(kept.select(*new.columns))


def refresh_from_drops(spark: SparkSession, source_dir: str, schema: StructType, target: str,
                       keys: Sequence[str], partition_by: Sequence[str] = ("drug_year",), fmt: str = "parquet",
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> int:
    """Merge every not-yet-seen file under ``source_dir`` into ``target`` on ``keys`` (within the partition);
    return batches run. ``transform`` must keep the columns ``_delivered_at`` and
    ``_delivered_in`` (time and path of a row's file), which order deliveries of a key. The result does not depend on how files fall
    into batches, as long as later files are not older."""
    ckpt = checkpoint or shared_dir(spark, os.path.join("streams", os.path.basename(target.rstrip("/"))))
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    batches = []

    def stored(path: str) -> DataFrame | None:
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException:
            return None

    def apply(batch: DataFrame, epoch: int) -> None:
        out = transform(batch) if transform else batch
        aside = os.path.join(f"{ckpt.rstrip('/')}-merged", str(epoch))
        if stored(os.path.join(aside, "done")) is None:
            merge_on_key(stored(target), out, keys, partition_by).write.mode("overwrite").format(fmt).save(
                os.path.join(aside, "rows"))
            spark.range(1).write.mode("overwrite").format(fmt).save(os.path.join(aside, "done"))
        merged = stored(os.path.join(aside, "rows"))
        if merged is not None:
            refresh_partitions(merged, target, partition_by, fmt)
        batches.append(epoch)

    files = reader.load(source_dir).select("*", F.col("_metadata.file_modification_time").alias(_TIME),
                                           F.col("_metadata.file_path").alias(_FILE))
    q = (files.writeStream.trigger(availableNow=True)
         .option("checkpointLocation", ckpt).foreachBatch(apply).start())
    q.awaitTermination()
    return len(batches)
