"""Ranking, running totals, shares of a total and year-over-year change.

``ranked_running_total`` does not put a whole partition key (for example one year that
holds a third of all rows) into one task: rows are range-partitioned on (key, order) and
stored with the number of their slice, each slice ranks and sums its own rows, and a small
table of per-slice counts and sums gives every slice its offset. The offsets table has at
most ``slices + distinct keys`` rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..session import shared_dir

_UNB = Window.unboundedPreceding


def ranked_running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column],
                         value: str, rank_col: str = "rank", cum_col: str = "cumulative",
                         total_col: str = "partition_total", slices: int | None = None,
                         method: str = "range", broadcast_offsets: bool = True) -> DataFrame:
    """Add ``row_number``, running sum of ``value`` and the ``by`` total to every row.

    ``order`` must make rows unique inside ``by`` (add tie-breakers), so the result is
    deterministic. ``by`` columns must be non-null.

    Slices come from one range repartition, written once to the shared folder with the slice
    number: Spark samples range bounds anew for each plan, so both passes (counts, rows) read
    the stored slices. Range slices are contiguous in the sort order, so the offsets table has
    at most ``slices + distinct by keys - 1`` rows: broadcast it for low-cardinality keys
    (years); for keys with many values pass ``broadcast_offsets=False`` and let the planner
    choose the join. A slice without its offset fails the job.
    """
    by = list(by)
    if method == "window":
        w = Window.partitionBy(*by).orderBy(*order)
        return (df.withColumn(rank_col, F.row_number().over(w))
                .withColumn(cum_col, F.sum(value).over(w.rowsBetween(_UNB, 0)))
                .withColumn(total_col, F.sum(value).over(Window.partitionBy(*by))))
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = (df.repartitionByRange(n, *[F.col(c) for c in by], *order)
              .withColumn("_slice", F.spark_partition_id()))
    path = shared_dir(spark, f"ranked-{uuid.uuid4().hex}")
    sliced.write.parquet(path)
    ranged = spark.read.schema(sliced.schema).parquet(path)
    w = Window.partitionBy("_slice", *by).orderBy(*order)
    local = (ranged.withColumn("_lrank", F.row_number().over(w))
             .withColumn("_lcum", F.sum(value).over(w.rowsBetween(_UNB, 0))))
    pieces = local.groupBy("_slice", *by).agg(F.count(F.lit(1)).alias("_n"),
                                              F.sum(value).alias("_s"))
    wp = Window.partitionBy(*by).orderBy("_slice")
    before = wp.rowsBetween(_UNB, -1)
    offsets = pieces.select(
        "_slice", *by,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_noff"),
        F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_soff"),
        F.sum("_s").over(Window.partitionBy(*by)).alias(total_col))
    # offsets: one row per (slice, key) present, at most slices + distinct keys rows.
    out = local.join(F.broadcast(offsets) if broadcast_offsets else offsets, ["_slice", *by], "left")
    known = F.coalesce(F.col("_noff"), F.raise_error(F.lit("slice without an offset")).cast("bigint"))
    return out.select(*df.columns,
                      (F.col("_lrank") + known).cast("int").alias(rank_col),
                      (F.col("_lcum") + F.col("_soff")).alias(cum_col),
                      F.col(total_col))


def share_of_total(df: DataFrame, value: str, by: Sequence[str], out: str, digits: int = 2,
                   scale: float = 100) -> DataFrame:
    """``round(value / sum(value) over (by) * scale, digits)``, null on a zero total.

    Meant for aggregated rows (few per key). For detail rows use ``share_of_group``.
    """
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn(out, ratio(F.col(value), total, digits, scale))


def share_of_group(detail: DataFrame, totals: DataFrame, keys: Sequence[str],
                   bounded: bool = False) -> DataFrame:
    """Join detail rows to their (pre-aggregated, key-bounded) group totals.

    Totals are aggregated with map-side partial sums, so a hot key costs no more than
    any other. ``bounded`` says that the caller knows a bound on the number of groups: the
    totals are broadcast and detail rows not shuffled. Otherwise the planner decides.
    """
    return detail.join(F.broadcast(totals) if bounded else totals, list(keys), "left")


def pareto_tier(cum_pct: str | Column, top: float = 80.0, nxt: float = 95.0) -> Column:
    c = F.col(cum_pct) if isinstance(cum_pct, str) else cum_pct
    return (F.when(c <= F.lit(top), F.lit("Top 80%"))
            .when(c <= F.lit(nxt), F.lit("Next 15%"))
            .otherwise(F.lit("Long Tail")))


def year_over_year(df: DataFrame, by: Sequence[str], year: str, value: str,
                   prev_col: str = "prev_value", pct_col: str = "yoy_change_pct",
                   digits: int = 1) -> DataFrame:
    """Previous year's value and percent change, only when the previous row is year-1.

    ``df`` is an aggregate (one row per ``by`` x year), so each window partition holds one
    row per year.
    """
    w = Window.partitionBy(*by).orderBy(year)
    prev = F.lag(F.col(value)).over(w)
    prev_year = F.lag(F.col(year)).over(w)
    prev_ok = F.when(prev_year == F.col(year) - 1, prev)
    return (df.withColumn(prev_col, prev_ok)
            .withColumn(pct_col, ratio(F.col(value) - F.col(prev_col), F.col(prev_col),
                                       digits, 100)))
