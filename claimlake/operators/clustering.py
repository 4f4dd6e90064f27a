"""Clustering by several columns at once.

Sorting by (a, b) lets a filter on ``a`` skip files, but a filter on ``b`` alone hardly any. Here each
column gets a rank of ``BITS`` bits (which of 2^BITS equal shares of the rows its value begins in), and the bits of all
ranks are interleaved into one number: rows that are close in it are close in every column, so files
and row groups that hold a range of it have narrow statistics for each column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

BITS = 6
#: Rows from which cut points are taken. They decide where a row is written, never what is written.
SAMPLE = 8192


def cut_points(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """2^bits - 1 values of each column that cut its rows into about equal shares, nulls first.

    From a uniform sample of ``SAMPLE`` rows, taken in one pass that reads these columns only."""
    for c in columns:
        if not isinstance(df.schema[c].dataType, AtomicType):
            raise ValueError(f"{c}: cannot cluster by {df.schema[c].dataType.simpleString()}")
    sample = df.select(*columns).orderBy(F.rand(7)).limit(SAMPLE).collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted((r[i] for r in sample), key=lambda v: (v is not None, v != v, 0 if v is None or v != v else v))
        out[c] = [values[k * len(values) // 2 ** bits] for k in range(1, 2 ** bits)] if values else []
    return out


def interleaved_key(df: DataFrame, cuts: dict[str, list], bits: int = BITS) -> Column:
    """The interleaved bits of the columns' ranks (how many cut points lie below the value)."""
    key = F.lit(0).cast("bigint")
    for j, (name, points) in enumerate(cuts.items()):
        known = [p for p in points if p is not None]
        below = F.array(*map(F.lit, known)).cast(f"array<{df.schema[name].dataType.simpleString()}>")
        value = F.col(name)
        rank = F.when(value.isNull(), F.lit(0)).otherwise(
            F.size(F.filter(below, lambda p: p < value)) + F.lit(len(points) - len(known))).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(cuts) + len(cuts) - 1 - j))
    return key


def cluster(df: DataFrame, columns: Sequence[str], partition_by: Sequence[str] = (), files: int | None = None,
            bits: int = BITS) -> DataFrame:
    """``df`` range-partitioned and sorted by ``partition_by`` and the interleaved key. A row hash ends the key, so a combination of
    values that holds a third of all rows spreads over many partitions. ``df`` is read once more for the cut
    points, these columns only, and once by the planner's range sample."""
    if len(columns) * bits > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit the key")
    z = "_cluster_key"
    while z in df.columns:
        z += "_"
    keyed = df.withColumn(z, interleaved_key(df, cut_points(df, columns, bits), bits))
    by = [*[F.col(c) for c in partition_by], F.col(z), F.xxhash64(*[F.col(c) for c in df.columns])]
    placed = keyed.repartitionByRange(files, *by) if files else keyed.repartitionByRange(*by)
    return placed.sortWithinPartitions(*partition_by, z, *columns).drop(z)
