"""Aggregates kept up to date from changed rows.

A grouped mart is stored as mergeable partial results (its state), one table:

* a row for each group with the number of source rows and, for each measure, its sum and the number of values
  that are not null (for means, and for sums that are null);
* a row for each group and distinct value of a counted column, with the number of source rows that hold it.

A change is a set of signed rows: the old form of a changed row with -1, the new form with +1. Their partial
results are added to the stored ones; a group or value whose rows add up to none is gone. Sums are
decimals or integers, so the result equals a rebuild exactly, whatever the order of changes. A measure must not be
a floating-point number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from .history import changed_rows

SIGN, ROWS, COUNTED, VALUE, SEEN = "_sign", "_rows", "_counted", "_value", "__n"
OLD, NEW = "_stored", "_delivered"


@dataclass(frozen=True)
class Grouped:
    """A grouped result: ``sums`` and ``distincts`` are named columns of the source rows."""
    keys: Sequence[str]
    sums: Mapping[str, Column]
    distincts: Mapping[str, Column] = field(default_factory=dict)


def partial_results(signed: DataFrame, spec: Grouped) -> DataFrame:
    """The state that the signed rows add up to: one plain aggregate for the sums and one for each counted column, each over its own
    columns, so no row is expanded and a hot group is pre-aggregated or spread over its values."""
    keys, minus = list(spec.keys), F.col(SIGN) < 0
    rows = signed.select(*keys, SIGN, *[c.alias(n) for n, c in spec.sums.items()])
    floats = [f.name for f in rows.schema.fields if f.name in spec.sums and isinstance(f.dataType, (DoubleType, FloatType))]
    if floats:
        raise ValueError(f"{floats}: sums of floating-point numbers cannot be taken back exactly")
    aggs = [F.sum(SIGN).cast("bigint").alias(ROWS)]
    for n in spec.sums:
        aggs += [F.sum(F.when(minus, -F.col(n)).otherwise(F.col(n))).alias(n),
                 F.sum(F.when(F.col(n).isNotNull(), F.col(SIGN)).otherwise(0)).cast("bigint").alias(n + SEEN)]
    none = F.lit(None).cast("string")
    out = rows.groupBy(*keys).agg(*aggs).withColumns({COUNTED: none, VALUE: none})
    for n, c in spec.distincts.items():
        part = (signed.select(*keys, SIGN, c.cast("string").alias(VALUE)).where(F.col(VALUE).isNotNull())
                .groupBy(*keys, VALUE).agg(F.sum(SIGN).cast("bigint").alias(ROWS)).withColumn(COUNTED, F.lit(n)))
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def merge_state(stored: DataFrame | None, change: DataFrame, spec: Grouped, ranged_by: str | None = None) -> DataFrame:
    """The stored state with a change added; an error if the change takes away rows that are not there.

    The sums need one shuffle. With ``ranged_by``, one of the keys, that shuffle deals the rows in ranges of it and of the other
    keys, as a table partitioned by it is written; rows of a group and their values come together, so they are small."""
    on, types = [*spec.keys, COUNTED, VALUE], dict(change.dtypes)
    both = change if stored is None else stored.unionByName(change)
    if ranged_by is not None:
        both = both.repartitionByRange(ranged_by, *[k for k in on if k != ranged_by])
    summed = both.groupBy(*on).agg(*[F.sum(c).cast(types[c]).alias(c) for c in change.columns if c not in on])
    checked = F.when(F.col(ROWS) >= 0, F.col(ROWS)).otherwise(
        F.raise_error(F.lit("a change takes away rows that are not stored")).cast("bigint"))
    return summed.withColumn(ROWS, checked).where(F.col(ROWS) > 0).select(*change.columns)


def grouped_result(state: DataFrame, spec: Grouped) -> DataFrame:
    """One row per group: ``keys``, each sum with its number of values (``<name>__n``), each distinct count."""
    types = dict(state.dtypes)
    # A group has one row of sums; the rows of its values have none.
    sums = [F.when(F.sum(n + SEEN) > 0, F.sum(n)).cast(types[n]).alias(n) for n in spec.sums]
    seen = [F.sum(n + SEEN).alias(n + SEEN) for n in spec.sums]
    distincts = [F.count(F.when(F.col(COUNTED) == n, 1)).alias(n) for n in spec.distincts]
    return state.groupBy(*spec.keys).agg(*sums, *seen, *distincts)


def changed_sources(stored: DataFrame, delivered: DataFrame, key: str) -> DataFrame:
    """The rows of ``delivered`` whose ``key`` is new or any of whose columns differ from the stored row's."""
    watched = [c for c in delivered.columns if c != key]
    return changed_rows(stored, delivered, [key], watched)


def signed_rows(stored: DataFrame | None, changed: DataFrame, key: str, gone: DataFrame | None = None) -> DataFrame:
    """``changed`` rows with +1 and the stored rows that they replace, or whose key is in ``gone``, with -1."""
    new = changed.withColumn(SIGN, F.lit(1))
    if stored is None:
        return new
    keys = changed.select(key) if gone is None else changed.select(key).unionByName(gone.select(key))
    old = stored.join(keys, key, "left_semi").select(*changed.columns)
    return new.unionByName(old.withColumn(SIGN, F.lit(-1)))


def signed_changes(stored: DataFrame, delivered: DataFrame, key: str, complete: bool = False, tasks: int = 0) -> DataFrame:
    """What ``signed_rows`` makes of ``changed_sources``, with the stored rows of keys that are not delivered with -1 if the
    delivery is ``complete``: both tables are read and shuffled once, by ``key``, so give only the columns that count.
    They are dealt over ``tasks`` tasks, or as many as the session has for a shuffle if that is more."""
    cols, over = delivered.columns, Window.partitionBy(key)
    both = stored.select(*cols).withColumn(SIGN, F.lit(-1)).unionByName(delivered.withColumn(SIGN, F.lit(1)))
    few = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.repartition(tasks, key) if tasks > few else both.repartition(key)
    equal = both.groupBy(*cols).agg(F.count_if(F.col(SIGN) < 0).alias(OLD), F.count_if(F.col(SIGN) > 0).alias(NEW))
    # A null key equals none: its delivered rows are new, its stored rows stay.
    added = (F.col(NEW) > 0) & ((F.col(OLD) == 0) | F.col(key).isNull())
    leaves = F.max(added).over(over)
    if complete:
        leaves = leaves | (F.max(NEW).over(over) == 0)
    signed = equal.withColumn(SIGN, F.when(added, F.col(NEW)).when(leaves & F.col(key).isNotNull(), -F.col(OLD)).otherwise(0))
    return signed.select(*cols, F.explode(F.array_repeat(F.signum(SIGN).cast("int"), F.abs(SIGN).cast("int"))).alias(SIGN))
