"""Aggregate building blocks: conditional sums, distincts, percentiles, top label."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, label_tiers


def sum_if(cond: Column, value: str | Column, otherwise=0) -> Column:
    """``sum(case when cond then value else otherwise end)``."""
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(otherwise)))


def distinct_count(value: str | Column, rsd: float | None = None) -> Column:
    """``count(distinct value)``; with ``rsd`` a HyperLogLog estimate (BIGINT either way)."""
    if rsd:
        return F.approx_count_distinct(col(value), rsd).cast("bigint")
    return F.count_distinct(col(value))


def count_distinct_if(cond: Column, value: str | Column, rsd: float | None = None) -> Column:
    """``count(distinct case when cond then value end)``."""
    return distinct_count(F.when(cond, col(value)), rsd)


def distinct_per_group(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """One row per ``keys`` group with its number of distinct non-null ``value``s: two plain
    aggregates, so a hot group is spread over its values and no row is expanded."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(out))


#: Sketches of 2^14 registers: relative standard error 0.8 %, so 2.5 % is three standard errors.
SKETCH_LG_K, SKETCH_BOUND = 14, 0.025


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, out: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One row per ``keys`` group with a HyperLogLog sketch of its distinct non-null ``value``s. Stored beside a
    table of the same groups, it lets any coarser report count distinct values without the detail rows."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias(out))


def merged_distinct(sketches: DataFrame, keys: Sequence[str], sketch: str, out: str) -> DataFrame:
    """Distinct values of every coarser ``keys`` group, estimated from the union of its sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two aggregates of the same rows side by side; null keys match."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


#: Half the share of a group between the two cut points around a percentile, and the sketch's accuracy.
BRACKET, SKETCH_ACCURACY = 0.0005, 10_000
_SALTS = 32


def _salted(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` (null keys match) of many rows with the few rows of ``right`` for each key: the left
    side's ``_salt`` spreads a hot key, and the right side has a copy for each salt."""
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    copies = copies.withColumnsRenamed({k: f"_r_{k}" for k in [*keys, "_salt"]})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in [*keys, "_salt"]]
    return left.join(copies, on).drop(*[f"_r_{k}" for k in [*keys, "_salt"]])


def percentile_cuts(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated percentiles, one row per ``by`` group (one in all without): ``_p0``, ``_p1``, ...

    Bracketed selection. A quantile sketch gives each group cut points closely around every wanted
    percentile; rows are counted per value and summed up per bucket between cut points, so it is known exactly which
    bucket holds each wanted position; only the values of these buckets are put in order. A bucket
    holds about ``2 * BRACKET`` of its group's rows, so no task has a whole group. The sketch decides how
    much is sorted, never the result. Nulls are left out; a group without values has no row.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, value)
    points = sorted({min(1.0, max(0.0, p + d)) for p in ps for d in (-BRACKET, BRACKET)})
    cuts = rows.groupBy(*by).agg(F.percentile_approx(value, points, SKETCH_ACCURACY).alias("_cuts"))
    counts = (rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(_SALTS)).cast("int")))
    if by:
        placed = _salted(counts, cuts, by)
    else:
        placed = counts.withColumn("_cuts", cuts.scalar())
    below = [F.when(F.get("_cuts", F.lit(i)) < F.col(value), 1).otherwise(0) for i in range(len(points))]
    placed = placed.withColumn("_b", functools.reduce(Column.__add__, below)).drop("_cuts")
    # One entry for each bucket: at most one more than there are points.
    ladder = (placed.groupBy(*by, "_b").agg(F.sum("_n").alias("_n")).groupBy(*by)
              .agg(F.sum("_n").alias("_all"), F.sort_array(F.collect_list(F.struct("_b", "_n"))).alias("_ladder")))
    before = F.transform("_ladder", lambda x, i: F.struct(
        x["_b"].alias("_b"), x["_n"].alias("_n"),
        F.aggregate(F.slice("_ladder", 1, i), F.lit(0).cast("bigint"), lambda a, y: a + y["_n"]).alias("_before")))

    def position(p: float) -> Column:
        return (F.col("_all") - 1) * F.lit(float(p))

    def holder(k: Column) -> Column:
        return F.element_at(F.filter("_steps", lambda x: (x["_before"] <= k) & (k < x["_before"] + x["_n"])), 1)
    wanted = F.array(*[holder(f(position(p))) for p in ps for f in (F.floor, F.ceil)])
    held = (ladder.withColumn("_steps", before)
            .select(*by, "_all", F.explode(F.array_distinct(wanted)).alias("_s"))
            .select(*by, "_all", "_s._b", "_s._before"))
    kept = _salted(placed, held, [*by, "_b"]) if by else placed.join(F.broadcast(held), "_b")     # two rows a percentile
    upto = F.sum("_n").over(Window.partitionBy(*by, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = kept.withColumn("_upto", F.col("_before") + upto)
    out = []
    for p in ps:
        pos = position(p)
        low, high = (F.min(F.when(F.col("_upto") > f(pos), F.col(value))) for f in (F.floor, F.ceil))
        part = F.max(pos - F.floor(pos))
        out.append(F.when(part == 0, low.cast("double"))
                   .otherwise((F.lit(1.0) - part) * low + part * high))
    return ranked.groupBy(*by).agg(*[c.alias(f"_p{i}") for i, c in enumerate(out)])


def percentile(value: str | Column, p: float, accuracy: int | None = None) -> Column:
    """Continuous (interpolated) percentile; ``percentile_approx`` when ``accuracy`` is set.

    The exact form keeps a value -> count map per task and merges the maps, so it stays
    small for integer measures such as claims.
    """
    if accuracy:
        return F.percentile_approx(col(value), p, accuracy).cast("double")
    return F.percentile(col(value), F.lit(p))


def top_label(label: str, measure: str) -> Column:
    """Label of the row with the largest ``measure``; ties go to the largest label."""
    return F.max_by(F.col(label), F.struct(F.col(measure), F.col(label)))


def top_labels(df: DataFrame, keys: Sequence[str], label: str, measure: str,
               out: str) -> DataFrame:
    """One row per ``keys`` group with the ``label`` of its largest ``measure``.

    Two steps: a hash aggregate of the largest measure per (group, label) reduces the rows
    to one per label, then the top label is taken over those few rows. Same answer as
    ``top_label`` (ties to the largest label) without sorting the full input.
    """
    per_label = df.groupBy(*keys, label).agg(F.max(measure).alias("_m"))
    return per_label.groupBy(*keys).agg(
        F.max_by(F.col(label), F.struct(F.col("_m"), F.col(label))).alias(out))


def percentile_tiers(df: DataFrame, value: str, out: str, cuts: Sequence[tuple[str, float]],
                     otherwise: str, where: Column | None = None, by: Sequence[str] = (),
                     accuracy: int | None = None) -> DataFrame:
    """Label every row by percentile cut points of ``value`` (computed on ``where`` rows).

    Global cut points are one scalar subquery (an array of all cut points, referenced
    once, so it runs once): ``df`` is neither joined nor shuffled and no cross join is
    planned. Per-group cut points are one row per group, joined on the keys.
    """
    base = df.where(where) if where is not None else df
    names = [f"_p{i}" for i in range(len(cuts))]
    if accuracy:
        stats = base.groupBy(*by).agg(*[percentile(value, p, accuracy).alias(n)
                                        for n, (_, p) in zip(names, cuts)])
    else:
        stats = percentile_cuts(base, value, [p for _, p in cuts], by)
    if not by:
        # The cut points are referenced once, so the subquery runs once: test every cut
        # (first hit wins, as in CASE), NULL value or cut -> no hit -> ``otherwise``.
        cut_values = stats.select(F.array(*names).alias("_c")).scalar()
        hits = F.transform(F.col("_cuts"), lambda b: F.col(value) >= b)
        first = F.coalesce(F.nullif(F.array_position(hits, True), F.lit(0)),
                           F.lit(len(cuts) + 1))
        labels = F.array(*[F.lit(lab) for lab, _ in cuts], F.lit(otherwise))
        return (df.withColumn("_cuts", cut_values)
                .withColumn(out, F.element_at(labels, first.cast("int"))).drop("_cuts"))
    joined = df.join(stats, list(by), "left")
    label = label_tiers(F.col(value), [(lab, F.col(n)) for n, (lab, _) in zip(names, cuts)],
                        otherwise)
    return joined.withColumn(out, label).drop(*names)
