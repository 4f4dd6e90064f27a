"""Mixing sources to target weights along a curriculum (DataFrame functions only).

Each source has a weight schedule: a piecewise linear rate over training time 0..1. Its
integral is the source's weight, and its running integral, scaled to the source's target,
says how many of its words training has asked for by any time. Documents of a source are
queued in a seeded order; a copy that begins at word c of the queue is trained on at the time
when the demand reaches c, found by inverting the running integral. Sorting all copies by that
time (a range sort) gives the mix.

The queue offsets are a distributed prefix sum: the order key (an MD5) is cut into key ranges,
ranges are summed, and rows are summed inside their range only, so a source that holds a third
of all rows is spread over as many ranges as any other rows. The number of ranges follows the
row count and does not change the result. Repeated rows are one row with a count until their places are
known; a range that many rows of one id make large is cut further, by size and row key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, row_key, stash

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_RANGE = 20_000
#: Repeats of one row that one task writes at a time.
REPEATS_PER_ROW = 1_000
#: Curriculum shapes (time, relative rate): steady, rising and falling.
STEADY, RISING, FALLING = [(0.0, 1.0), (1.0, 1.0)], [(0.0, 0.5), (1.0, 1.5)], [(0.0, 1.5), (1.0, 0.5)]


def segments(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(time, share of demand before it, rate, slope, integral of the whole) of each piece."""
    if len(knots) < 2 or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])) or min(r for _, r in knots) < 0:
        raise ValueError("a schedule needs rising times and rates of 0 or more")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    whole = sum(areas)
    if whole <= 0:
        raise ValueError("a schedule needs a positive integral")
    return [(a[0], sum(areas[:i]) / whole, a[1], (b[1] - a[1]) / (b[0] - a[0]), whole)
            for i, (a, b) in enumerate(zip(knots, knots[1:]))]


def time_of_demand(share: Column, schedule: Column) -> Column:
    """Training time at which ``share`` (0..1) of the demand is reached: the inverse of the
    running integral, on the last piece that begins at or below it."""
    s = F.element_at(F.filter(schedule, lambda x: x["before"] <= share), -1)
    area = (share - s["before"]) * s["whole"]
    root = s["rate"] + F.sqrt(F.greatest(s["rate"] * s["rate"] + 2 * s["slope"] * area, F.lit(0.0)))
    return s["time"] + F.when(area > 0, 2 * area / root).otherwise(F.lit(0.0))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float,
                   repeats: float) -> DataFrame:
    """One row per source (``skey``) of ``sizes`` (each row counts ``rows`` times): its size, weight and target.

    Targets are proportional to the weights, stop at ``repeats`` times the source's size, and
    the excess goes to the others by weight until none is above. Sources sorted by what
    would fill them first (cap / weight): the common level is the largest of the levels left
    after filling each prefix. The table has one row per source, as the weights do.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    ws = F.array(*[F.lit(float(w)) for w in weights])
    n = len(weights)
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    src = (sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("rows")).alias("source_size"))
           .withColumn("nth", F.row_number().over(by_name) - 1)
           .withColumn("weight", F.element_at(ws, (F.col("nth") % n + 1).cast("int")))
           .withColumn("cap", F.col("source_size") * F.lit(float(repeats))))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    every = Window.partitionBy()
    total = F.sum("source_size").over(every) * F.lit(float(share))
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    return (src.withColumn("level", (total - before) / rest)
            .withColumn("target", F.least("cap", F.max("level").over(every) * F.col("weight")))
            .select("skey", "nth", "source_size", "target"))


def in_ranges(sizes: DataFrame, distinct: int, rows_per_range: int) -> DataFrame:
    """``sizes`` with ``range``, a prefix of each row's place in the queue (order key, size, row key) such that about
    ``rows_per_range`` rows share it: ranges in order of their names hold the queue in order.

    Order keys are evenly spread but for repeated ids, so a prefix of them is enough; where many rows
    of one id overfill a range, its rows take a longer prefix, which reaches into the row key."""
    def digits(rows: Column | int) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.log(16.0, F.greatest(F.lit(1.0), rows / F.lit(float(rows_per_range))))))
    place = F.concat("okey", F.lpad(F.col("size").cast("string"), 19, "0"), "row_key")
    sizes = sizes.withColumn("range", F.substring("okey", F.lit(1), digits(F.lit(distinct)).cast("int")))
    large = stash(sizes.groupBy("range").agg(F.count(F.lit(1)).alias("in_range")).filter(
        F.col("in_range") > 4 * rows_per_range), "large")
    if large.isEmpty():
        return sizes
    longer = (F.lit(32 + 19) + digits(F.col("in_range"))).cast("int")
    return (sizes.join(large, "range", "left")
            .withColumn("range", F.when(F.col("in_range").isNull(), F.col("range")).otherwise(F.substring(place, F.lit(1), longer)))
            .drop("in_range"))


def each_repeat(queued: DataFrame, most: int) -> DataFrame:
    """One row per repeat of each row of ``queued`` (``rows`` times, one after the other from ``start``). A row with many
    repeats is first dealt over tasks in blocks of ``REPEATS_PER_ROW``."""
    if most > REPEATS_PER_ROW:
        left = F.col("rows") - F.col("block") * REPEATS_PER_ROW
        queued = (queued.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / REPEATS_PER_ROW))))
                  .withColumn("start", F.col("start") + F.col("block") * REPEATS_PER_ROW * F.col("size"))
                  .withColumn("rows", F.least(left, F.lit(REPEATS_PER_ROW))).repartition("row_key", "block").drop("block"))
    return (queued.withColumn("nth_row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
            .withColumn("start", F.col("start") + F.col("nth_row") * F.col("size")).drop("nth_row"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                repeats: float = 2.0, schedules: Sequence[Sequence[tuple[float, float]]] = (STEADY, RISING, FALLING),
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: str = "mix", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per row of ``docs``: id, ``size`` (words), ``source_size``, ``target``,
    ``taken`` (words the mix takes, repeats counted), ``copies`` (array of training time and
    words, in order) and ``row_key``.

    The mix walks each source's queue for exactly the target, rounded: whole rounds first,
    then the beginning of the queue, the last document being cut where the target ends.
    Null text has size 0 and is never taken; a null source is a source of its own, last in
    the order of names; null ids are ordered by their text. Repeated rows are queued
    one after the other. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(text)))
    sizes = stash(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("skey"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), ident)).alias("okey"),
        row_key(id_col, text_col).alias("row_key"))
        .groupBy("id", "source", "skey", "size", "okey", "row_key").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    seen = sizes.agg(F.count(F.lit(1)).alias("distinct"), F.max("rows").alias("most")).first()
    sizes = in_ranges(sizes, seen["distinct"], rows_per_range)
    shape = [F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(
        ("time", "before", "rate", "slope", "whole"), s)]) for s in segments(k)]) for k in schedules]
    targets = (source_targets(sizes, weights, share, repeats)
               .withColumn("schedule", F.coalesce(*[
                   F.when(F.col("nth") % len(shape) == i, s) for i, s in enumerate(shape)]))
               .withColumn("budget", F.floor(F.col("target") + 0.5).cast("long")))
    ranges = sizes.groupBy("skey", "range").agg(F.sum(F.col("size") * F.col("rows")).alias("range_size"))
    before = Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
              .join(targets, "skey"))
    inside = (Window.partitionBy("skey", "range").orderBy("okey", "size", "row_key")
              .rowsBetween(Window.unboundedPreceding, 0))
    queued = (sizes.join(ranges, ["skey", "range"])
              .withColumn("start", F.col("offset") + F.sum(F.col("size") * F.col("rows")).over(inside) - F.col("size") * F.col("rows")))
    queued = each_repeat(queued, seen["most"] or 0)
    whole = F.col("source_size") > 0
    rounds = F.when(whole, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    left = F.col("budget") - F.col("rounds") * F.col("source_size") - F.col("start")
    queued = (queued.withColumn("rounds", rounds)
              .withColumn("last", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long"))
              .withColumn("n", (F.when(F.col("size") > 0, F.col("rounds")).otherwise(F.lit(0))
                                + F.when(F.col("last") > 0, 1).otherwise(0)).cast("int")))
    copies = F.when(F.col("n") > 0, F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda e: F.struct(
            time_of_demand((e * F.col("source_size") + F.col("start")) / F.col("budget"),
                           F.col("schedule")).alias("time"),
            F.when(e < F.col("rounds"), F.col("size")).otherwise(F.col("last")).alias("words"))))
    return queued.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + F.col("last")).alias("taken"),
        copies.alias("copies"), "row_key")


def by_position(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix_sources`` range-sorted by the time of their first copy (``position``)."""
    return (mixed.withColumn("position", F.element_at("copies", 1)["time"])
            .orderBy(F.asc_nulls_last("position"), "row_key"))


def training_order(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per copy that the mix takes, range-sorted by training time: the columns of
    ``docs`` plus ``mix_position``, ``mix_copy`` and ``mix_words`` (names that ``docs`` already has get
    an underscore)."""
    pos, nth, words, k, rn, c = (fresh(x, docs.columns) for x in (
        "mix_position", "mix_copy", "mix_words", "__key", "__rn", "__copies"))
    per_key = (mixed.filter("copies is not null").groupBy(F.col("row_key").alias(k))
               .agg(F.sort_array(F.collect_list("copies")).alias(c)))
    w = Window.partitionBy(k).orderBy(k)
    own = (docs.withColumn(k, row_key(id_col, text_col)).join(per_key, k)
           .withColumn(rn, F.row_number().over(w)))
    return (own.select(*docs.columns, k, F.posexplode(F.get(F.col(c), F.col(rn) - 1)).alias(nth, c))
            .select(*docs.columns, k, F.col(c)["time"].alias(pos), (F.col(nth) + 1).alias(nth),
                    F.col(c)["words"].alias(words))
            .orderBy(pos, k, nth).drop(k))
