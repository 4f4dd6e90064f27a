"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. Each text is normalised and hashed; only (id, length, digest) and a row number go on, written once.
2. A Misra-Gries summary (``approx_top_k``, a mergeable frequent-items sketch of fixed size)
   names the digests that may be frequent.
3. Those candidates are counted exactly. Their verified winners, at most ``heavy`` rows, are
   broadcast and mark all other copies on the map side: a group that holds a third of all
   rows is never shuffled, even if it is one row repeated (the winner is one row number).
4. The winners and all other rows go through an ordinary shuffle on the digest.

A digest with more than about ``rows / tracked`` copies is always in the summary, so no
shuffled group is larger than that. Which digests it names changes the route, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, row_key, stash

HEAVY = 1000        # winners broadcast: at most this many rows of about 100 bytes
TRACKED = 16384     # counters in the frequent-items summary


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def frequent(rows: DataFrame, col: str, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """The values of ``col`` that a Misra-Gries summary reports as the most frequent: at most ``heavy`` rows."""
    summary = rows.agg(F.expr(f"approx_top_k({col}, {heavy}, {tracked})").alias("top"))
    return summary.select(F.explode("top.item").alias(col))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``, ``n_points`` (code points of the original text) and ``row_key``.

    Of equal texts the row with the most code points, then the smallest id stays; null ids
    come last. Null text equals empty text. Of repeated rows (same id and length) exactly one
    is kept. An empty table gives no rows; other columns are not read.
    """
    rows = stash(docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_points"),
        F.sha2(normalised(F.col(text_col)), 256).alias("digest"),
        row_key(id_col, text_col).alias("row_key"), F.monotonically_increasing_id().alias("nth")), "digests")

    named = frequent(rows, "digest", heavy, tracked)
    first = F.min(F.struct((-F.col("n_points")).alias("n"), F.isnull("id").alias("no_id"), "id", "nth"))
    winners = (rows.join(F.broadcast(named), "digest", "left_semi").groupBy("digest")
               .agg(F.count(F.lit(1)).alias("copies"), first.alias("w"))
               .filter("copies > 1")
               .select("digest", "copies", F.col("w.id").alias("w_id"), F.col("w.nth").alias("w_nth")))

    marked = rows.join(F.broadcast(winners), "digest", "left")
    beaten = F.col("copies").isNotNull() & (F.col("nth") != F.col("w_nth"))
    out = ("id", "keep_id", "group_size", "kept", "digest", "n_points", "row_key")
    removed = (marked.filter(beaten)
               .select("*", F.col("w_id").alias("keep_id"), F.col("copies").alias("group_size"),
                       F.lit(False).alias("kept")).select(*out))
    group = Window.partitionBy("digest")
    order = group.orderBy(F.desc("n_points"), F.asc_nulls_last("id"), "nth")
    shuffled = (marked.filter(~beaten)
                .withColumn("kept", F.row_number().over(order) == 1)
                .withColumn("keep_id", F.first("id").over(order))
                .withColumn("group_size", F.coalesce(
                    "copies", F.count(F.lit(1)).over(group))).select(*out))
    return (shuffled.unionByName(removed)
            .withColumnsRenamed({"id": id_col, "digest": "text_sha256"}))
