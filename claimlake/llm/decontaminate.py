"""Benchmark decontamination as a prefix-filtered set join (DataFrame functions only).

Every window of a benchmark item (``window`` words, or the whole item if it is shorter) is a
set of word shingles. A document that holds the window holds all of its shingles, so for
exact containment a prefix of one shingle is enough: the rarest, by its count over the whole
corpus. Documents are matched on those prefix shingles only. A match fixes where the window
must begin in the document (positional bound) and end (length bound); inside the bounds
the words are compared one by one.

The prefix table grows with the benchmark, not with the corpus. While the benchmark's texts
are at most ``broadcast_chars`` long it is broadcast and the corpus is not shuffled; beyond that
(key, position, shingle) rows are joined by shuffle and the words fetched for candidates only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_UPPER, drop_rows, row_key

SHINGLE = 5
WINDOW = 13
BROADCAST_CHARS = 2_000_000
_OTHER = "".join(chr(i) for i in range(128) if not (chr(i).isdigit() or chr(i).isalpha()))


def words(text: Column) -> Column:
    """A-Z lower-cased, then maximal runs of ASCII letters, digits and non-ASCII characters."""
    spaced = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER + _OTHER,
                         ASCII_UPPER.lower() + " " * len(_OTHER))
    return F.array_remove(F.split(spaced, " "), "")


def _shingle(k: int, words_col: str, pos: Column) -> Column:
    """Hash of ``k`` words from ``pos``; matches are compared word by word later."""
    return F.xxhash64(F.lit(k), *[F.get(F.col(words_col), pos + i) for i in range(k)])


def _shingles(df: DataFrame, lengths: list[int], words_col: str = "words") -> DataFrame:
    """``df`` with a row for every word position and shingle length: ``pos``, ``shingle``."""
    at = df.select("*", F.posexplode(words_col).alias("pos", "_word")).drop("_word")
    size = F.size(F.col(words_col))
    if len(lengths) == 1:
        at = at.withColumn("k", F.lit(lengths[0]))
    else:
        at = at.withColumn("k", F.explode(F.array(*[F.lit(k) for k in lengths])))
    at = at.filter(F.col("pos") + F.col("k") <= size)
    return at.withColumn("shingle", F.coalesce(*[
        F.when(F.col("k") == k, _shingle(k, words_col, F.col("pos"))) for k in lengths]))


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct windows: ``win`` (words), ``n`` (their number), ``items`` (ids as strings)."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                             words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("s")
    return (items.select("item", "w", n.alias("n"), starts)
            .select("item", F.slice("w", F.col("s"), F.col("n")).alias("win"), "n")
            .groupBy("win", "n").agg(F.collect_set("item").alias("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, rate: int = 20, broadcast_chars: int = BROADCAST_CHARS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit`` (words inside any occurrence of
    a window), ``n_items``, ``items`` (sorted ids), ``items_sha256``, ``contaminated`` (some word
    is hit, and at least 1 in ``rate``) and ``row_key``.

    Null and empty texts have no words and are clean; items without words have no windows; a
    null item id is written ``null``; items with the same id are one item. Repeated rows each get
    the result of their text. Empty tables give no rows, or all documents clean.
    """
    facts = benchmark.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0)).alias("chars"),
                          F.sort_array(F.collect_set(F.least(F.size(words(F.col(item_text))), F.lit(shingle)))).alias("k")
                          ).first()
    lengths = [k for k in facts["k"] if k > 0] or [shingle]   # at most `shingle` numbers
    small = facts["chars"] <= broadcast_chars
    held = F.broadcast if small else (lambda x: x)

    win = benchmark_windows(benchmark, item_col, item_text, window)
    parts = _shingles(win.withColumn("wk", F.least(F.col("n"), F.lit(shingle))), lengths, "win").filter("k = wk")
    keyed = docs.select(row_key(id_col, text_col).alias("row_key"), words(F.col(text_col)).alias("words"))
    spread = _shingles(keyed, lengths)
    wanted = parts.select("shingle").distinct()
    seen = (spread.select("shingle").join(held(wanted), "shingle", "left_semi")
            .groupBy("shingle").agg(F.count(F.lit(1)).alias("seen")))
    # A shingle that no document has can't be joined, and its windows occur nowhere.
    prefix = (parts.join(seen, "shingle", "left").fillna(0, ["seen"])
              .groupBy("win", "n", "items")
              .agg(F.min(F.struct("seen", "shingle", "pos")).alias("rare"))
              .filter("rare.seen > 0")
              .select("win", "n", "items", F.col("rare.shingle").alias("shingle"), F.col("rare.pos").alias("off")))
    begin = F.col("pos") - F.col("off")
    if small:
        near = spread.withColumn("n_words", F.size("words")).join(F.broadcast(prefix), "shingle")
    else:
        near = (spread.withColumn("n_words", F.size("words")).drop("words").join(prefix, "shingle")
                .filter((begin >= 0) & (begin + F.col("n") <= F.col("n_words")))
                .join(keyed.dropDuplicates(["row_key"]), "row_key"))
    found = near.filter((begin >= 0) & (begin + F.col("n") <= F.col("n_words"))
                        & (F.slice("words", begin + 1, F.col("n")) == F.col("win")))
    hits = (found.groupBy("row_key")
            .agg(F.sort_array(F.collect_set(F.struct(begin.alias("b"), (begin + F.col("n")).alias("e")))).alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(s["b"], a["end"]))).alias("n"),
                              F.greatest(a["end"], s["e"]).alias("end")),
        lambda a: a["n"])
    every = docs.select(F.col(id_col), row_key(id_col, text_col).alias("row_key"),
                        F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return (every.join(hits, "row_key", "left")
            .withColumn("n_hit", F.when(F.col("spans").isNull(), 0).otherwise(covered).cast("long"))
            .withColumn("items", F.coalesce("items", none))
            .select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (F.col("n_hit") * rate >= F.col("n_words"))).alias("contaminated"),
                    "row_key"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    found = decontaminate(docs, benchmark, **options).filter("contaminated").select("row_key")
    return drop_rows(docs, found, options.get("id_col", "doc_id"), options.get("text_col", "text"))
