"""Ranked lexical search over a length-stratified index.

A term's impact in a document depends on its occurrences tf and on the document's normaliser m alone, so
documents of equal m form a stratum, and a stratum's postings are grouped by (term, tf):

1. One pass over the texts counts every document's terms and keeps the query terms' occurrences.
2. N, L and every query term's document frequency are summed up; m follows for each document. The index is
   written in the order of m. A stratum of any size may span many tasks: equal m is split by row number.
3. A task reads its part of the index in blocks of at most ``block_postings`` postings. In a block the impact of
   a (stratum, term, tf) group is computed once, and the largest tf of each term in a stratum gives, for each
   item, a bound on the scores there. An item visits the strata by falling bound and stops at the first one
   below its k-th best score so far; equal bounds are visited, because a tie may have a smaller id.
4. The k best of each task are merged.

Items are taken in chunks of at most ``chunk_chars`` characters of text, whose terms are sent to the tasks; each
chunk is one run over the documents. All results are exact: bounds skip only what cannot be among the k best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stash

TOP = 10
CHUNK_CHARS = 2_000_000
BLOCK_POSTINGS = 4_000_000
#: Postings of an average part of the index; the parts of the longest documents hold several times as many.
PART_POSTINGS = 1_000_000
_TERM_BYTES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def _counted(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: id, ``n`` (all its terms), the vocabulary's ``terms`` in it and their ``tfs``."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for b in batches:
            rows, sizes, at, found, tfs = [], [], [0], [], []
            for i, text in enumerate(b.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                count = Counter(words)
                here = count.keys() & known
                found.extend([vocabulary[w] for w in here])
                tfs.extend([count[w] for w in here])
                rows.append(i)
                sizes.append(len(words))
                at.append(len(found))
            offsets = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], ["id", "n", "terms", "tfs"])
    return own.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>")


def build_index(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text",
                part_postings: int = PART_POSTINGS) -> tuple[DataFrame, np.ndarray]:
    """The index of a vocabulary and the weight of each of its terms.

    Index rows: ``m``, ``id``, ``terms`` (places in the vocabulary), ``tfs``, in the order of m; documents
    without any of the terms are counted in N and L but have no row.
    """
    place = {w: i for i, w in enumerate(vocabulary)}
    counted = stash(_counted(docs, id_col, text_col, place), "counted")
    facts = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(1)).alias("words"),
                        F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
    total, words = facts["docs"], facts["words"]
    # One row for each term of the vocabulary at most.
    held = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in held:
        weight[r["t"]] = math.floor(1000 * math.log((2 * total + 2) / (2 * r["df"] + 1)))
    m = (F.lit(25) + F.expr(f"(75L * n * {total}L) div {words}L")).alias("m")
    parts = max(counted.rdd.getNumPartitions(), math.ceil(facts["postings"] / part_postings))
    index = (counted.filter(F.size("terms") > 0).select(m, "id", "terms", "tfs", F.monotonically_increasing_id().alias("row"))
             .repartitionByRange(parts, "m", "row").sortWithinPartitions("m", "row").drop("row"))
    return stash(index, "index"), weight


class _Best:
    """The k best (score, id) of one item so far; null ids come last among equal scores."""

    def __init__(self, k: int):
        self.k, self.floor = k, 1
        self.score, self.none, self.id = (np.zeros(0, t) for t in (np.int64, bool, np.int64))

    def add(self, score: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= self.floor
        if not keep.any():
            return
        s, n, i = (np.concatenate([a, b[keep]]) for a, b in ((self.score, score), (self.none, none), (self.id, ids)))
        first = np.lexsort((i, n, -s))[:self.k]
        self.score, self.none, self.id = s[first], n[first], i[first]
        if len(first) == self.k:
            self.floor = max(1, int(self.score[-1]))


def _search_block(m: np.ndarray, ids: np.ndarray, none: np.ndarray, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray,
                  weight: np.ndarray, items: list[tuple[np.ndarray, np.ndarray]], best: list[_Best]) -> None:
    """Visit the strata of one block of documents (sorted by m) for every item."""
    edges = np.r_[0, np.flatnonzero(np.diff(m)) + 1, len(m)]
    stratum = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    doc = np.repeat(np.arange(len(m)), sizes)
    order = np.lexsort((tf, term, stratum[doc]))
    doc, term, tf = doc[order], term[order], tf[order].astype(np.int64)
    part = stratum[doc]
    starts = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(term) != 0) | (np.diff(tf) != 0)])
    # Once for each (stratum, term, tf): all its postings share the impact.
    t, n = tf[starts], m[edges[part[starts]]]
    group_impact = weight[term[starts]] * ((1_000_000_000 * t) // (1000 * t + 8 * n))
    impact = np.repeat(group_impact, np.diff(np.r_[starts, len(doc)]))
    lists = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(term) != 0)])
    ends = np.r_[lists[1:], len(doc)]
    largest = impact[ends - 1]          # the impact grows with tf, and a list is sorted by tf
    own, list_term = part[lists], term[lists]
    strata = len(edges) - 1
    first_list = np.searchsorted(own, np.arange(strata + 1))
    bound = np.zeros((strata, len(items)), np.int64)
    place = np.full((strata, len(weight)), -1, np.int32) if strata * len(weight) <= 1 << 24 else None
    if place is not None:
        place[own, list_term] = np.arange(len(lists))
    lookup = np.full(len(weight), -1, np.int64)

    def lists_of(s: int, want: np.ndarray) -> np.ndarray:
        if place is not None:
            return place[s, want]
        here = slice(first_list[s], first_list[s + 1])
        lookup[list_term[here]] = np.arange(here.start, here.stop)
        got = lookup[want]
        lookup[list_term[here]] = -1
        return got

    flat = np.concatenate([w for w, _ in items])
    reps = np.concatenate([r for _, r in items])
    begin = np.r_[0, np.cumsum([len(w) for w, _ in items])]
    bounded = np.r_[largest, 0]
    for s in range(strata):
        total = np.r_[0, np.cumsum(bounded[lists_of(s, flat)] * reps)]
        bound[s] = total[begin[1:]] - total[begin[:-1]]
    for j, (want, rep) in enumerate(items):
        mine = best[j]
        for s in np.argsort(-bound[:, j], kind="stable"):
            if bound[s, j] < mine.floor:
                break
            at = lists_of(s, want)
            has = np.flatnonzero(at >= 0)
            low, size = edges[s], edges[s + 1] - edges[s]
            spans = [(lists[x], ends[x], r) for x, r in zip(at[has], rep[has])]
            where = np.concatenate([doc[a:b] for a, b, _ in spans]) - low
            # Sums stay far below 2^53, so adding them as doubles is exact.
            score = np.bincount(where, np.concatenate([impact[a:b] * r for a, b, r in spans]), size).astype(np.int64)
            mine.add(score, none[low:low + size], ids[low:low + size])


def _search(index: DataFrame, weight: np.ndarray, items: list[tuple[np.ndarray, np.ndarray]], k: int,
            block_postings: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, waiting = [_Best(k) for _ in items], [], 0

        def flush():
            cols = [np.concatenate(c) for c in zip(*held)]
            _search_block(*cols, weight, items, best)
            held.clear()
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                p = b.slice(lo, 4096)
                found, tfs = p.column("terms"), p.column("tfs")
                sizes = np.diff(found.offsets.to_numpy())
                held.append((p.column("m").to_numpy(), p.column("id").fill_null(0).to_numpy(),
                             p.column("id").is_null().to_numpy(zero_copy_only=False), sizes,
                             found.flatten().to_numpy(), tfs.flatten().to_numpy()))
                waiting += int(sizes.sum())
                if waiting >= block_postings:
                    flush()
                    waiting = 0
        if held:
            flush()
        for j, x in enumerate(best):
            if len(x.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x.score), j, np.int32)), pa.array(x.id, mask=x.none), pa.array(x.score)],
                    ["item", "id", "score"])
    return index.select("m", "id", "terms", "tfs").mapInArrow(run, "item int, id long, score long")


def _chunks(items: DataFrame, item_col: str, text_col: str, chunk_chars: int) -> Iterator[list[tuple]]:
    """(item id, term counts) of the items, a chunk of bounded text at a time."""
    chunk, chars = [], 0
    for r in items.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        chunk.append((r["i"], Counter(terms(r["t"]))))
        chars += len(r["t"] or "") + 100
        if chars >= chunk_chars:
            yield chunk
            chunk, chars = [], 0
    if chunk:
        yield chunk


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", chunk_chars: int = CHUNK_CHARS,
                   block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The ``k`` highest-scoring documents of each row of ``items``: item id, ``rank`` (from 1), id, ``score``.

    Scores above 0 only; equal scores by ascending id, null ids last. Null and empty texts have no terms: such
    documents are not counted, such items have no rows. Every row of a repeated document or item ranks by
    itself. Empty tables give no rows. Ids are read as 64-bit numbers; other columns are not touched.
    """
    spark, out = docs.sparkSession, None
    rank = fresh("rank", [id_col, item_col])
    score = fresh("score", [id_col, item_col])
    kind = items.schema[item_col].dataType
    for chunk in _chunks(items, item_col, item_text, chunk_chars):
        vocabulary = sorted(set().union(*(c.keys() for _, c in chunk)))
        if not vocabulary:
            continue
        place = {w: i for i, w in enumerate(vocabulary)}
        index, weight = build_index(docs, vocabulary, id_col, text_col)
        asked = [(np.array([place[w] for w in c], np.int64), np.array(list(c.values()), np.int64)) for _, c in chunk]
        found = _search(index, weight, asked, k, block_postings)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(chunk)], f"item int, name {kind.simpleString()}")
        part = (top.join(F.broadcast(names), "item")          # one row an item of this chunk
                .select(F.col("name").alias(item_col), F.col("rank").alias(rank), F.col("id").alias(id_col), F.col("score").alias(score)))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], f"`{item_col}` {kind.simpleString()}, `{rank}` int, `{id_col}` long, `{score}` long")
    return out
