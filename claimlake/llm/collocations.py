"""Phrase collocation mining by relations (SETM).

R1, the occurrence relation, holds every word in order of (document, piece, position). It is written once, a
document a row, words as 64-bit numbers; the dictionary that is written with it proves that no two
words share a number (else it is written anew with another seed).

    count R1 by word, keep the frequent words             -> C1
    R1 semi-join C1; merge-join it with itself by piece
    and next position; count by word pair                 -> C2
    R2 semi-join C2; merge-join it with itself by piece
    and next position; count by word triple               -> C3, and so on

A merge-join on adjacent positions never leaves its document, so it is an alignment of sorted arrays inside a
task; each task counts its own groups before the shuffle, and a group as frequent as may be costs one row a task.
The semi-joins use a Bloom filter of at most ``filter_words`` 64-bit words built from the frequent groups: it
drops no frequent group, and the rare ones that slip through are counted and fall to the threshold, so the
result is exact at every size while what is sent to the tasks is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
NO_LANG = "und"
#: 2^22 words are 32 MB.
FILTER_WORDS = 1 << 22
#: Parts that a filter is put together in; a power of two.
_PIECES = 1 << 10
#: Bytes of text that a task reads at a time (besides one document).
_BATCH_BYTES = 1 << 23
#: Words of the relation that a task counts at a time (besides one document).
_BATCH_WORDS = 600_000
_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z lower-cased, every break a full stop, tab a space.
_FOLD = bytes(46 if c in _BREAKS else 32 if c == 9 else c for c in range(256)).lower()


def folded(text: str | None) -> bytes:
    """UTF-8 with every break a full stop and every tab a space."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


_LOW_BYTES = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def word_numbers(blob: bytes, seed: int) -> tuple[np.ndarray, ...]:
    """The words and stops of a folded text that ends in 16 spaces: where each begins, its length, its number
    (0 for a stop), and its first and next eight bytes (of words over 16 bytes, the number's hash of all bytes)."""
    data = np.frombuffer(blob, np.uint8)
    stop = data == 46
    inside = ~(stop | (data == 32))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    at = np.flatnonzero(begin | stop)
    word = ~stop[at]
    size = np.ones(len(at), np.int64)
    size[word] = end - at[word]
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)

    def packed(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(eight[starts]).view(np.uint64).ravel() & _LOW_BYTES[np.minimum(sizes, 8)]
    first, second = packed(at, size), np.zeros(len(at), np.uint64)
    more = np.flatnonzero(size > 8)
    second[more] = packed(at[more] + 8, size[more] - 8)
    long = np.flatnonzero(size > 16)
    if len(long):
        second[long] = [xxhash.xxh64_intdigest(blob[a:a + n], seed) for a, n in zip(at[long].tolist(), size[long].tolist())]
    h = _mix(xxhash.xxh64_intdigest(b"", seed), [first.view(np.int64), second.view(np.int64), size])
    h[h == 0] = 1
    h[~word] = 0
    return at, size, h, first, second


def _rows(langs: list[str], ids, words, numbers, counts) -> pa.RecordBatch:
    n = len(langs)
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), ids if ids is not None else pa.nulls(n, pa.list_(pa.int64())),
         words if words is not None else pa.nulls(n, pa.string()), *(x if x is not None else pa.nulls(n, pa.int64()) for x in (numbers, counts))],
        ["lang", "ids", "word", "id", "n"])


def _occurrences(docs: DataFrame, text_col: str, lang_col: str, seed: int) -> DataFrame:
    """R1 and its dictionary. R1 rows: ``lang``, ``ids`` (0 where a piece ends). Dictionary rows: ``lang``,
    ``word``, ``id``, ``n`` (its occurrences in a batch)."""
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
                      F.col(text_col).cast("string").alias("text"))

    def flush(langs: list[str], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        blob = b" ".join([*texts, b" " * 16])
        at, size, ids, first, second = word_numbers(blob, seed)
        begins = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
        cuts = np.searchsorted(at, begins)
        yield _rows(langs, pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.view(np.int64))), None, None, None)
        kinds = {x: i for i, x in enumerate(sorted(set(langs)))}
        lang_of = np.array([kinds[x] for x in langs], np.int32).repeat(np.diff(cuts))
        for lang, i in kinds.items():
            mine = np.flatnonzero((lang_of == i) & (ids != 0))
            mine = mine[np.argsort(ids[mine])]
            # Words that share a number stay apart here, and the dictionary shows them.
            run = np.flatnonzero(np.r_[True, np.logical_or.reduce([x[mine[1:]] != x[mine[:-1]] for x in (ids, first, second, size)])]) if len(mine) else mine
            some = mine[run]
            words = [blob[a:a + n].decode("utf-8", "surrogatepass") for a, n in zip(at[some].tolist(), size[some].tolist())]
            yield _rows([lang] * len(some), None, pa.array(words, pa.string()), pa.array(ids[some].view(np.int64)),
                        pa.array(np.diff(np.r_[run, len(mine)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, texts, held = [], [], 0
        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):
                langs.append(lang.as_py())
                texts.append(folded(text.as_py()))
                held += len(texts[-1])
                if held >= _BATCH_BYTES:
                    yield from flush(langs, texts)
                    langs, texts, held = [], [], 0
        if texts:
            yield from flush(langs, texts)
    return own.mapInArrow(run, "lang string, ids array<long>, word string, id long, n long")


def _mix(lang: int, ids: list[np.ndarray]) -> np.ndarray:
    """64 bits for a phrase in a language."""
    h = np.full(len(ids[0]), lang, np.uint64)
    for i in ids:
        h = (h ^ i.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _lang_bits(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _bits(h: np.ndarray) -> np.ndarray:
    """Four of 64 bits for each hash, from its low 24 bits."""
    out = np.zeros(len(h), np.uint64)
    for shift in (0, 6, 12, 18):
        out |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return out


def bloom(frequent: DataFrame, keys: list[str], filter_words: int = FILTER_WORDS) -> np.ndarray:
    """A Bloom filter over the (lang, keys) rows: about 16 bits a row, ``filter_words`` 64-bit words at most.

    Its pieces are put together in tasks; the driver gets their bytes, never a row for each word."""
    rows, size = frequent.count(), _PIECES
    while size < min(filter_words, rows // 4):
        size *= 2
    shift, each = np.uint64(64 - (size.bit_length() - 1)), size // _PIECES

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for lang, g in p.groupby("lang", sort=False):
                h = _mix(_lang_bits(lang), [g[k].to_numpy() for k in keys])
                yield pd.DataFrame({"at": (h >> shift).astype(np.int64), "bits": _bits(h).view(np.int64)})

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = np.zeros(size, np.uint64), np.zeros(_PIECES, bool)
        for b in batches:
            at = b.column("at").to_numpy()
            np.bitwise_or.at(words, at, b.column("bits").to_numpy().view(np.uint64))
            seen[at // each] = True
        for k in np.flatnonzero(seen).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([words[k * each:(k + 1) * each].tobytes()])], ["piece", "words"])
    found = (frequent.select("lang", *keys).mapInPandas(run, "at long, bits long")
             .repartition(F.shiftright("at", each.bit_length() - 1)).mapInArrow(put, "piece long, words binary"))
    out = np.zeros(size, np.uint64)
    for b in found.toArrow().to_batches():
        for k, words in zip(b.column("piece").to_pylist(), b.column("words")):
            out[k * each:(k + 1) * each] = np.frombuffer(words.as_buffer(), np.uint64)
    return out


def _in_filter(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = _bits(h)
    return (table[(h >> np.uint64(64 - (len(table).bit_length() - 1))).astype(np.int64)] & bits) == bits


def _phrase_counts(occurrences: DataFrame, words: int, frequent: np.ndarray, min_count: int) -> DataFrame:
    """The frequent phrases of ``words`` words (``lang``, ``w1``.., ``n``), from the filter of the frequent phrases one shorter."""
    names = [f"w{i + 1}" for i in range(words)]

    def count(langs: list[str], sizes: np.ndarray, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lang in sorted(set(langs)):
            own = np.array([x == lang for x in langs])
            # Documents are kept apart by a 0 after each, like pieces.
            ids = np.insert(flat[own.repeat(sizes)], np.cumsum(sizes[own]), 0)
            n = len(ids) - words + 2
            if n < 2:
                continue
            # Occurrences one word shorter, by their first position, semi-joined with the frequent ones ...
            shorter = [ids[i:i + n] for i in range(words - 1)]
            at = np.flatnonzero(np.logical_and.reduce([s != 0 for s in shorter]))
            at = at[_in_filter(frequent, _mix(_lang_bits(lang), [s[at] for s in shorter]))]
            # ... merge-joined with those at the next position.
            at = at[:-1][np.diff(at) == 1]
            if not len(at):
                continue
            at = at[np.argsort(_mix(0, [ids[at + i] for i in range(words)]))]
            found = [ids[at + i] for i in range(words)]
            # A group ends where a word changes; a chance equality of two phrases' hashes only makes more groups.
            starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in found])])
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(starts)), *[pa.array(x[starts]) for x in found],
                 pa.array(np.diff(np.r_[starts, len(at)]))], ["lang", *names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = b.column("ids").offsets.to_numpy() - b.column("ids").offsets[0].as_py()
            low = 0
            while low < b.num_rows:
                # Rows of about _BATCH_WORDS words, one document at least.
                high = max(low + 1, int(np.searchsorted(ends, ends[low] + _BATCH_WORDS, "right")) - 1)
                part = b.slice(low, high - low)
                yield from count(part.column("lang").to_pylist(), np.diff(ends[low:high + 1]), part.column("ids").flatten().to_numpy())
                low = high
    schema = ", ".join(["lang string", *[f"{x} long" for x in names], "n long"])
    return (occurrences.mapInArrow(run, schema).groupBy("lang", *names).agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def _cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), in integers of 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    square = (wide[0] * wide[0]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square.cast("decimal(38,0)"), (wide[1] * wide[2]).cast("decimal(38,0)"))


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, half: int = 50, filter_words: int = FILTER_WORDS) -> DataFrame:
    """The ``top`` collocations of 2 and 3 words of each language: ``lang``, ``rank`` (from 1), ``phrase``, ``a``,
    ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends; words are separated by space and
    tab. ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language.
    Phrases counted under ``min_count`` times do not occur, nor pairs of which ``half`` percent stand in one frequent
    triple. Null languages are ``und``; null and empty texts have no words; repeated rows count each; an
    empty table, or one without frequent phrases, gives no rows. Other columns are not touched.
    """
    for seed in range(8):
        first = stash(_occurrences(docs, text_col, lang_col, seed), "occurrences", compression="zstd")
        listed = stash(first.filter("word IS NOT NULL").groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words")
        if listed.groupBy("id").agg(F.min("word").alias("a"), F.max("word").alias("b")).filter("a <> b").isEmpty():
            break
    else:
        raise RuntimeError("eight seeds, and two words share a number under each")
    relation = first.filter("word IS NULL").select("lang", "ids")
    size = listed.groupBy("lang").agg(F.sum("n").alias("total"))
    one = listed.filter(F.col("n") >= min_count).select("lang", "word", F.col("id").alias("w1"), "n")
    two = stash(_phrase_counts(relation, 2, bloom(one, ["w1"], filter_words), min_count), "pairs")
    three = stash(_phrase_counts(relation, 3, bloom(two, ["w1", "w2"], filter_words), min_count), "triples")

    def word(i: int, count: str | None = None) -> DataFrame:
        return one.select("lang", F.col("w1").alias(f"w{i}"), F.col("word").alias(f"t{i}"), *([F.col("n").alias(count)] if count else []))
    inside = (three.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "n")
              .groupBy("lang", "p.w1", "p.w2").agg(F.max("n").alias("longest")))
    pairs = (two.join(inside, ["lang", "w1", "w2"], "left")
             .filter(F.coalesce(100 * F.col("longest") < half * F.col("n"), F.lit(True)))
             .join(word(1, "l"), ["lang", "w1"]).join(word(2, "r"), ["lang", "w2"])
             .select("lang", F.concat_ws(" ", "t1", "t2").alias("phrase"), F.col("n").alias("a"), "l", "r",
                     _cut_score(F.col("n"), F.col("l"), F.col("r")).alias("score")))

    def cut(k: int, left: str, right: str) -> Column:
        return F.struct(_cut_score(F.col("n"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"),
                        F.col(left).alias("l"), F.col(right).alias("r"))
    triples = (three.join(two.select("lang", "w1", "w2", F.col("n").alias("n12")), ["lang", "w1", "w2"])
               .join(two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23")), ["lang", "w2", "w3"])
               .join(word(1, "n1"), ["lang", "w1"]).join(word(3, "n3"), ["lang", "w3"]).join(word(2), ["lang", "w2"])
               .withColumn("cut", F.least(cut(1, "n1", "n23"), cut(2, "n12", "n3")))
               .select("lang", F.concat_ws(" ", "t1", "t2", "t3").alias("phrase"), F.col("n").alias("a"), "cut.l", "cut.r", "cut.score"))
    # A rank limit is applied in each task before the shuffle, so a language's window reads `top` rows a task.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                          F.col("total").alias("n"), "score")
