"""Repeated substrings by blockwise suffix sorting with a difference cover.

A byte is removed if a ``length``-byte string that covers it also starts anywhere else. Whole
texts are never suffix-sorted; suffixes are cut into small buckets, and one bucket is sorted at a time:

1. Anchors. The window of a suffix is its first ``window`` positions; its anchor is the first
   position there with the smallest hash of ``GRAM`` bytes. Equal ``length``-byte strings have
   the same anchor at the same distance. Suffixes with the same anchor are neighbours, so a text gives one row per
   anchor: its run of suffixes, a hash of the ``length - window + 1`` bytes from the anchor that all of them
   hold (the bucket key), and a hash of everything they reach.
2. Buckets. A bucket with one anchor repeats nothing. Anchors whose whole reach occurs twice in the bucket are
   settled: all their suffixes repeat. Only buckets with other anchors are sorted, one anchor for each distinct reach.
3. Sorting. A difference cover of period ``v`` marks positions of a text such that any two positions
   have a common offset below v that leads both to marked ones. The marked positions' ranks (a hash of ``length - v``
   bytes) are computed where the text lies. Suffixes of a bucket are sorted by their distance to the anchor, first v bytes and last v bytes;
   ties are resolved by the ranks at the common offset. A task so needs v bytes at either end and a few
   ranks for each suffix, however long ``length`` is.
4. Keys are counted first, by cells of their hash. Cells of over ``bucket_rows`` anchors are not bucketed: each of their
   suffixes becomes one narrow row (two hashes of its ``length`` bytes), once for each batch of texts that holds it. These
   rows are range-partitioned by hash and place, so a string that a third of all texts hold spreads over many tasks;
   equal neighbours repeat, and the two ends of each range are compared with the other ranges'. Nothing is dropped.

Groups of exact copies that a Misra-Gries summary names as frequent are represented by one row; their members are
repeated as a whole. Hashes have 64 bits; a bucket's equality always rests on two of them, or on one and 2v compared bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_key, stash
from .exact_dedup import frequent

LENGTH, WINDOW, GRAM = 400, 200, 16
#: A perfect difference set modulo 31: every residue is a difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
PIECE = 1 << 18         # suffixes of a text handled at once
BUCKET_ROWS = 50_000
SUFFIXES = 1 << 19      # suffixes sorted at once
_RNG = np.random.RandomState(11)
_TABLES = _RNG.randint(0, 1 << 63, (2, 256), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def common_offsets() -> np.ndarray:
    """[i, j] -> the offset d below PERIOD with (i + d) and (j + d) both in the cover."""
    out = np.full((PERIOD, PERIOD), -1, np.int16)
    for i in range(PERIOD):
        for j in range(PERIOD):
            out[i, j] = next(d for d in range(PERIOD) if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER)
    return out


class Hashes:
    """Hashes of any substrings of ``data`` from prefix sums of table[byte] * base^position, modulo 2^64."""
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, table: int):
        if len(self._powers) <= len(data):
            n = max(2 * len(self._powers), len(data) + 1)
            for name, base in (("_powers", _BASE), ("_inverse", _BACK)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(Hashes, name, np.multiply.accumulate(p))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLES[table][data] * self._powers[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self._inverse[starts]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_minima(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the first smallest of each ``window`` consecutive values (by their upper 40 bits)."""
    n = len(h) - window + 1
    place = (h & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    pad = np.full(-len(h) % window, np.uint64(2**64 - 1))
    blocks = np.concatenate([place, pad]).reshape(-1, window)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[window - 1:window - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)


def anchor_rows(texts: list[bytes], length: int, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first suffix, distance of the anchor from it, suffixes after it, key, reach) of all anchors."""
    for run in _text_runs(texts, length):
        yield _anchors(texts, run, length, window)


def _text_runs(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of (text number, first suffix, suffixes): short texts together, long ones in pieces of PIECE suffixes."""
    pieces = [(i, at, min(PIECE, len(t) - length + 1 - at)) for i, t in enumerate(texts)
              for at in range(0, len(t) - length + 1, PIECE)]
    run, size = [], 0
    for p in [*pieces, None]:
        if run and (p is None or size + p[2] > PIECE):
            yield run
            run, size = [], 0
        if p is not None:
            run.append(p)
            size += p[2] + length


def _scan(texts, run, length, window):
    """Both hashes of the joined texts, and of each anchor: text number, first suffix and its place in the joined
    texts, distance, suffixes after it, key."""
    data = np.frombuffer(b"".join(texts[i][at:at + n + length - 1] for i, at, n in run), np.uint8)
    sizes = np.array([n + length - 1 for _, _, n in run])
    starts = np.cumsum(sizes) - sizes
    one, two = Hashes(data, 0), Hashes(data, 1)
    grams = np.arange(len(data) - GRAM + 1)
    anchor = window_minima(_mixed(one.of(grams, grams + GRAM)), window)
    suffix = np.concatenate([np.arange(s, s + n) for s, (_, _, n) in zip(starts.tolist(), run)])
    piece = np.repeat(np.arange(len(run)), [n for _, _, n in run])
    a = anchor[suffix]
    first = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(piece) != 0)])
    last = np.r_[first[1:], len(suffix)] - 1
    lo, hi, a, piece = suffix[first], suffix[last], a[first], piece[first]
    number, at = np.array([i for i, _, _ in run]), np.array([x for _, x, _ in run])
    return one, two, number[piece], lo - starts[piece] + at[piece], lo, a - lo, hi - lo, one.of(a, a + length - window + 1)


def _anchors(texts, run, length, window):
    _, two, number, at, lo, dist, more, key = _scan(texts, run, length, window)
    reach = two.of(lo, lo + more + length) * np.uint64(3) + (dist * 256 + more).astype(np.uint64)
    return number, at, dist, more, key, reach


def cells(key: np.ndarray, bits: int) -> np.ndarray:
    return (_mixed(key) >> np.uint64(64 - bits)).astype(np.int64)


def narrow_rows(texts: list[bytes], length: int, window: int, bits: int, hot: np.ndarray) -> Iterator[tuple]:
    """(text number, suffix, hash, other hash) of the first place of each distinct string, and (text number, suffix) of all
    places of those that these texts repeat, among the suffixes whose key is in a cell of ``hot``."""
    for run in _text_runs(texts, length):
        one, two, number, at, lo, _, more, key = _scan(texts, run, length, window)
        big = np.isin(cells(key, bits), hot)
        number, at, lo, n = number[big], at[big], lo[big], more[big] + 1
        who = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        text, s, x = number[who], at[who] + step, lo[who] + step
        h1, h2 = one.of(x, x + length), two.of(x, x + length)
        order = np.lexsort((h2, h1))
        lead = np.r_[True, (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)][:len(order)]
        group = np.cumsum(lead) - 1
        again = np.zeros(len(order), bool)
        again[order] = np.bincount(group)[group] > 1 if len(order) else False
        f = order[lead]
        yield text[f], s[f], h1[f], h2[f], text[again], s[again]


def combined(key: np.ndarray, reach: np.ndarray, text: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, times) with anchors of equal key and reach summed up before the shuffle: the first stands for
    all (``times`` of them) in its bucket; the others are settled (two times) and get a key of their
    own, so that a periodic text's anchors do not meet in one task."""
    order = np.lexsort((reach, key))
    k, r = key[order], reach[order]
    first = np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])]
    times = np.empty(len(key), np.int32)
    times[order] = np.diff(np.r_[np.flatnonzero(first), len(k)])[np.cumsum(first) - 1]
    rest = order[~first]
    key, times[rest] = key.copy(), 2
    key[rest] = _mixed(reach[rest] * _BASE + _mixed(lo[rest].astype(np.uint64) * _BASE + text[rest].astype(np.uint64)))
    return key, times


def _packed(lo, dist, more):
    return (lo << 16) | (dist << 8) | more


def cover_positions(lo: int, more: int) -> np.ndarray:
    """Marked positions of a text that suffixes lo .. lo+more may need: from lo to before lo+more+PERIOD."""
    p = np.arange(lo, lo + more + PERIOD)
    return p[np.isin(p % PERIOD, COVER)]


def bucket_payloads(text: bytes, rows: list[tuple[int, int]], length: int) -> Iterator[tuple[int, int, bytes]]:
    """(key, packed, payload) of the anchors ``rows`` (key, packed) of one text. A payload holds the bytes of
    all heads, of all tails, and the ranks of the marked positions."""
    data, hashes, base, end = np.frombuffer(text, np.uint8), None, 0, 0
    for key, packed in sorted(rows, key=lambda r: r[1]):
        lo, more = packed >> 16, packed & 255
        if hashes is None or lo + more + length > end:
            base, end = lo, min(len(data), lo + PIECE + 2 * length)
            hashes = Hashes(data[base:end], 0)
        marked = cover_positions(lo, more) - base
        ranks = hashes.of(marked, marked + length - PERIOD)
        yield (key, packed, text[lo:lo + more + PERIOD] + text[lo + length - PERIOD:lo + more + length]
               + ranks.astype("<u8").tobytes())


_COMMON = common_offsets()
_BEFORE = np.array([sum(c < i for c in COVER) for i in range(PERIOD)], np.int64)


def _marked_before(p: np.ndarray) -> np.ndarray:
    return p // PERIOD * len(COVER) + _BEFORE[p % PERIOD]


def repeated_suffixes(bucket: np.ndarray, packed: np.ndarray, payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(anchor number, suffix) of the suffixes in whole buckets that another anchor of the same bucket repeats.

    Suffixes are sorted by bucket, distance to the anchor, first and last PERIOD bytes, at most about SUFFIXES at once;
    what ties is compared by the cover ranks at the common offset: with one pivot of each tie, then, for each
    offset, by sorting the ranks of the suffixes that it leads to marked positions.
    """
    data = np.frombuffer(b"".join(payloads), np.uint8)
    sizes = np.fromiter(map(len, payloads), np.int64, len(payloads))
    begin = np.cumsum(sizes) - sizes
    width = max(1, SUFFIXES // len(packed))         # an anchor has one suffix at each distance
    found = [_repeated_at(bucket, packed, data, begin, near, near + width - 1) for near in range(0, 256, width)]
    who, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((s, who))
    return who[order], s[order]


def _repeated_at(bucket, packed, data, begin, near, far):
    """The repeated suffixes at distances ``near`` to ``far``."""
    lo, dist, more = packed >> 16, packed >> 8 & 255, packed & 255
    skip = np.maximum(0, dist - far)
    n = np.maximum(0, np.minimum(more, dist - near) - skip + 1)
    who = np.repeat(np.arange(len(packed)), n)
    if not len(who):
        return who, who
    step = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + skip[who]
    s, head = lo[who] + step, begin[who] + step
    tail = head + more[who] + PERIOD
    ranks_at = begin + 2 * (more + PERIOD)
    words = np.zeros((len(who), 2 * PERIOD + 2), np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(data, PERIOD)
    words[:, :PERIOD], words[:, PERIOD + 1:-1] = view[head], view[tail]
    keys = words.view(">u8").astype(np.uint64)
    fields = [bucket[who], dist[who] - step, *keys.T]
    order = np.lexsort(fields[::-1])
    new = np.r_[True, np.zeros(len(order) - 1, bool)]
    for f in fields:
        x = f[order]
        new[1:] |= x[1:] != x[:-1]
    tie = np.cumsum(new) - 1
    alive = np.bincount(tie)[tie] > 1
    order, tie = order[alive], tie[alive]
    repeated = np.zeros(len(who), bool)

    def rank(at: np.ndarray, d: np.ndarray | int) -> np.ndarray:
        w = who[at]
        i = ranks_at[w] + 8 * (_marked_before(s[at] + d) - _marked_before(lo[w]))
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)[i]).view("<u8").ravel()
    if len(order):
        lead = np.r_[True, tie[1:] != tie[:-1]]
        pivot = order[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        d = _COMMON[s[order] % PERIOD, s[pivot] % PERIOD].astype(np.int64)
        same = (rank(order, d) == rank(pivot, d)) & ~lead
        repeated[order[same]] = True
        repeated[pivot[same]] = True
        left = ~same & ~lead
        order, tie = order[left], tie[left]
    # Any two of those left have a common offset, at which both have a rank.
    for d in range(PERIOD if len(order) else 0):
        here = np.isin((s[order] + d) % PERIOD, COVER)
        at, t = order[here], tie[here]
        r = rank(at, d)
        by = np.lexsort((r, t))
        same = np.flatnonzero((np.diff(r[by]) == 0) & (np.diff(t[by]) == 0))
        repeated[at[by[same]]] = True
        repeated[at[by[same + 1]]] = True
    return who[repeated], s[repeated]


def _runs(who: np.ndarray, s: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive suffixes of an anchor as byte spans: (anchor number, start, end)."""
    first = np.flatnonzero(np.r_[True, (np.diff(who) != 0) | (np.diff(s) != 1)]) if len(s) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(s)][:len(first)] - 1
    return who[first], s[first], s[last] + length


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time: Python copies of texts stay small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _bytes_of(col: pa.Array) -> list[bytes]:
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def hot_cells(own: DataFrame, length: int, window: int, bits: int, bucket_rows: int) -> np.ndarray:
    """Cells of over ``bucket_rows`` anchors, at most one for each ``bucket_rows`` anchors."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            for _, _, _, _, key, _ in anchor_rows(_bytes_of(b.column("text")), length, window):
                cell, n = np.unique(cells(key, bits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])
    hot = (own.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
           .filter(F.col("n") > bucket_rows).select("cell").collect())
    return np.array(sorted(r["cell"] for r in hot), np.int64)


def bucketed(own: DataFrame, length: int, window: int, bits: int, hot: np.ndarray) -> DataFrame:
    """Anchors outside ``hot`` cells that repeat or may: ``row``, ``packed``, ``key``, ``settled``, ``sorts``."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            rows = b.column("row")
            for found in anchor_rows(_bytes_of(b.column("text")), length, window):
                if len(hot):
                    found = [x[~np.isin(cells(found[4], bits), hot)] for x in found]
                i, lo, dist, more, key, reach = found
                if not len(i):
                    continue
                key, times = combined(key, reach, i, lo)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(i)), pa.array(_packed(lo, dist, more)), pa.array(key.view(np.int64)),
                     pa.array(reach.view(np.int64)), pa.array(times)], ["row", "packed", "key", "reach", "times"])
    anchors = own.mapInArrow(find, "row binary, packed long, key long, reach long, times int")
    same = Window.partitionBy("key", "reach")
    per_key = Window.partitionBy("key")
    return (anchors.repartition("key")
            .withColumn("nth", F.row_number().over(same.orderBy("row", "packed")))
            .withColumn("copies", F.sum("times").over(same))
            .withColumn("reaches", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(per_key))
            .withColumn("single", F.max(F.col("copies") == 1).over(per_key))
            .filter("copies > 1 or reaches > 1")
            .select("row", "packed", "key", (F.col("copies") > 1).alias("settled"),
                    ((F.col("nth") == 1) & (F.col("reaches") > 1) & F.col("single")).alias("sorts")))


def marked_repeats(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of one range of narrow rows sorted by both hashes: the rows with an equal neighbour, and the range's first and
    last row (``edge``), only the first if their hashes are equal."""
    def out(t: pa.Table, edge: bool) -> pa.RecordBatch:
        start = t.column("start").to_numpy()
        return pa.RecordBatch.from_arrays(
            [t.column("row").combine_chunks(), pa.array(start), pa.array(start + length), t.column("one").combine_chunks(),
             t.column("two").combine_chunks(), pa.array(np.full(len(start), edge))], ["row", "start", "end", "one", "two", "edge"])

    def hashes(t: pa.Table) -> tuple:
        return t.column("one")[0].as_py(), t.column("two")[0].as_py()
    first = held = None
    was = False             # the row held equals the one before it
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        t = t.combine_chunks()
        if first is None:
            first = t.slice(0, 1)
            yield out(first, True)
        x, y = t.column("one").to_numpy(), t.column("two").to_numpy()
        same = np.r_[was, (x[1:] == x[:-1]) & (y[1:] == y[:-1])]
        yield out(t.slice(0, len(x) - 1).filter(pa.array(same[:-1] | same[1:])), False)
        held, was = t.slice(len(x) - 1), bool(same[-1])
    if held is not None:
        if was:
            yield out(held, False)
        if hashes(held) != hashes(first):
            yield out(held, True)


def hot_spans(own: DataFrame, length: int, window: int, bits: int, hot: np.ndarray) -> DataFrame:
    """(``row``, ``start``, ``end``) of the repeated suffixes whose key is in a ``hot`` cell."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "start", "end", "one", "two"]
        for b in _slices(batches):
            rows = b.column("row")
            for text, s, one, two, again, at in narrow_rows(_bytes_of(b.column("text")), length, window, bits, hot):
                who, start, end = _runs(again, at, length)
                yield pa.RecordBatch.from_arrays([rows.take(pa.array(who)), pa.array(start), pa.array(end),
                                                  pa.nulls(len(who), pa.int64()), pa.nulls(len(who), pa.int64())], names)
                yield pa.RecordBatch.from_arrays([rows.take(pa.array(text)), pa.array(s), pa.array(s + length),
                                                  pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names)
    # Written first: Spark samples range bounds in a run of its own.
    narrow = stash(own.mapInArrow(find, "row binary, start long, end long, one long, two long"), "suffixes")
    # Written as well: spans and edges must come from the same ranges.
    marked = stash(narrow.filter("one is not null").repartitionByRange("one", "two", "row", "start")
                   .sortWithinPartitions("one", "two")
                   .mapInArrow(lambda batches: marked_repeats(batches, length),
                               "row binary, start long, end long, one long, two long, edge boolean"), "marked")
    edges = marked.filter("edge")                       # at most two rows a range
    across = edges.groupBy("one", "two").agg(F.count(F.lit(1)).alias("ranges")).filter("ranges > 1").drop("ranges")
    return (narrow.filter("one is null").select("row", "start", "end")
            .unionByName(marked.filter("not edge").select("row", "start", "end"))
            .unionByName(edges.join(across, ["one", "two"]).select("row", "start", "end")))


def repeated_spans(docs: DataFrame, heavy: DataFrame, length: int, window: int, bucket_rows: int, n_bytes: int) -> DataFrame:
    """(``row_key``, ``start``, ``end``) byte spans whose every ``length``-byte string is repeated, from all rows of
    ``docs`` (``row_key``, ``digest``, ``text``; about ``n_bytes`` in all) but those that a row of ``heavy`` stands for."""
    own = (docs.filter(F.octet_length("text") >= length).join(F.broadcast(heavy), "digest", "left")
           .filter("keeper is null or keeper = row_key").select(F.unhex("row_key").alias("row"), "text"))
    # A cell has about bucket_rows / 16 anchors (a text has two for each window): few keys share one with a large key.
    bits = max(6, (32 * n_bytes // (window * bucket_rows)).bit_length())
    hot = hot_cells(own, length, window, bits, bucket_rows)
    classes = stash(bucketed(own, length, window, bits, hot), "anchors")
    first = F.shiftright("packed", 16)
    settled = classes.filter("settled").select("row", first.alias("start"), (
        first + F.col("packed").bitwiseAND(255) + length).alias("end"))
    wanted = classes.filter("sorts").groupBy("row").agg(F.collect_list(F.struct("key", "packed")).alias("at"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            for row, text, at in zip(b.column("row"), _bytes_of(b.column("text")), b.column("at").to_pylist()):
                got = list(bucket_payloads(text, [(a["key"], a["packed"]) for a in at], length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.as_py()] * len(got), pa.binary()), pa.array([x[0] for x in got], pa.int64()),
                     pa.array([x[1] for x in got], pa.int64()), pa.array([x[2] for x in got], pa.binary())],
                    ["row", "key", "packed", "payload"])
    members = own.join(wanted, "row").mapInArrow(gather, "row binary, key long, packed long, payload binary")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []         # at most 2000 rows and a bucket, besides the last batch

        def solve(t: pa.Table) -> pa.RecordBatch:
            key = t.column("key").to_numpy()
            alone = np.r_[True, key[1:] != key[:-1]] & np.r_[key[1:] != key[:-1], True]
            t = t.filter(pa.array(~alone))
            who, start, end = (np.zeros(0, np.int64),) * 3
            if t.num_rows:
                who, start, end = _runs(*repeated_suffixes(t.column("key").to_numpy(), t.column("packed").to_numpy(),
                                                           t.column("payload").to_pylist()), length)
            return pa.RecordBatch.from_arrays([t.column("row").combine_chunks().take(pa.array(who)), pa.array(start), pa.array(end)],
                                              ["row", "start", "end"])
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            last = b.column("key")[-1].as_py()
            if sum(x.num_rows for x in held) < 2000 or held[0].column("key")[0].as_py() == last:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.searchsorted(t.column("key").to_numpy(), last))          # the last bucket may go on
            yield solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))
    spans = settled.unionByName(members.repartition("key").sortWithinPartitions("key", "row", "packed")
                                .mapInArrow(sort, "row binary, start long, end long"))
    if len(hot):
        spans = spans.unionByName(hot_spans(own, length, window, bits, hot))
    return spans.select(F.lower(F.hex("row")).alias("row_key"), "start", "end")


def remove_spans(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, what is left)."""
    kept, at, runs, gone = [], 0, 0, 0
    end = -1
    for a, b in sorted(spans):
        if a > end:
            runs += 1
            kept.append(text[at:a])
        gone += max(0, b - max(a, end))
        end = max(end, b)
        at = end
    kept.append(text[at:])
    return gone, runs, b"".join(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   window: int = WINDOW, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and
    ``kept`` (the bytes left, which may cut a character).

    Every byte covered by a ``length``-byte string that also starts elsewhere, in the same or another row, is removed;
    strings are judged on the input. Null text is empty; texts shorter than ``length`` lose nothing; repeated rows repeat each
    other. An empty table gives no rows.
    """
    if not PERIOD < length or not GRAM <= length - window + 1 or window > 256:
        raise ValueError("length must exceed PERIOD and window + GRAM - 2; window is at most 256")
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                      row_key(id_col, text_col).alias("row_key"))
    own = own.withColumn("digest", F.sha2("text", 256))
    digests = stash(own.filter(F.octet_length("text") >= length).select("digest", "row_key", F.octet_length("text").alias("n")),
                    "digests")
    n_bytes = digests.agg(F.sum("n")).first()[0] or 0
    # At most the 1000 rows that the summary names.
    heavy = (digests.join(F.broadcast(frequent(digests, "digest")), "digest", "left_semi").groupBy("digest")
             .agg(F.min("row_key").alias("keeper"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
             .select("digest", "keeper"))
    heavy = stash(heavy, "heavy")
    spans = (repeated_spans(own, heavy, length, window, bucket_rows, n_bytes).groupBy("row_key")
             .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans")))
    rows = (own.join(F.broadcast(heavy.select("digest", F.lit(True).alias("whole"))), "digest", "left")
            .join(spans, "row_key", "left").select("id", "text", "whole", "spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            texts, out = _bytes_of(b.column("text")), []
            for text, whole, spans in zip(texts, b.column("whole").to_pylist(), b.column("spans").to_pylist()):
                out.append(remove_spans(text, [(0, len(text))] if whole else [(s["start"], s["end"]) for s in spans or ()]))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.int64()), pa.array([hashlib.sha256(x[2]).hexdigest() for x in out], pa.string()),
                 pa.array([x[2] for x in out], pa.binary())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    kind = own.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
                           ).withColumnRenamed("id", id_col)
