"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are computed where the text lies (Arrow batches); only (id, fingerprint) go on.
Covering LSH: every bit position gets a vector of radius+1 bits, and for each of the
2^(radius+1) - 1 nonzero vectors v, table v keeps the bits whose vector has odd inner product
with v. Any ``radius`` differing bits have vectors that some v is orthogonal to, so in table v they
are all masked out: each pair within the radius meets in at least one table, with certainty.

Work is done per distinct fingerprint, so copies cost nothing. Bucket members are sorted
into tasks by (table, masked bits); a bucket is walked breadth first, each visited fingerprint
taking all unvisited ones within the radius with it, so a bucket of n close fingerprints
yields at most n-1 links and never all its pairs. Buckets larger than ``bucket_rows`` are first
split over the blocks of their free bits: members within the radius agree on one of radius+1
blocks, so the split loses no pair. Components come from a distributed
alternating star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_UPPER, keep_one, row_key, stash

RADIUS, SHINGLE, SEED = 4, 4, 42
BUCKET_ROWS = 1_000_000
SALTS = 32
_BLOCK = 1 << 16
_LOWER = {ord(c): ord(c.lower()) for c in ASCII_UPPER}
_SPACES = str.maketrans("\t\n\x0b\f\r", "     ")


def _words(text: str) -> list[str]:
    return [w for w in text.translate(_LOWER).translate(_SPACES).split(" ") if w]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash over word shingles, repeats included; no words: 0."""
    words = _words(text or "")
    if not words:
        return 0
    data = " ".join(words).encode("utf-8", "surrogatepass")
    lengths = np.fromiter((len(w.encode("utf-8", "surrogatepass")) for w in words) if not data.isascii()
                          else map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - shingle + 1)
    firsts, lasts = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        part = np.array([h(data[a:b], seed) for a, b in zip(firsts[i:i + _BLOCK], lasts[i:i + _BLOCK])],
                        np.uint64)
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    """id, ``fp`` (the 64 bits as a long) and ``row_key`` for every row."""
    own = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"),
                      F.col(text_col).cast("string").alias("text"))
    kind = own.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle, seed) for t in b.column("text").to_pylist()),
                              np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("row_key"), pa.array(fps.view(np.int64))], ["id", "row_key", "fp"])
    return own.mapInArrow(run, f"id {kind}, row_key string, fp long")


def masks(radius: int, bits: int = 64) -> list[int]:
    """The covering masks, one per nonzero vector of radius+1 bits; bit i has a fixed vector."""
    dims = radius + 1
    rng = np.random.RandomState(7)
    vectors = rng.permutation([i % (1 << dims) for i in range(bits)])
    return [sum(1 << i for i in range(bits) if bin(int(vectors[i]) & v).count("1") & 1)
            for v in range(1, 1 << dims)]


def _blocks(mask: int, radius: int) -> list[int]:
    """The bits that ``mask`` leaves free, dealt over radius+1 blocks."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [sum(1 << i for i in free[b::radius + 1]) for b in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (verified, within the radius) that connect what the full link graph of ``fps``
    (distinct, uint64) connects: a breadth-first walk that compares each visited member with
    those not yet reached."""
    left, out_a, out_b, queue = fps, [], [], []
    while len(left):
        if not queue:
            queue.append(left[0])
            left = left[1:]
        here = queue.pop()
        near = np.bitwise_count(left ^ here) <= radius
        if near.any():
            got = left[near]
            out_a.append(np.full(len(got), here, np.uint64))
            out_b.append(got)
            queue.extend(got)
            left = left[~near]
    if not out_a:
        return fps[:0], fps[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def _walk(mask: np.ndarray, bucket: np.ndarray, fp: np.ndarray, radius: int, limit: int) -> pd.DataFrame:
    """Of rows sorted by (mask, bucket): links inside the buckets (``a``, ``b``, mask null), and the
    rows of buckets over ``limit`` unchanged (``a`` the fingerprint, mask kept)."""
    edge = np.flatnonzero((np.diff(mask) != 0) | (np.diff(bucket) != 0)) + 1
    starts, ends = np.r_[0, edge], np.r_[edge, len(fp)]
    size = ends - starts
    two = starts[size == 2]
    x, y = fp[two], fp[two + 1]
    close = np.bitwise_count(x ^ y) <= radius
    a, b = [x[close]], [y[close]]
    for s, e in zip(starts[(size > 2) & (size <= limit)], ends[(size > 2) & (size <= limit)]):
        p, q = spanning_links(fp[s:e], radius)
        a.append(p)
        b.append(q)
    out = [pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64),
                         "mask": pd.array([pd.NA] * sum(map(len, a)), "Int64")})]
    big = np.repeat(size > limit, size)
    if big.any():
        out.append(pd.DataFrame({"a": fp[big].view(np.int64), "b": fp[big].view(np.int64),
                                 "mask": pd.array(mask[big], "Int64")}))
    return pd.concat(out)


def _bucket_links(keyed: DataFrame, radius: int, limit: int) -> DataFrame:
    """``_walk`` over all buckets of (fp, mask, bucket). Rows stream through each task in
    bucket order; a task holds two buckets' worth of at most ``limit`` rows."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows, spill = [], 0, None
        for p in parts:
            m, k, f = p["mask"].to_numpy(), p["bucket"].to_numpy(), p["fp"].to_numpy().view(np.uint64)
            if spill is not None:               # the rest of a bucket already known to be too large
                same = (m == spill[0]) & (k == spill[1])
                if same.any():
                    yield pd.DataFrame({"a": f[same].view(np.int64), "b": f[same].view(np.int64),
                                        "mask": pd.array(m[same], "Int64")})
                    m, k, f = m[~same], k[~same], f[~same]
                if not len(f):
                    continue
                spill = None
            held.append((m, k, f))
            rows += len(f)
            if rows <= limit:
                continue
            m, k, f = (np.concatenate(x) for x in zip(*held))
            last = int(np.flatnonzero((m != m[-1]) | (k != k[-1]))[-1]) + 1 if ((m != m[-1]) | (k != k[-1])).any() else 0
            if last:
                yield _walk(m[:last], k[:last], f[:last], radius, limit)
            m, k, f = m[last:], k[last:], f[last:]
            held, rows = [(m, k, f)], len(f)
            if rows > limit:
                yield _walk(m, k, f, radius, limit)
                spill, held, rows = (m[0], k[0]), [], 0
        if rows:
            m, k, f = (np.concatenate(x) for x in zip(*held))
            yield _walk(m, k, f, radius, limit)
    return (keyed.repartition("mask", "bucket").sortWithinPartitions("mask", "bucket")
            .mapInPandas(run, "a long, b long, mask long"))


def links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (``a``, ``b``) among distinct fingerprints (column ``fp``): every pair returned is
    within the radius, and every pair within it is connected by what is returned."""
    tables = F.explode(F.array(*[F.lit(_signed(m)) for m in masks(radius)])).alias("mask")
    keyed = distinct.select("fp", tables)
    found: DataFrame | None = None
    while True:
        done = stash(_bucket_links(keyed.withColumn("bucket", F.col("fp").bitwiseAND(F.col("mask"))),
                                   radius, bucket_rows), "links")
        own = done.filter("mask is null").select("a", "b")
        found = own if found is None else found.unionByName(own)
        large = done.filter("mask is not null")
        if large.isEmpty():
            return found.distinct()
        # The free bits of a large bucket are dealt over radius+1 blocks; masks depend on the radius only.
        split = [(_signed(m), _signed(m | b)) for m in {r.mask & (2**64 - 1) for r in
                 large.select("mask").distinct().collect()} for b in _blocks(m, radius)]
        finer = distinct.sparkSession.createDataFrame(split, "mask long, finer long")
        keyed = large.select(F.col("a").alias("fp"), "mask").join(F.broadcast(finer), "mask").select(
            "fp", F.col("finer").alias("mask"))


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``): the smallest node reachable.

    Alternating large-star and small-star contraction; each round is written to the shared
    folder, and the loop ends when a round changes nothing.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = stash(e, "edges"), None
    while True:
        print_ = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if print_["n"] == 0 or print_ == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
        before = print_
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = stash(small.distinct(), "edges")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                   shingle: int = SHINGLE, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 hex digits), ``component_id`` (the
    smallest id reachable over links of at most ``radius`` bits, itself included), ``keeper``
    (its row is the component's first by id) and ``row_key``.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Null
    ids come last; a component of null ids only has a null id. Repeated rows share their result.
    Whole texts are hashed, block by block. An empty table gives no rows.
    """
    fps = stash(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    first = F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row_key")).alias("first")
    classes = stash(fps.groupBy("fp").agg(first), "classes")
    roots = components(links(classes.select("fp"), radius, bucket_rows))
    # A component may hold a third of all fingerprints: its members are dealt over salts, its one head has a copy for each.
    salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).alias("salt")
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", "root", F.coalesce("root", "fp").alias("group"), salt)
    heads = (placed.filter("root is not null").groupBy("group").agg(F.min("first").alias("head"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    named = placed.join(heads, ["group", "salt"], "left").select("fp", F.coalesce("head", "first").alias("head"))
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.id").alias("component_id"), (F.col("row_key") == F.col("head.row_key")).alias("keeper"),
        "row_key")


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are their component's keeper, one row for each component."""
    groups = simhash_groups(docs, **options)
    return keep_one(docs, groups.filter("keeper").select("row_key"), options.get("id_col", "doc_id"), options.get("text_col", "text"))
