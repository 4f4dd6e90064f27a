"""Exact, SimHash and suffix deduplication against brute force, with awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import exact_dedup as ed
from claimlake.llm import simhash as sh
from claimlake.llm import suffix_dedup as sd
from claimlake.llm.common import drop_rows, keep_one

from . import reference as ref
from .conftest import prose


def awkward(rng):
    """Nulls, blanks, ties, repeated rows, copies, near copies, one very long text."""
    base = prose(rng, 120)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a  b"), (None, "ab"), (9, base),
            (9, base), (None, None), (None, base + " x"), (12, base.upper()), (13, "AB"), (14, prose(rng, 30_000))]
    for i in range(40):
        w = base.split(" ")
        w[rng.randrange(len(w))] = "edited"
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, base) for i in range(60)] + [(300 + i, prose(rng, rng.randint(1, 60))) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("heavy", [1, 50])
def test_exact_dedup(docs_of, rng, heavy):
    rows = awkward(rng)
    want = ref.exact(rows)
    got = ed.exact_dedup(docs_of(rows), heavy=heavy, tracked=64).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in got) == sorted(
        (str(rows[n][0]), str(k), g, kept, s) for n, (k, g, kept, s) in want.items())
    decided = ed.exact_dedup(docs_of(rows), heavy=heavy, tracked=64)
    kept = keep_one(docs_of(rows), decided.filter("kept").select("row_key"))
    assert kept.columns == docs_of(rows).columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(str(rows[n]) for n, (_, _, k, _) in want.items() if k)
    # Repeated rows go together.
    keys = decided.filter("kept").select("row_key")
    left = drop_rows(docs_of(rows), keys)
    assert left.columns == docs_of(rows).columns
    assert {(r["doc_id"], r["text"]) for r in left.collect()}.isdisjoint({(r["doc_id"], r["text"]) for r in kept.collect()})


def test_a_row_repeated_in_a_third_of_the_table(spark, docs_of, rng):
    """Its copies leave on the map side (so they come from many partitions), one stays, and no task gets them all."""
    rows = [(7, "hot text")] * 600 + [(None, "nobody's")] * 300 + [(1000 + i, prose(rng, 6) + str(i)) for i in range(900)]
    docs = docs_of(rows, 12)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "8k")
    try:
        out = ed.exact_dedup(docs).withColumn("part", F.spark_partition_id())
        assert out.filter("kept").count() == 902
        for group, copies in ((600, 599), (300, 299)):
            parts = [r["count"] for r in out.filter(f"group_size = {group} and not kept").groupBy("part").count().collect()]
            assert sum(parts) == copies and len(parts) >= 6 and max(parts) <= copies / 3
        keys = out.filter("kept").select("row_key")
        kept = keep_one(docs, keys)
        assert kept.count() == 902 and kept.filter("doc_id = 7").count() == 1 and kept.filter("doc_id is null").count() == 1
        # Reduced before the shuffle: the partial aggregate stands below the exchange.
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "partial_first" in plan and plan.index("Exchange hashpartitioning(key") < plan.index("partial_first")
        assert drop_rows(docs, keys.limit(0)).count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_heavy_groups_skip_the_shuffle(docs_of, rng):
    rows = [(i, "copy") for i in range(500)] + [(1000 + i, prose(rng, 5) + str(i)) for i in range(100)]
    out = ed.exact_dedup(docs_of(rows), heavy=10, tracked=64)
    assert out.filter("group_size = 500").count() == 500 and out.filter("kept").count() == 101
    plan = out._jdf.queryExecution().toString()
    assert "BatchEvalPython" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan


def test_simhash_fingerprints(rng):
    for t in [None, "", " \n", "one", "Ein zwei DREI", "é ß 日本 x y", prose(rng, 500), "x " * 70_000]:
        assert sh.fingerprint(t) == ref.fingerprint(t) if len(t or "") < 9000 else sh.fingerprint(t) == sh.fingerprint("x " * 4)


def test_covering_masks_cover_every_pair():
    masks, rng = sh.masks(4), np.random.RandomState(1)
    assert len(masks) == 31
    for _ in range(3000):
        diff = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(diff & m == 0 for m in masks)
    blocks = sh._blocks(masks[3], 4)
    assert sum(blocks) == ~masks[3] & (1 << 64) - 1 and len(blocks) == 5


@pytest.mark.parametrize("bucket_rows", [20, 100_000])
def test_simhash_groups(docs_of, rng, bucket_rows):
    rows = awkward(rng)
    fps = [ref.fingerprint(t) if len(t or "") < 20_000 else sh.fingerprint(t) for _, t in rows]
    roots = ref.connected(fps, lambda a, b: bin(a ^ b).count("1") <= 4)
    ids = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            ids[r] = min(ids.get(r, i), i)
    got = sh.simhash_groups(docs_of(rows), bucket_rows=bucket_rows).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == sorted(
        (str(i), format(f, "016x"), str(ids.get(r))) for (i, _), f, r in zip(rows, fps, roots))
    kept = sh.one_per_group(docs_of(rows), bucket_rows=bucket_rows)
    assert kept.count() == len(set(roots)) and kept.columns == docs_of(rows).columns


def test_dense_bucket_gives_few_links(spark, rng):
    """A ball of close fingerprints: linked, but by far fewer links than it has pairs."""
    centre = rng.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(10), rng.randint(0, 4))) for _ in range(600)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for limit in (100, 100_000):
        found = sh.links(df, bucket_rows=limit)
        rows = found.collect()
        assert all(bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 4 for r in rows)
        roots = sh.components(found)
        assert roots.select("root").distinct().count() == 1 and roots.count() == len(fps)
        assert len(rows) < len(fps) * 31


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in sh.components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert sh.components(edges.limit(0)).count() == 0


def test_difference_cover_has_a_common_offset():
    d = sd.common_offsets()
    i, j = np.indices(d.shape)
    assert (d >= 0).all() and np.isin((i + d) % sd.PERIOD, sd.COVER).all() and np.isin((j + d) % sd.PERIOD, sd.COVER).all()


def passages(rng):
    shared = [prose(rng, 60) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, "short"), (4, "a" * 3000), (5, "ab" * 700), (6, "ba" * 300), (None, "x" + "a" * 900)]
    for i in range(40):
        t = prose(rng, rng.randint(0, 80)) + rng.choice(shared) + prose(rng, rng.randint(0, 80))
        if i % 3 == 0:
            t += rng.choice(shared)[rng.randint(0, 100):]
        rows.append((10 + i, t))
    copy = prose(rng, 150)
    for i in range(30):
        w = copy.split(" ")
        w[rng.randrange(len(w))] = str(i)
        rows.append((100 + i, " ".join(w)))
    rows += [(200 + i, copy) for i in range(20)] + [(7, shared[0] * 3), (7, shared[0] * 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("length", "window", "bucket_rows"), [(400, 200, 50_000), (400, 200, 2), (120, 40, 3)])
def test_suffix_dedup(docs_of, rng, monkeypatch, length, window, bucket_rows):
    rows = passages(rng)
    texts = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), t, flags in zip(rows, texts, ref.repeats(texts, length)):
        runs = sum(f and not (k and flags[k - 1]) for k, f in enumerate(flags))
        want.append((str(i), len(t), sum(flags), runs, ref.sha(bytes(b for b, f in zip(t, flags) if not f))))
    got = sd.remove_repeats(docs_of(rows), length=length, window=window, bucket_rows=bucket_rows).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(want)


def test_passage_in_most_documents_is_not_held_in_one_bucket(spark, docs_of, rng):
    """Different text around one passage: each document has reaches of its own under the same two keys."""
    passage = prose(rng, 130)
    rows = [(i, prose(rng, 40) + passage[rng.randint(0, 9):len(passage) - rng.randint(0, 9)] + prose(rng, 40)) for i in range(120)]
    own = spark.createDataFrame([(str(i).encode(), t) for i, t in rows], "row binary, text string").repartition(3)
    hot = sd.hot_cells(own, 400, 200, 12, 20)
    assert len(hot)
    cold = sd.bucketed(own, 400, 200, 12, hot).groupBy("key").count()
    assert (cold.agg({"count": "max"}).first()[0] or 0) <= 20
    texts = [t.encode() for _, t in rows]
    want = sorted((i, sum(f)) for (i, _), f in zip(rows, ref.repeats(texts, 400)))
    for parts in ("1", "4", "64"):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = sd.remove_repeats(docs_of(rows), bucket_rows=20).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        assert sorted((r["doc_id"], r["n_removed"]) for r in got) == want


def test_ties_that_differ_in_the_middle_take_one_pass(rng):
    """Equal ends, all middles different but two: no round for each member of the tie."""
    import time
    mids = [f"{i:08d}".encode() for i in range(20_000)] + [b"00000007"]
    texts = [b"a" * (i % 31) + b"h" * 150 + m + b"t" * 242 for i, m in enumerate(mids)]
    packed = np.array([(i % 31) << 16 for i in range(len(texts))])
    pay = [next(sd.bucket_payloads(t, [(1, int(p))], 400))[2] for t, p in zip(texts, packed)]
    t0 = time.process_time()
    who, s = sd.repeated_suffixes(np.ones(len(texts), np.int64), packed, pay)
    assert who.tolist() == [7, 20_000] and s.tolist() == [7, 20_000 % 31]
    assert time.process_time() - t0 < 10


def test_ranges_of_narrow_rows_meet_at_their_edges():
    import pyarrow as pa

    def rows(hashes, at):
        return pa.RecordBatch.from_arrays([pa.array([b"r"] * len(hashes), pa.binary()), pa.array(range(at, at + len(hashes))),
                                           pa.array(hashes), pa.array(hashes)], ["row", "start", "one", "two"])
    found = [x for b in sd.marked_repeats(iter([rows([1, 2, 2], 0), rows([2, 3], 3), rows([4], 5)]), 400) for x in b.to_pylist()]
    assert sorted(x["start"] for x in found if not x["edge"]) == [1, 2, 3]
    assert [(x["start"], x["one"]) for x in found if x["edge"]] == [(0, 1), (5, 4)]
    one = [x for b in sd.marked_repeats(iter([rows([9, 9], 0)]), 400) for x in b.to_pylist()]
    assert [x["edge"] for x in one].count(True) == 1 and len(one) == 3


def test_long_texts_are_taken_in_pieces(monkeypatch, rng):
    """Anchors of a text do not depend on where its pieces are cut."""
    text = prose(rng, 3000).encode()
    whole = {(int(lo) + int(d), int(k)) for _, lo, d, m, k, _ in (x for b in sd.anchor_rows([text], 400, 200) for x in zip(*b))}
    monkeypatch.setattr(sd, "PIECE", 700)
    cut = {(int(lo) + int(d), int(k)) for _, lo, d, m, k, _ in (x for b in sd.anchor_rows([b"", text, b"x"], 400, 200) for x in zip(*b))}
    assert whole == cut


def test_empty_tables(docs_of):
    none = docs_of([(1, "x")]).limit(0)
    assert ed.exact_dedup(none).count() == 0
    assert sh.simhash_groups(none).count() == 0 and sh.one_per_group(none).count() == 0
    assert sd.remove_repeats(none).count() == 0
