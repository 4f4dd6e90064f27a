"""Mixing, decontamination, the URL filter and toxicity."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import decontaminate as dc
from claimlake.llm import mixing, toxicity, url_filter

from . import reference as ref
from .conftest import prose


def mixed_rows(rng):
    rows = [(1, None, "a"), (2, "", "a"), (None, "one two", "b"), (None, "one two three", None), (5, "x " * 5000, "long"), (5, "x", "long"),
            (6, "same row", "b"), (6, "same row", "b"), (7, " \t", "blank"), (8, "z", "Z"), (9, "é ß", "é")]
    return rows + [(100 + i, prose(rng, rng.randint(1, 50)), f"s{i % 7 if i % 3 else 0}") for i in range(400)]


def test_mix_reaches_its_targets(docs_of, rng):
    rows = mixed_rows(rng)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(ref.words(t))
    want = ref.targets(sizes)
    got = mixing.mix_sources(docs_of(rows), rows_per_range=16).collect()
    again = mixing.mix_sources(docs_of(rows, 7), rows_per_range=1000).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))     # neither layout nor ranges matter
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault((r["source_size"], round(r["target"], 6)), []).append(r)
        assert 0 <= r["taken"] <= 2 * r["size"] and sum(c["words"] for c in r["copies"] or []) == r["taken"]
        times = [c["time"] for c in r["copies"] or []]
        assert times == sorted(times) and all(0 <= t <= 1 for t in times)
    assert set(by) == {(sizes[s], round(want[s], 6)) for s in sizes}
    assert sum(r["taken"] for r in got) == sum(math.floor(want[s] + 0.5) for s in sizes)
    order = mixing.training_order(docs_of(rows), mixing.mix_sources(docs_of(rows)))
    out = order.collect()
    assert [r["mix_position"] for r in out] == sorted(r["mix_position"] for r in out)
    assert len(out) == sum(len(r["copies"] or []) for r in got) and sum(r["mix_words"] for r in out) == sum(r["taken"] for r in got)
    assert set(docs_of(rows).columns) < set(order.columns)
    assert mixing.mix_sources(docs_of(rows).limit(0)).count() == 0


def test_demand_is_inverted(spark):
    knots = [(0.0, 0.0), (0.25, 4.0), (0.5, 0.0), (0.75, 0.0), (1.0, 2.0)]
    seg = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("time", "before", "rate", "slope", "whole"), s)])
                    for s in mixing.segments(knots)])
    shares = [i / 200 for i in range(200)]
    got = spark.createDataFrame([(x,) for x in shares], "x double").select("x", mixing.time_of_demand(F.col("x"), seg).alias("t")).collect()
    ts = np.linspace(0, 1, 200_001)
    rate = np.interp(ts, *zip(*knots))
    area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
    for x, t in got:
        assert abs(np.interp(t, ts, area / area[-1]) - x) < 1e-6
    for bad in ([(0.0, 1.0)], [(0.0, 0.0), (1.0, 0.0)], [(0.0, 1.0), (0.0, 1.0)], [(0.0, -1.0), (1.0, 3.0)]):
        with pytest.raises(ValueError):
            mixing.segments(bad)


def contaminated_rows(rng):
    items = [(1, prose(rng, 40)), (2, prose(rng, 13)), (3, "Only Four words here"), (4, "unique"), (5, None), (6, "..."), (None, prose(rng, 20)),
             (1, prose(rng, 25))]
    ws = items[0][1].split(" ")
    rows = [(1, None), (2, ""), (3, "--- !!"), (4, items[0][1].upper() + " x"), (5, ", ".join(ws[3:16])), (6, " ".join(ws[3:15])),
            (7, "only\x00FOUR...words here"), (8, "unique " * 4 + prose(rng, 400)), (9, "unique"), (9, "unique"), (None, items[6][1]),
            (10, prose(rng, 30_000) + " " + items[1][1] + " " + prose(rng, 10)), (11, items[1][1] + " " + items[1][1])]
    return rows + [(100 + i, " ".join([prose(rng, rng.randint(0, 60)), " ".join(ws[i % 30:i % 30 + 20]), prose(rng, 5)])) for i in range(60)], items


@pytest.mark.parametrize("broadcast_chars", [10**6, 10])
def test_decontamination(spark, docs_of, rng, broadcast_chars):
    rows, items = contaminated_rows(rng)
    bench = spark.createDataFrame([(*i, "w") for i in items], "item_id long, text string, words string")
    got = dc.decontaminate(docs_of(rows), bench, broadcast_chars=broadcast_chars).collect()
    want = [(str(i), n, h, found, ref.sha(",".join(found)), h > 0 and 20 * h >= n)
            for (i, _), (n, h, found) in zip(rows, ref.contamination([t for _, t in rows], items))]
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], list(r["items"]), r["items_sha256"], r["contaminated"]) for r in got) == sorted(want)
    clean = dc.clean_documents(docs_of(rows), bench, broadcast_chars=broadcast_chars)
    assert clean.count() == sum(not w[-1] for w in want) and clean.columns == docs_of(rows).columns
    assert dc.decontaminate(docs_of(rows), bench.limit(0)).filter("contaminated or n_hit > 0").count() == 0
    assert dc.decontaminate(docs_of(rows).limit(0), bench).count() == 0


URLS = ["http://WWW.Example.ORG/es/1", "https://example.org/en/1x?q", "http://a.com/fr/", "http://com/de/x", "x://notorg/", "http://sub.org", "http://org/#f",
        "no scheme.org/", None, "", "://org/es/", "http://example.org/en/2", "http://badexample.org/es/1", "http://u@b.com:80/de/?x#y",
        "http://a?b/c", "a://b://c.org/", "http://İ.org/", "http://a.org/x\ny/../?"]


def test_url_rules(spark):
    def judge(u):
        import re
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
            host = ref.lower_ascii(host)
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *(max(fits)[1:] if fits else (None, None))
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: r for r in url_filter.url_verdicts(df).collect()}
    for i, u in enumerate(URLS * 2):
        host, path, rule, verdict = judge(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if rule else got[i]["verdict"] in ("allow", "block")
    assert url_filter.url_verdicts(df.limit(0)).count() == 0


def test_url_model_on_unseen_hosts(spark):
    junk = ["http://www.pills-discount.example.com/x", "http://casino-bonus.example.net/en/3", "http://spam-links.example.com/en/9"]
    fine = ["http://www.librarian.example.com/en/9", "https://m.observatory.example.net/de/4", "http://thonan.example.net/es/5", None]
    df = spark.createDataFrame(list(enumerate(junk + fine)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.url_verdicts(df, rules=()).collect()}
    assert [got[i]["verdict"] for i in range(7)] == ["block"] * 3 + ["allow"] * 4
    plan = url_filter.url_verdicts(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    with pytest.raises(ValueError):
        url_filter.train_url_model(spark, spark.createDataFrame([("a", 1)] * 3, "url string, label int"), max_labelled=2)


def toxic_rows(rng, n=400):
    bad = ["vexidiot", "vexmoron", "scummy"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        docs.append((i, prose(rng, 30) + (f" {rng.choice(bad)} {rng.choice(bad)}er" if toxic else "")))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_fit_takes_one_row_of_an_id(spark, docs_of, rng):
    """A labelled id with very many rows neither fills the driver nor dominates the fit."""
    docs, labels = toxic_rows(rng)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    want = toxicity.train_toxicity(docs_of(docs), lab)
    assert toxicity.train_toxicity(docs_of(docs + [docs[0]] * 400 + [(docs[1][0], None)] * 50), lab) == want


def test_toxicity_held_out(spark, docs_of, rng):
    docs, labels = toxic_rows(rng)
    df = docs_of(docs + [(None, "scummy"), (9000, None), (9001, ""), (9002, prose(rng, 60_000)), (3, docs[3][1])])
    lab = spark.createDataFrame([(i, 1, t, "s") for i, t in labels] + [(None, 0, 1, "s"), (5, 0, None, "s"), (3, 1, 0, "s")],
                                "doc_id long, quality int, toxic int, score string")
    model = toxicity.train_toxicity(df, lab.filter("doc_id % 3 <> 1"))
    out = toxicity.score_toxicity(df, model, score_col="p")
    rows = out.collect()
    assert len(rows) == len(docs) + 5 and set(out.columns) == set(df.columns) | {"p"}
    score = {r["doc_id"]: r["p"] for r in rows}
    held = [(i, t) for i, t in labels if i % 3 == 1]
    assert sum((score[i] >= 0.7) == bool(t) for i, t in held) >= 0.97 * len(held)
    assert score[None] >= 0.7 and score[9000] == score[9001] < 0.7 and all(0 <= r["p"] <= 1 for r in rows)
    assert model == toxicity.train_toxicity(df.repartition(5), lab.filter("doc_id % 3 <> 1"))
    none = toxicity.train_toxicity(df, lab.limit(0))
    assert toxicity.score_toxicity(df, none).filter("score > 0.01").count() == 0
    assert toxicity.score_toxicity(df.limit(0), model).count() == 0


def test_counterfactuals_spare_neutral_mentions(spark, docs_of, rng):
    """Group names that occur mostly in toxic training texts do not make a neutral mention toxic."""
    docs, labels = toxic_rows(rng)
    docs = [(i, t + (f" {rng.choice(['muslim', 'jewish', 'gay'])}" if i % 4 == 0 and rng.random() < 0.9 else
                     f" {rng.choice(['christian', 'straight'])}" if rng.random() < 0.5 else "")) for i, t in docs]
    df, lab = docs_of(docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    neutral = [prose(rng, 30) + " " + g for g in ("muslim", "jewish", "gay") for _ in range(5)]
    plain = toxicity.train_toxicity(df, lab, swap_penalty=0.0)
    fair = toxicity.train_toxicity(df, lab, swap_penalty=5.0)
    rise = {m: np.mean([mod.score(t) - mod.score(t.rsplit(" ", 1)[0]) for t in neutral]) for m, mod in (("plain", plain), ("fair", fair))}
    assert rise["fair"] < rise["plain"] / 2
    assert sum(fair.score(t) >= 0.7 for t in neutral) == 0
    assert sum((fair.score(t) >= 0.7) == (i % 4 == 0) for i, t in docs) >= 0.97 * len(docs)
    assert toxicity.swapped({"no", "group"}) == [] and {"man", "old"} <= toxicity.swapped({"woman", "young"})[0]


def test_hot_ids_and_repeated_rows(docs_of, rng, monkeypatch):
    """A third of the rows is one row, a third has one id with texts of its own: the queue is the plain one, and no range is large."""
    monkeypatch.setattr(mixing, "REPEATS_PER_ROW", 7)
    rows = [(1, "the same words", "a")] * 150 + [(2, prose(rng, 1 + i % 20), "a") for i in range(150)]
    rows += [(10 + i, prose(rng, 1 + i % 9), "ab"[i % 2]) for i in range(150)]
    got = mixing.mix_sources(docs_of(rows), rows_per_range=5).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs_of(rows, 5), rows_per_range=100_000).collect()))
    assert len(got) == len(rows)
    sizes = {s: sum(len(ref.words(t)) for _, t, x in rows if x == s) for s in "ab"}
    want = ref.targets(sizes)
    assert sum(r["taken"] for r in got) == sum(math.floor(want[s] + 0.5) for s in sizes)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    # Copies of a source neither overlap nor leave words out: the queue is walked from word to word.
    firsts = sorted((r["copies"][0]["time"], r["size"]) for r in got if r["copies"] and r["source_size"] == sizes["a"])
    assert len({t for t, _ in firsts}) == len(firsts)
    sized = docs_of(rows).selectExpr("doc_id id", "text", "size(split(text, ' ')) size", "md5(string(doc_id)) okey", "md5(text) row_key").drop("text").distinct()
    filled = mixing.in_ranges(sized, sized.count(), 5).groupBy("range").count().collect()
    assert max(r["count"] for r in filled) <= 30 and len(filled) > 30
