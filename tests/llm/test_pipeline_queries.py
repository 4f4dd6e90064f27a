"""Registered queries against DuckDB, and the pipeline against its stages done by brute force."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as cp
from claimlake.llm import toxicity
from claimlake.llm.oracle import ORACLE
from claimlake.llm.queries import QUERIES, learnable
from tests.conftest import SF_SMALL

from . import reference as ref
from .conftest import prose


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(map(str, r)) for r in df.select(*cols).collect()) == sorted(tuple(map(str, r)) for r in cur.fetchall())


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ["op6_toxicity", "op9_secret_scan", "op10_url_filter", "op13_html_extract"])
def test_other_queries_cover_their_tables(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    table, key = ("pages", "page_id") if name in ("op10_url_filter", "op13_html_extract") else ("documents", "doc_id")
    ids = [r[0] for r in df.select(key).collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).collect())


def test_pipeline_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.train_toxicity(docs, learnable(spark.read.parquet(f"{SF_SMALL}/labels.parquet")))
    left = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    left = [r for r in left if model.score(r[1]) < cp.TOXIC]
    exact = ref.exact([r[:2] for r in left])
    left = [r for n, r in enumerate(left) if exact[n][2]]
    left.sort()
    roots = ref.connected([ref.fingerprint(t) for _, t, _ in left], lambda a, b: bin(a ^ b).count("1") <= 4)
    left = [r for n, r in enumerate(left) if roots[n] == n]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    left = [r for r, (n, h, _) in zip(left, ref.contamination([t for _, t, _ in left], items)) if not (h and 20 * h >= n)]
    sizes = {}
    for _, t, s in left:
        sizes[s] = sizes.get(s, 0) + len(ref.words(t))
    want = ref.targets(sizes)
    out = cp.run(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in out} <= {r[0] for r in left}
    taken = {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + r["mix_words"]
    assert {s: taken.get(s, 0) for s in sizes} == {s: int(want[s] + 0.5) for s in sizes}
    assert [r["mix_position"] for r in out] == sorted(r["mix_position"] for r in out)


def test_stages_on_awkward_rows(spark, rng, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, mix_copy int, __key string, kept boolean"
    rows = [(None, None), (1, ""), (2, " "), (3, "one two"), (3, "one two"), (None, "x"), (4, prose(rng, 20_000))] + [
        (10 + i, prose(rng, 20)) for i in range(30)]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, "k", None) for i, t in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(rng, 30)), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    expect = {"toxicity": len(rows), "exact_dedup": len(rows) - 3, "simhash_dedup": None, "decontamination": len(rows)}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name in expect:
            assert out.columns == docs.columns
            assert expect[name] in (None, out.count()), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    mixed = cp.mix(spark, docs, str(tmp_path))
    assert {"mix_position", "mix_copy_", "mix_words"} <= set(mixed.columns) and "__key" in mixed.columns
    assert cp.run(spark, str(tmp_path)).count() > 0
