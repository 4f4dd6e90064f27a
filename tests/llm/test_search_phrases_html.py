"""Ranked search, phrase mining and text extraction against plain versions, and on awkward rows."""

import html
import math
import re
import time
from collections import Counter

import pytest

from claimlake.llm import collocations, html_extract, lexical_search
from claimlake.llm.dom import parse
from tests.conftest import SF_SMALL

from . import reference as ref
from .conftest import prose


def _ranked(docs, items, k=10):
    """docs: (id, text), items: (id, text) -> sorted (item, rank, id, score)."""
    def terms(t):
        return re.findall("[0-9A-Za-z\x80-\U0010ffff]+", ref.lower_ascii(t or ""))
    count = [Counter(terms(t)) for _, t in docs]
    size = [sum(c.values()) for c in count]
    n, total = sum(s > 0 for s in size), sum(size)
    df = Counter(w for c in count for w in c)
    out = []
    for item, text in items:
        scored = []
        for (i, _), c, s in zip(docs, count, size):
            m = 25 + 75 * s * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
                        for w in terms(text) if w in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def _found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def corpus(rng):
    words = [prose(rng, 1) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice((3, 3, 10, 40, 200))))) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]                      # copies: ties
    return rows + [(5, rows[5][1]), (5, rows[5][1]), (None, rows[9][1]), (2000, None), (2001, ""), (2002, "... !"), (2003, words[0] * 1 + " " + "A1 é " * 20_000)]


@pytest.mark.parametrize("block, chunk", [(4_000_000, 2_000_000), (150, 2_000_000), (100_000, 300)])
def test_ranked_search_by_brute_force(spark, docs_of, corpus, rng, block, chunk):
    items = [(i, " ".join(rng.choices(corpus[i][1].split(), k=8))) for i in range(0, 40, 4)]
    items += [(3, items[0][1]), (90, None), (91, "no such term"), (92, "A1 a1 É é"), (None, items[1][1])]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.rank_documents(docs_of(corpus), df, chunk_chars=chunk, block_postings=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert _found(got) == _ranked(corpus, items)


def test_ranked_search_of_nothing(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.rank_documents(docs_of([(1, "a")]).limit(0), items).count() == 0
    assert lexical_search.rank_documents(docs_of([(1, "a")]), items.limit(0)).count() == 0
    assert lexical_search.rank_documents(docs_of([(1, "b")]), items).count() == 0


def _phrases(rows, least=10, top=2000):
    f, total = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ref.lower_ascii(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f.update((lang or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = []
    for lang in total:
        cand = {p: a for (la, p), a in f.items() if la == lang and len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, total[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def test_phrases_by_brute_force(spark, rng):
    words = ["the", "of", "Élan", "x", "ab" * 12, "ab" * 12 + "c", "é", "\x1c", "a\xa0b", "."] + [prose(rng, 1) for _ in range(12)]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.choice((1, 4, 60)))))
            for _ in range(400)]
    rows += [("en", "one two\tthree, one two\nthree one")] * 12 + [("en", None), ("en", ""), ("fr", " .,"), ("de", "so so so so " * 3000)]
    df = spark.createDataFrame([(i, t, x, "n", 0, 1) for i, (x, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, word string, n int, ids int").repartition(5)
    got = collocations.mine_phrases(df)
    assert sorted(map(tuple, got.collect())) == _phrases(rows)
    # A filter too small to drop anything changes nothing; ranks are cut after the order.
    assert sorted(map(tuple, collocations.mine_phrases(df, filter_words=1, top=7).collect())) == _phrases(rows, top=7)
    assert collocations.mine_phrases(df.limit(0)).count() == 0


def test_words_that_share_a_number_get_another_seed(spark, monkeypatch):
    real = collocations.word_numbers

    def clash(blob, seed):
        at, size, ids, first, second = real(blob, seed)
        if seed == 0:
            ids[ids != 0] = 5
        return at, size, ids, first, second
    monkeypatch.setattr(collocations, "word_numbers", clash)
    rows = [("en", "aa bb cc"), ("en", "bb aa dd")] * 10
    df = spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string")
    assert sorted(map(tuple, collocations.mine_phrases(df).collect())) == _phrases(rows)


@pytest.mark.parametrize("words", [1, 1 << 14])
def test_the_driver_gets_a_filter_in_pieces(spark, monkeypatch, words):
    """Before: a row for each word of the filter, 4 million at its largest; languages apart, the words by brute force."""
    import numpy as np
    ids = np.random.default_rng(3).integers(-2**63, 2**63 - 1, 100_000)
    langs = ["en" if i % 3 else "und" for i in range(len(ids))]
    frequent = spark.createDataFrame([(x, i) for x, i in zip(langs, ids.tolist())], "lang string, w1 long").repartition(5)
    sent, frame = [], type(frequent)
    for name in ("collect", "toPandas", "toArrow"):
        real = getattr(frame, name)
        monkeypatch.setattr(frame, name, lambda self, real=real: (out := real(self), sent.append(len(out)))[0])
    got = collocations.bloom(frequent, ["w1"], words)
    want = np.zeros(max(1024, words), np.uint64)
    for lang in ("en", "und"):
        h = collocations._mix(collocations._lang_bits(lang), [ids[[x == lang for x in langs]]])
        np.bitwise_or.at(want, (h >> np.uint64(64 - (len(want).bit_length() - 1))).astype(np.int64), collocations._bits(h))
    assert np.array_equal(got, want) and got.any() and sum(sent) <= 1024
    assert not collocations.bloom(frequent.limit(0), ["w1"], words).any()


def _article(page):
    """Blocks of the one <article> of the test tables' pages."""
    body = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    text = [" ".join(html.unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(b for b in text if b)


def test_extraction_on_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_text(pages).collect()}
    want = {r["page_id"]: _article(r["html"]) for r in pages.collect()}
    assert got.keys() == want.keys()
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_extraction_on_held_out_labelled_pages():
    pages = list(html_extract.labelled_pages(200, seed=77))
    wrong = blocks = 0
    for (_, main), got in zip(pages, html_extract.default_model().texts([p for p, _ in pages])):
        a, b = Counter(got.split("\n\n")), Counter(main.split("\n\n"))
        wrong += sum((a - b).values()) + sum((b - a).values())
        blocks += sum(b.values())
    assert wrong <= 0.04 * blocks


def test_messages_equal_sums_over_all_states():
    """Marginals of a small tree by listing every assignment."""
    import itertools

    import numpy as np
    nodes = parse("<body><nav><a href=x>menu</a></nav><div>some <b>text</b>.<p>more</p></div></body>")
    f = html_extract.Forest([nodes], {})
    rng = np.random.RandomState(3)
    own, edges = rng.normal(size=len(nodes)), rng.normal(size=(2, 2, 2))
    p, pairs = f.marginals(own, edges)
    total, one, joint = 0.0, np.zeros(len(nodes)), np.zeros((len(nodes), 2, 2))
    for x in itertools.product((0, 1), repeat=len(nodes)):
        w = math.exp(sum(own[i] * x[i] for i in range(len(nodes))) + sum(
            edges[int(d.tag == "#"), x[d.parent], x[i]] for i, d in enumerate(nodes) if d.parent >= 0))
        total += w
        one += w * np.array(x)
        for i, d in enumerate(nodes):
            if d.parent >= 0:
                joint[i, x[d.parent], x[i]] += w
    assert np.allclose(p, one / total) and np.allclose(pairs[1:], joint[1:] / total)


def test_html_reader():
    nodes = parse("<p>a &amp; b<br>c <i>d</i><p>e<!-- no --><script>f</script>&lt;p&gt;<ul><li>g<li>h<a href='>'>i</a></ul>tail < 3")
    assert [d.text for d in nodes if d.tag == "#"] == ["a & b c d", "e <p>", "g", "hi", "tail < 3"]
    assert [d.linked for d in nodes if d.tag == "#"] == [0, 0, 0, 1, 0]
    for bad in ("<" * 200_000, "<a " * 200_000, "<!--" * 100_000, "<p x='" * 100_000, "<div>" * 50_000, "</p>" * 100_000, "&amp" * 200_000):
        t = time.time()
        parse(bad)
        assert time.time() - t < 20


def test_extraction_of_awkward_pages(spark):
    rows = [(1, None), (2, ""), (3, "   "), (4, "<html>"), (5, "<article><p>" + "Some words here. " * 20_000 + "</article>"), (6, "<p>x"), (6, "<p>x")]
    df = spark.createDataFrame([(i, h, "old", 0) for i, h in rows], "page_id long, html string, text string, n_chars int")
    out = html_extract.extract_text(df)
    assert out.columns == ["page_id", "html", "text", "n_chars", "text_"]
    got = [(r["page_id"], r["text_"]) for r in out.orderBy("page_id").collect()]
    assert [t for i, t in got if i < 5] == ["", "", "", ""]
    assert dict(got)[5] == ("Some words here. " * 20_000).strip() and len({t for i, t in got if i == 6}) == 1
    assert html_extract.extract_text(df.limit(0)).count() == 0
