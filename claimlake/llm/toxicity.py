"""Counterfactually regularised toxicity classifier.

Features are whole lower-cased words and word beginnings, kept when a chi-square test over the
labelled sample ties them to the label. For every labelled text that names an identity
group, copies are made in which its identity terms are swapped for others of the same kind; the
fit penalises the squared change of the logit between a text and its copies, so that naming a
group, by itself, does not move the score. Fitting uses at most ``fit_rows`` labelled rows, the
first by a hash of the id; statistics are gathered on the executors, and what reaches the
driver is bounded by ``fit_rows`` and ``max_features``. Scoring reads every whole text, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of identity terms; a term is swapped for others of its kind only.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("women", "men"), ("woman", "man"), ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "african", "european", "hispanic"),
    ("blind", "deaf", "disabled"), ("old", "young"),
)
FIT_ROWS = 20_000       # labelled rows the fit reads at most
MAX_FEATURES = 3_000
VARIANTS = 3            # swapped copies of a text in the fit
PREFIXES = (4, 5, 6)
_WORD = re.compile(r"\w+")
_CACHE = 200_000


def features_of(word: str) -> list[str]:
    return ["=" + word] + [f"^{word[:n]}" for n in PREFIXES if len(word) >= n]


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if isinstance(text, str) else set()


def swapped(words: set[str], terms: Sequence[Sequence[str]] = IDENTITY_TERMS, variants: int = VARIANTS) -> list[set[str]]:
    """Copies of a text's words with each identity term replaced by the next, second next, ...
    of its kind; none if the text names no group."""
    place = {t: (kind, i) for kind in terms for i, t in enumerate(kind)}
    named = [w for w in words if w in place]
    if not named:
        return []
    longest = max(len(place[w][0]) for w in named)
    return [{place[w][0][(place[w][1] + step) % len(place[w][0])] if w in place else w for w in words}
            for step in range(1, min(variants, longest - 1) + 1)]


@dataclass
class ToxicityModel:
    """``weights`` by feature and ``bias`` of the logit; ``score`` of a text in 0..1."""
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    _seen: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False, compare=False)

    def active(self, words: set[str]) -> set[str]:
        out: set[str] = set()
        for w in words:
            got = self._seen.get(w)
            if got is None:
                if len(self._seen) >= _CACHE:
                    self._seen.clear()
                got = self._seen[w] = tuple(f for f in features_of(w) if f in self.weights)
            out.update(got)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[f] for f in sorted(self.active(_words(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def fit_logistic(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[int, np.ndarray]], size: int,
                 ridge: float = 1e-4, swap_penalty: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias minimising mean log loss + ``ridge`` |w|^2 + ``swap_penalty`` mean squared
    logit change over ``pairs`` (row number, features of the swapped copy), by Adam steps."""
    def sparse(sets):
        n = np.fromiter(map(len, sets), np.int64, len(sets))
        return np.repeat(np.arange(len(sets)), n), np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int64)
    (r, c), n = sparse(rows), len(rows)
    moved = [(np.setdiff1d(rows[i], s), np.setdiff1d(s, rows[i])) for i, s in pairs]
    (r1, c1), (r2, c2) = sparse([x for x, _ in moved]), sparse([x for _, x in moved])
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    w[size] = np.log(share / (1 - share))
    for t in range(1, steps + 1):
        z = np.bincount(r, w[c], n) + w[size]
        err = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels) / n
        g = np.append(np.bincount(c, err[r], size) + 2 * ridge * w[:size], err.sum())
        if pairs:
            change = np.bincount(r1, w[c1], len(pairs)) - np.bincount(r2, w[c2], len(pairs))
            pull = 2 * swap_penalty * change / len(pairs)
            g[:size] += np.bincount(c1, pull[r1], size) - np.bincount(c2, pull[r2], size)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w[:size], float(w[size])


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", fit_rows: int = FIT_ROWS, max_features: int = MAX_FEATURES,
                   min_docs: int = 4, chi_square: float = 15.0, swap_penalty: float = 1.0,
                   terms: Sequence[Sequence[str]] = IDENTITY_TERMS) -> ToxicityModel:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1 (null labels and ids are skipped;
    of several labels the largest counts, of several rows with one id one). With labels of one kind only, the score is constant."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
             .orderBy(F.xxhash64("id"), "id").limit(fit_rows))
    # At most fit_rows narrow rows, by the limit above; of rows that share an id one is taken, whichever task reads it.
    text = F.col("text")
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(known), "id").groupBy("id", "y")
              .agg(F.min(F.struct(text.isNull().alias("none"), F.xxhash64(text).alias("hash"), text)).alias("row"))
              .select("row.text", "y"))

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, by = [0, 0], [Counter(), Counter()]
        for p in parts:
            for text, y in zip(p["text"], p["y"]):
                n[y > 0] += 1
                by[y > 0].update({f for w in _words(text) for f in features_of(w)})
        for y in (0, 1):
            yield pd.DataFrame({"feature": ["", *by[y]], "y": y, "docs": [n[y], *by[y].values()]})
    counts = (sample.mapInPandas(count, "feature string, y int, docs long").groupBy("feature")
              .agg(F.sum(F.when(F.col("y") == 0, F.col("docs")).otherwise(0)).alias("n0"),
                   F.sum(F.when(F.col("y") == 1, F.col("docs")).otherwise(0)).alias("n1")))
    named = [f for kind in terms for t in kind for f in features_of(t)]
    counts = counts.filter((F.col("feature") == "") | (F.col("n0") + F.col("n1") >= min_docs)).persist()
    all_rows = counts.filter("feature = ''").first()
    n0, n1 = (all_rows["n0"], all_rows["n1"]) if all_rows else (0, 0)
    if not n0 or not n1:
        counts.unpersist()
        return ToxicityModel(bias=-60.0 if not n1 else 60.0)
    a, b = F.col("n1"), F.col("n0")
    cross = (a * (n0 - b) - b * (n1 - a)).cast("double")
    both = ((a + b) * (n0 + n1 - a - b)).cast("double")
    test = F.when(both > 0, cross * cross * (n0 + n1) / (both * float(n0) * float(n1))).otherwise(0.0)
    tied = (counts.filter("feature <> ''").withColumn("test", test).filter(F.col("test") >= chi_square)
            .orderBy(F.desc("test"), "feature").limit(max_features))
    names = sorted({r["feature"] for r in tied.select("feature").collect()} | set(named))
    counts.unpersist()
    place = {f: i for i, f in enumerate(names)}

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def ids(words):
            return sorted({place[f] for w in words for f in features_of(w) if f in place})
        for p in parts:
            words = [_words(t) for t in p["text"]]
            yield pd.DataFrame({"y": p["y"], "own": [ids(w) for w in words],
                                "swaps": [[ids(s) for s in swapped(w, terms)] for w in words]})
    fit = sample.mapInPandas(encode, "y int, own array<int>, swaps array<array<int>>").collect()
    fit.sort(key=lambda r: (r["own"], r["y"]))          # the order of tasks does not matter
    rows = [np.asarray(r["own"], np.int64) for r in fit]
    pairs = [(i, np.asarray(s, np.int64)) for i, r in enumerate(fit) for s in r["swaps"]]
    w, bias = fit_logistic(rows, np.array([float(r["y"] > 0) for r in fit]), pairs, len(names), swap_penalty=swap_penalty)
    return ToxicityModel(bias, {f: float(x) for f, x in zip(names, w) if x})


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus ``score_col``; null and empty texts get the score of no words.
    Repeated rows score alike; an empty table gives no rows."""
    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield pd.Series([model.score(t) for t in p], dtype="float64")
    return docs.withColumn(score_col, score(F.col(text_col).cast("string")))
