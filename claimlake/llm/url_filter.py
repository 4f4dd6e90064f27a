"""URL filter: allow/block rules, and for the rest a logistic regression on hashed character
n-grams of host and path (DataFrame functions and the JVM's DataFrame-based ML only).

The model is trained from a small labelled URL table (``labelled_urls`` or the caller's, at
most ``max_labelled`` rows); scoring is one narrow map over the pages, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

#: (verdict, host, path) of the rules in force.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Words of the small labelled table: hosts made of the first are junk, of the second ordinary.
JUNK_WORDS = ("pills", "casino", "spam", "poker", "farm-links", "free-money", "adult", "xxx", "payday", "loans", "replica",
              "handbags", "crack", "warez", "diet", "lottery", "viagra", "betting", "prizes", "cheap", "seo", "win", "bets", "dating")
ORDINARY_WORDS = ("university", "library", "news", "gardener", "project", "weather", "museum", "city", "school", "recipes",
                  "encyclopedia", "cycling", "theatre", "science", "astronomer", "hospital", "railway", "parliament",
                  "football", "music", "orchestra", "garden", "council", "bakery", "teacher", "harbour", "geology", "choir",
                  "theology", "carpenter", "archive", "cinema", "painter", "station", "hiking", "chess", "sailing",
                  "historian", "bread", "river", "mountain", "village", "market", "bridge", "forest", "physics", "kitchen", "radio")


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table (url, 1 for junk): three urls for each word, alone and joined with another of
    its kind. Subdomains, top domains and paths are dealt alike to both kinds, so that they tell nothing."""
    out = []
    for label, words in ((1, JUNK_WORDS), (0, ORDINARY_WORDS)):
        for i, word in enumerate(words):
            for j in range(3):
                name = word if j == 0 else f"{word}-{words[(5 * i + 7 * j) % len(words)]}"
                host = ("", "www.", "blog.", "m.")[(i + j) % 4] + name + (".example.com", ".example.net", ".example.org")[(i + j) % 3]
                path = f"/{('en', 'de', 'fr', 'es')[(i + 2 * j) % 4]}/{37 * (i + 11 * j) % 1000}" + ("", "/", ".html")[(2 * i + j) % 3]
                out.append((f"http://{host}{path}", label))
    return out


FEATURES = 1 << 14
GRAMS = (3, 4)
MAX_LABELLED = 100_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no
    ``://``: empty."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (``rule``, ``verdict``), else null. Of rules of the same
    length, which can only be the same rule twice, block wins. The rules are the caller's list,
    held in the plan."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    listed = F.array(*[F.struct(
        F.lit(len(h + p)).alias("len"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"),
        F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules])
    fits = F.filter(listed, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
                    & F.startswith(path, r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["len"], r["rule"], r["verdict"])))
    return F.when(F.size(fits) > 0, F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def url_grams(host: Column, path: Column, sizes: Sequence[int] = GRAMS) -> Column:
    """Character n-grams of ``^host$`` and of the path, told apart by a first letter."""
    def grams(text: Column, tag: str, n: int) -> Column:
        last = F.length(text) - n + 1
        return F.when(last > 0, F.transform(
            F.sequence(F.lit(1), last), lambda i: F.concat(F.lit(tag), F.substring(text, i, F.lit(n))))
        ).otherwise(F.array().cast("array<string>"))
    h = F.concat(F.lit("^"), host, F.lit("$"))
    return F.concat(*[grams(h, "h", n) for n in sizes], *[grams(path, "p", n) for n in sizes])


def _features(df: DataFrame, features: int) -> DataFrame:
    return HashingTF(numFeatures=features, binary=True, inputCol="_grams", outputCol="_features").transform(
        df.withColumn("_grams", url_grams(F.col("host"), F.col("path"))))


def train_url_model(spark: SparkSession, labelled: DataFrame | None = None, features: int = FEATURES,
                    max_labelled: int = MAX_LABELLED) -> LogisticRegressionModel:
    """Fit on a labelled table (``url``, ``label`` 1 for junk); rows without a label are skipped."""
    if labelled is None:
        labelled = spark.createDataFrame(labelled_urls(), "url string, label int")
    known = labelled.filter("label is not null").select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double"))
    if (n := known.count()) > max_labelled:
        raise ValueError(f"{n} labelled urls; the table is meant to be small (max_labelled={max_labelled})")
    return LogisticRegression(featuresCol="_features", labelCol="label", regParam=0.005, maxIter=60).fit(
        _features(known.coalesce(1), features))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                 model: LogisticRegressionModel | None = None, id_col: str = "page_id", url_col: str = "url",
                 features: int = FEATURES, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict``, ``junk_score``.

    A fitting rule decides, the longest first; otherwise the model: block at ``threshold`` or more.
    A null url, or one without ``://``, has an empty host and path and is judged by the model's
    score of nothing. Repeated rows are judged alike; an empty table gives no rows.
    """
    model = model or train_url_model(pages.sparkSession, features=features)
    own = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    model.setProbabilityCol("_p").setRawPredictionCol("_r").setPredictionCol("_y")
    scored = model.transform(_features(own, features))
    fit = rule_for(F.col("host"), F.col("path"), rules)
    junk = vector_to_array("_p")[1]
    return scored.select(
        id_col, "host", "path", fit["rule"].alias("rule"),
        F.coalesce(fit["verdict"], F.when(junk >= threshold, "block").otherwise("allow")).alias("verdict"),
        junk.alias("junk_score"))
