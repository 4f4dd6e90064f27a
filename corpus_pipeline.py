"""The corpus pipeline: documents through five stages, each a DataFrame function of
(spark, docs, sf_dir), each result written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from claimlake.llm.common import fresh, keep_one, stash, table
from claimlake.llm.queries import learnable

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below TOXIC; it learns from the labels as ``op6`` does."""
    model = toxicity.train_toxicity(docs, learnable(table(spark, sf_dir, "labels")))
    score = fresh("score", docs.columns)
    return toxicity.score_toxicity(docs, model, score_col=score).filter(F.col(score) < TOXIC).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_one(docs, exact_dedup.exact_dedup(docs).filter("kept").select("row_key"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to be contaminated."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: a row for each copy that the mix takes."""
    return mixing.training_order(docs, mixing.mix_sources(docs))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("simhash_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("mixing", mix)]
#: The classifier and XXH64 fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
