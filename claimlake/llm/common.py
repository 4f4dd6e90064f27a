"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space, as a character class: space and tab to carriage return.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; each call has its own, so runs never meet."""
    return f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{tag}"


def stash(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Write a narrow table to the shared folder and read it back: lineage is cut there, and
    a lost executor costs only its running tasks."""
    path = shared_path(df.sparkSession, tag)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or with underscores added until no column of ``taken`` has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def row_key(id_col: str, text_col: str) -> Column:
    """128 bits of SHA-256 over id and text (nulls told from empty): the same for repeated
    rows only, never null, and as evenly spread as the rows themselves."""
    i = F.coalesce(F.col(id_col).cast("string"), F.lit("~"))
    t = F.coalesce(F.concat(F.lit("t"), F.col(text_col)), F.lit("n"))
    return F.substring(F.sha2(F.concat(i, F.lit("\x1f"), t), 256), 1, 32)


def keep_one(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each ``row_key`` of ``keys`` (which has no other columns of use and may repeat keys).

    Repeated rows are reduced to one in each task before they are shuffled, so no key brings more rows to a task
    than there are partitions. The columns of ``docs`` come back unchanged."""
    one = (docs.select(row_key(id_col, text_col).alias("key"), F.struct(*docs.columns).alias("row"))
           .groupBy("key").agg(F.first("row").alias("row")))
    return one.join(keys.select(F.col("row_key").alias("key")), "key", "left_semi").select("row.*")


def drop_rows(docs: DataFrame, keys: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is not in ``keys``; repeated rows stay or go together."""
    k = fresh("__key", docs.columns)
    return (docs.withColumn(k, row_key(id_col, text_col))
            .join(keys.select(F.col("row_key").alias(k)), k, "left_anti").select(*docs.columns))
