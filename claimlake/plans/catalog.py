"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` (through the fixture adapter) and
runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType, TimestampType

from ..params import FIXTURE, Params
from .project import MODELS, Project, _ensure_loaded

QueryFn = Callable[[SparkSession, str], DataFrame]


def project(spark: SparkSession, sf_dir: str, params: Params = FIXTURE) -> Project:
    return Project.from_driver_tables(spark, sf_dir, params)


def comparable(df: DataFrame) -> DataFrame:
    """Money leaves as DOUBLE (exact decimals inside, one conversion at the edge);
    timestamps leave as ISO text ('YYYY-MM-DD HH:MM:SS'), independent of time units."""
    def edge(f):
        if isinstance(f.dataType, DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (TimestampNTZType, TimestampType)):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)
    return df.select(*[edge(f) for f in df.schema.fields])


def _model_query(name: str) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(project(spark, sf_dir).model(name))
    run.__name__ = name
    return run


def model_queries() -> dict[str, QueryFn]:
    _ensure_loaded()
    return {name: _model_query(name) for name in MODELS}


def all_queries() -> dict[str, QueryFn]:
    out = model_queries()
    from . import extra_queries
    out.update(extra_queries.QUERIES)
    return out
