"""Driver test tables (parquet, one file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

#: A join's sort and the hash aggregate above it hold about 800 bytes a line.
LINES_PER_TASK, LEAST_TASKS = 200_000, 8


class DriverTables:
    """Lazy parquet readers; Catalyst prunes columns and pushes filters into each scan."""

    def __init__(self, spark: SparkSession, root: str, ordered_until: str | None = None):
        self.spark = spark
        self.root = root
        self.ordered_until = ordered_until
        self._tasks: int | None = None

    def path(self, name: str) -> str:
        p = os.path.join(self.root, f"{name}.parquet")
        return p

    def table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        if name == "orders" and self.ordered_until:
            df = df.where(F.col("o_orderdate") <= F.lit(self.ordered_until).cast("date"))
        return df

    def line_tasks(self) -> int:
        """Tasks that a shuffle of the order lines is dealt to, so that each gets about ``LINES_PER_TASK`` lines
        whatever the size of the table (one count, from the file footers)."""
        if self._tasks is None:
            self._tasks = max(LEAST_TASKS, -(-self.lineitem.count() // LINES_PER_TASK))
        return self._tasks

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.table(name)
        raise AttributeError(name)
