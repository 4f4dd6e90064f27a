"""Joins to small dimensions, with their size and key uniqueness checked first.

A dimension is broadcast only after one job over the whole of it has shown that it holds at
most ``max_bytes`` bytes and no duplicate join key (a duplicate would fan the fact rows out).
Beyond the bound the join is left to the planner (shuffle join; AQE may still switch
to a broadcast at run time from the real sizes).
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class FanOutError(ValueError):
    """A lookup dimension holds a duplicate join key."""


def dimension_profile(dim: DataFrame, keys: Sequence[str]) -> tuple[int, int, int]:
    """(rows, duplicated keys, bytes as text) of the whole dimension."""
    size = F.octet_length(F.to_json(F.struct(*dim.columns)))
    row = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("n") > 1).alias("dups"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("bytes")).first()
    return int(row["rows"]), int(row["dups"]), int(row["bytes"])


def checked_broadcast(dim: DataFrame, keys: Sequence[str], max_bytes: int = 64 << 20,
                      name: str = "dimension", unique: bool = True) -> DataFrame:
    """Broadcast hint on ``dim`` if it is provably small; raise on duplicate keys."""
    rows, dups, size = dimension_profile(dim, keys)
    if unique and dups:
        raise FanOutError(f"{name}: {dups} duplicated key(s) on {list(keys)}")
    if size > max_bytes:
        warnings.warn(f"{name}: {rows} rows of {size} bytes, not broadcast", stacklevel=2)
        return dim
    return F.broadcast(dim)
