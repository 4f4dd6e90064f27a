"""Reshaping: wide -> long by column suffix, and one aggregate row -> metric rows.

Both are a single ``stack`` generator over one scan: no union of repeated scans.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suffixes(df: DataFrame, stubs: Sequence[str]) -> list[str]:
    """Suffixes ``S`` such that some ``{stub}_{S}`` column exists, in numeric/text order."""
    found: set[str] = set()
    for c in df.columns:
        for s in stubs:
            m = re.fullmatch(re.escape(s) + r"_(\w+)", c)
            if m:
                found.add(m.group(1))
    return sorted(found, key=lambda x: (not x.isdigit(), int(x) if x.isdigit() else 0, x))


def wide_to_long(df: DataFrame, id_cols: Sequence[str], stubs: Sequence[str], key: str,
                 keys: Sequence[str] | None = None, key_type: str = "int") -> DataFrame:
    """Unpivot ``{stub}_{key}`` columns into one row per key value.

    Output: ``id_cols``, ``key`` (cast to ``key_type``), then one column per stub. A stub
    missing for some key gives NULL in that row.
    """
    keys = list(keys) if keys is not None else suffixes(df, stubs)
    if not keys:
        raise ValueError(f"no columns found for stubs {list(stubs)}")
    present = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    stub_type = {}
    for s in stubs:
        for k in keys:
            if f"{s}_{k}" in present:
                stub_type[s] = types[f"{s}_{k}"]
                break
    args: list[Column] = [F.lit(len(keys))]
    for k in keys:
        args.append(F.lit(k).cast(key_type))
        for s in stubs:
            name = f"{s}_{k}"
            if name in present:
                args.append(F.col(name))
            else:
                args.append(F.lit(None).cast(stub_type.get(s, "string")))
    return df.select(*[F.col(c) for c in id_cols], F.stack(*args).alias(key, *stubs))


def metrics_to_rows(df: DataFrame, id_cols: Sequence[str], metrics: Mapping[str, Column | str],
                    name_col: str = "metric", value_col: str = "value",
                    value_type: str = "double") -> DataFrame:
    """Turn named metric columns of each row into ``(name, value)`` rows."""
    args: list[Column] = [F.lit(len(metrics))]
    for label, c in metrics.items():
        args.append(F.lit(label))
        args.append((F.col(c) if isinstance(c, str) else c).cast(value_type))
    return df.select(*[F.col(c) for c in id_cols], F.stack(*args).alias(name_col, value_col))
