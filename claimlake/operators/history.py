"""Change history (SCD type 2, check strategy) and as-of reads.

``scd2_apply`` rebuilds the history table from the previous history and one new load
with a full outer join on the business key (one shuffle on the key, which is unique per
row, so no hot group). ``changed_rows`` reduces a load to the rows that change anything, so that a
history kept in partitions is rewritten only where a row changes (``plans/snapshots.py``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import surrogate_key

VALID_FROM, VALID_TO, SCD_ID, UPDATED_AT = "valid_from", "valid_to", "scd_id", "updated_at"


class DuplicateKeyError(ValueError):
    """The load holds more than one row for a business key."""


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key {[dup[0][k] for k in keys]}")


def _open_rows(load: DataFrame, keys: Sequence[str], ts: Column) -> DataFrame:
    cols = load.columns
    return load.select(
        *cols,
        surrogate_key(*keys, ts).alias(SCD_ID),
        ts.alias(UPDATED_AT), ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO))


def scd2_apply(history: DataFrame | None, load: DataFrame, keys: Sequence[str],
               check_cols: Sequence[str], load_ts: Column, check_duplicates: bool = True) -> DataFrame:
    """New history after one load.

    * first load: every row open (``valid_from = load_ts``, ``valid_to`` NULL);
    * key present, a check column changed (NULL-safe compare): close the open row at
      ``load_ts`` and add the new values as an open row;
    * key present, unchanged: untouched; key gone from the load: stays open;
    * new key: added open.
    """
    if check_duplicates:
        assert_unique_keys(load, keys)
    ts = load_ts.cast("timestamp_ntz")
    if history is None:
        return _open_rows(load, keys, ts)
    data_cols = load.columns
    is_open = F.col(VALID_TO).isNull()
    closed = history.where(~is_open)
    open_ = history.where(is_open)
    h = open_.alias("h")
    c = load.select(*[F.col(x).alias(f"_c_{x}") for x in data_cols]).alias("c")
    on = [F.col(f"h.{k}") == F.col(f"c._c_{k}") for k in keys]
    j = h.join(c, on, "full_outer")
    h_present = F.col(f"h.{keys[0]}").isNotNull()
    c_present = F.col(f"c._c_{keys[0]}").isNotNull()
    same = None
    for x in check_cols:
        e = F.col(f"h.{x}").eqNullSafe(F.col(f"c._c_{x}"))
        same = e if same is None else (same & e)
    changed = h_present & c_present & ~same
    # A joined row gives the open row as it was or closed, the new values as an open row, or both.
    hist_cols = history.columns
    kept = F.struct(*[
        F.when(changed, ts).otherwise(F.col(f"h.{VALID_TO}")).alias(x) if x == VALID_TO
        else F.col(f"h.{x}").alias(x) for x in hist_cols])
    new = {x: F.col(f"c._c_{x}") for x in data_cols} | {
        SCD_ID: surrogate_key(*[F.col(f"c._c_{k}") for k in keys], ts), UPDATED_AT: ts, VALID_FROM: ts,
        VALID_TO: F.lit(None).cast("timestamp_ntz")}
    inserted = F.struct(*[new[x].alias(x) for x in hist_cols])
    rows = (F.when(changed, F.array(kept, inserted)).when(h_present, F.array(kept))
            .otherwise(F.array(inserted)))
    return closed.unionByName(j.select(F.inline(rows).alias(*hist_cols)))


def fingerprint(*cols: str) -> Column:
    """128 bits over the values of ``cols``; nulls differ from every value."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]))


def changed_rows(open_rows: DataFrame, load: DataFrame, keys: Sequence[str], check_cols: Sequence[str],
                 fingerprint_col: str | None = None) -> DataFrame:
    """The rows of ``load`` whose key is new or whose check columns differ from the open row's.

    An anti join on (key, fingerprint of the check columns), for which the history gives nothing but
    its keys and ``fingerprint_col`` (computed from its check columns if there is none)."""
    known = open_rows.select(*[F.col(k).alias(f"_h_{k}") for k in keys],
                             (F.col(fingerprint_col) if fingerprint_col else fingerprint(*check_cols)).alias("_h_print"))
    on = fingerprint(*check_cols) == F.col("_h_print")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_h_{k}"))
    return load.join(known, on, "left_anti")


def as_of(history: DataFrame, ts: Column | str) -> DataFrame:
    """Rows valid at ``ts``: ``valid_from <= ts < valid_to`` (open rows have no end)."""
    t = (F.lit(ts) if isinstance(ts, str) else ts).cast("timestamp_ntz")
    return history.where((F.col(VALID_FROM) <= t)
                         & (F.col(VALID_TO).isNull() | (t < F.col(VALID_TO))))
