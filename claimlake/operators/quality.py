"""Data checks (not_null / unique / accepted_values / custom), freshness, z-scores.

Column checks of one table run in one aggregation pass; ``unique`` needs its own
group-by (a shuffle on the checked column, which spreads even a hot value's rows over the
map side because counts are partially aggregated first).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_COLUMNS = ("check_name", "model", "column_name", "violations", "severity", "status")


@dataclass(frozen=True)
class Check:
    kind: str                     # not_null | unique | accepted_values
    model: str
    column: str
    severity: str = "error"       # error | warn
    values: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def _status(violations: Column, severity: str) -> Column:
    bad = F.lit("warn") if severity == "warn" else F.lit("fail")
    return F.when(violations == 0, F.lit("pass")).otherwise(bad)


def _row(check_name: str, model: str, column: str | None, violations: Column,
         severity: str) -> list[Column]:
    v = violations.cast("bigint")
    return [F.lit(check_name).alias("check_name"), F.lit(model).alias("model"),
            F.lit(column).cast("string").alias("column_name"), v.alias("violations"),
            F.lit(severity).alias("severity"), _status(v, severity).alias("status")]


def run_column_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Result rows for the checks of one table (one pass + one group-by per unique)."""
    parts: list[DataFrame] = []
    single = [c for c in checks if c.kind in ("not_null", "accepted_values")]
    if single:
        aggs = []
        for i, c in enumerate(single):
            col = F.col(c.column)
            if c.kind == "not_null":
                aggs.append(F.count_if(col.isNull()).alias(f"_v{i}"))
            else:
                aggs.append(F.count_if(col.isNotNull() & ~col.isin(*c.values)).alias(f"_v{i}"))
        one = df.agg(*aggs)
        rows = [F.struct(*_row(c.name, c.model, c.column, F.col(f"_v{i}"), c.severity))
                for i, c in enumerate(single)]
        parts.append(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    for c in (c for c in checks if c.kind == "unique"):
        dup = (df.where(F.col(c.column).isNotNull()).groupBy(c.column).count()
               .where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("_v")))
        parts.append(dup.select(*_row(c.name, c.model, c.column, F.col("_v"), c.severity)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rejection_checks(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Check rows (warnings) of the ingest's counters: one for each input and reason of rejection."""
    rows = [(f"rejected_{name}_{reason.replace(' ', '_')}", name, reason, int(n)) for name, by in counts.items()
            for reason, n in by.items()]
    df = spark.createDataFrame(rows, "check_name string, model string, column_name string, violations bigint")
    return df.withColumn("severity", F.lit("warn")).withColumn("status", _status(F.col("violations"), "warn"))


def custom_check(violating_rows: DataFrame, name: str, model: str, severity: str = "error") -> DataFrame:
    """A custom check is a query returning bad rows; its result row counts them."""
    return violating_rows.agg(F.count(F.lit(1)).alias("_v")).select(
        *_row(name, model, None, F.col("_v"), severity))


def freshness(df: DataFrame, loaded_at: str, warn_days: int = 90, error_days: int = 180,
              now: Column | None = None) -> DataFrame:
    """Source freshness: age of the newest load timestamp -> pass / warn / error.

    A load column that is missing or not a timestamp (all NULL after ``try_cast``) makes
    the check inert: status ``skipped``.
    """
    now = now if now is not None else F.current_timestamp()
    ts = F.col(loaded_at).try_cast("timestamp")
    newest = df.agg(F.max(ts).alias("max_loaded_at"))
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.col("max_loaded_at"))) / F.lit(86400.0)
    return newest.select(
        "max_loaded_at", age.alias("age_days"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("skipped"))
        .when(age > error_days, F.lit("error"))
        .when(age > warn_days, F.lit("warn"))
        .otherwise(F.lit("pass")).alias("status"))


def completeness(df: DataFrame, source: str, columns: dict[str, Column | None],
                 digits: int = 1) -> DataFrame:
    """Percent of rows with a value, per column, from one aggregate pass over ``df``.

    ``columns`` maps output column name -> condition counted as "present" (``None``: the
    column is not null). Rows: ``source_model, total_rows, column_name, completeness_pct``
    (NULL percent for an empty table).
    """
    from ..functions.columns import ratio
    from .reshape import metrics_to_rows
    n = F.count(F.lit(1))
    aggs = [n.alias("total_rows")]
    for name, cond in columns.items():
        present = F.count(F.col(name)) if cond is None else F.count_if(cond)
        aggs.append(ratio(present, n, digits, 100).alias(name))
    one = df.agg(*aggs).withColumn("source_model", F.lit(source))
    return metrics_to_rows(one, ["source_model", "total_rows"], {c: c for c in columns},
                           "column_name", "completeness_pct")


def group_zscores(df: DataFrame, group_cols: Sequence[str], values: dict[str, str],
                  min_group: int = 5, digits: int = 2, where: Column | None = None,
                  bounded: bool = False) -> DataFrame:
    """Rows of groups with >= ``min_group`` rows, with a rounded z-score per value column.

    ``values`` maps value column -> output z column. Group statistics (exact decimal mean,
    sample standard deviation, row count) are one small row per group; where the caller
    knows a bound on the groups (``bounded``) they are broadcast back, so detail rows are not
    shuffled on a (possibly skewed) group key. sd 0 gives z 0.
    """
    from ..functions.columns import round_to
    base = df.where(where) if where is not None else df
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, v in enumerate(values):
        c = F.col(v)
        aggs += [(F.sum(c.cast("decimal(38,4)")).cast("double")
                  / F.count(c).cast("double")).alias(f"_m{i}"),
                 F.stddev_samp(c).alias(f"_s{i}")]
    stats = base.groupBy(*group_cols).agg(*aggs).where(F.col("_n") >= min_group)
    joined = df.join(F.broadcast(stats) if bounded else stats, list(group_cols), "inner")
    zs = [F.when(F.col(f"_s{i}") > 0,
                 round_to((F.col(v) - F.col(f"_m{i}")) / F.col(f"_s{i}"), digits))
          .otherwise(F.lit(0.0)).alias(out) for i, (v, out) in enumerate(values.items())]
    return joined.select(*df.columns, *zs)


def any_abs_above(z_cols: Sequence[str], threshold: float) -> Column:
    """True when any of the z columns is strictly beyond ``threshold`` in absolute value."""
    cond = None
    for z in z_cols:
        e = F.abs(F.col(z)) > F.lit(threshold)
        cond = e if cond is None else (cond | e)
    return cond


def anomaly_status(z_cols: Sequence[str], warning: float = 2.0, anomaly: float = 3.0) -> Column:
    """'Anomaly' if any |z| > anomaly, 'Warning' if any |z| > warning, else 'Normal'."""
    return (F.when(any_abs_above(z_cols, anomaly), F.lit("Anomaly"))
            .when(any_abs_above(z_cols, warning), F.lit("Warning")).otherwise(F.lit("Normal")))


def observe_counts(df: DataFrame, name: str, kept: Column | None = None):
    """Attach row metrics (rows read, rows matching ``kept``) collected as the job runs."""
    from pyspark.sql import Observation
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows_read")]
    if kept is not None:
        metrics.append(F.count_if(kept).alias("rows_kept"))
    return df.observe(obs, *metrics), obs
