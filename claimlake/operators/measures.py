"""Semantic layer: measure queries over marts (the KPI catalogue is in ``kpis.py``).

A measure query is ``groupBy(dimensions).agg(measures)`` with optional filters; joined
views are re-aggregated to the join key first, so a left join never fans rows out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import mean, ratio


@dataclass(frozen=True)
class Measure:
    kind: str          # sum | average | ratio | count_distinct | count
    column: str = ""
    digits: int = 2    # rounding of averages and ratios
    per: str = ""      # ratio: sum(column) / (sum(per) * per_scale) * scale
    per_scale: int = 1
    scale: int = 1

    def column_expr(self) -> Column:
        if self.kind == "sum":
            return F.sum(self.column)
        if self.kind == "average":
            return mean(self.column, self.digits)
        if self.kind == "ratio":
            return ratio(F.sum(self.column), F.sum(self.per) * F.lit(self.per_scale), self.digits, self.scale)
        if self.kind == "count_distinct":
            return F.count_distinct(self.column)
        if self.kind == "count":
            return F.count(F.lit(1))
        raise ValueError(self.kind)


# The measures each BI view exposes (view -> measure -> definition).
VIEWS: dict[str, dict[str, Measure]] = {
    "drug_spending": {
        "total_spending": Measure("sum", "total_spending"),
        "total_claims": Measure("sum", "total_claims"),
        "avg_cost_per_claim": Measure("average", "cost_per_claim", 2),
        "avg_monthly_cost": Measure("average", "cost_per_beneficiary_monthly", 2),
        "unique_drugs": Measure("count_distinct", "generic_name"),
    },
    "therapeutic_area_kpis": {
        "total_spending": Measure("sum", "total_spending"),
        "drug_count": Measure("sum", "drug_count"),
        "specialty_spending_pct": Measure("average", "specialty_spending_pct", 1),
    },
    "prescriber_engagement": {
        "prescriber_count": Measure("count_distinct", "npi"),
        "avg_brand_rate": Measure("average", "brand_prescribing_rate_pct", 1),
    },
    "geographic_distribution": {
        "total_drug_cost": Measure("sum", "total_drug_cost"),
        "prescriber_count": Measure("sum", "prescriber_count"),
    },
}


def measure_query(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Measure],
                  filters: Column | None = None) -> DataFrame:
    base = df.where(filters) if filters is not None else df
    return base.groupBy(*dims).agg(*[m.column_expr().alias(n) for n, m in measures.items()])


def explore(left: DataFrame, left_dims: Sequence[str], left_measures: Mapping[str, Measure],
            right: DataFrame, on: Mapping[str, str], right_measures: Mapping[str, Measure],
            prefix: str) -> DataFrame:
    """Left-outer explore: measures of ``left`` by ``left_dims`` joined to ``right``'s
    measures re-aggregated to the join key (``on``: left column -> right column)."""
    lq = measure_query(left, left_dims, left_measures)
    rkeys = list(on.values())
    rq = measure_query(right, rkeys, right_measures)
    rq = rq.select(*[F.col(k).alias(f"_k_{k}") for k in rkeys],
                   *[F.col(n).alias(f"{prefix}{n}") for n in right_measures])
    cond = None
    for lk, rk in on.items():
        e = F.col(lk) == F.col(f"_k_{rk}")
        cond = e if cond is None else (cond & e)
    return lq.join(rq, cond, "left").drop(*[f"_k_{k}" for k in rkeys])
