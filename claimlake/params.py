"""Project variables (thresholds and cut-offs) shared by every model."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Small-group suppression: rows describing fewer people than this are dropped
    # (row form) or blanked (cell form).
    min_beneficiaries: int = 11
    # Specialty drug definition: monthly cost per beneficiary strictly above this.
    specialty_cost_threshold: float = 830.0
    # Analysis years; empty means "every year present in the data".
    analysis_years: tuple[int, ...] = ()
    # Data year of the prescriber extracts (one annual release; 2023 in the original).
    prescriber_release_year: int = 2023
    # Engagement tiers: percentile cut points of prescriber claims.
    tier_high_pct: float = 0.75
    tier_medium_pct: float = 0.25
    # Tier percentiles over all prescribers (False) or within each year (True).
    tiers_by_year: bool = False
    # Exact percentile (default) or percentile_approx with this accuracy.
    approx_percentile_accuracy: int | None = None
    # Exact count(distinct) (default) or HyperLogLog approx_count_distinct with this
    # relative standard deviation: no Expand of the input, fixed-size sketches per group.
    approx_distinct_rsd: float | None = None
    # Anomaly detection: minimum group size for stats, warning and anomaly cuts.
    anomaly_min_group: int = 5
    anomaly_warning_z: float = 2.0
    anomaly_z: float = 3.0
    # Completeness scorecard cuts (percent non-null).
    completeness_pass_pct: float = 99.0
    completeness_warn_pct: float = 95.0
    # Pareto tiers on the cumulative spending share (percent).
    pareto_top_pct: float = 80.0
    pareto_next_pct: float = 95.0
    # Source freshness (days since load).
    freshness_warn_days: int = 90
    freshness_error_days: int = 180
    # Upper bound on the size of any dimension we broadcast.
    max_broadcast_bytes: int = 64 << 20


DEFAULT = Params()

# The driver fixture spans ship years 1995-2001; its prescriber extracts describe the
# latest year, so the prescriber-side models line up with the drug-side years.
FIXTURE = Params(analysis_years=(1995, 1996, 1997, 1998, 1999, 2000, 2001),
                 prescriber_release_year=2001)
