"""What a role sees of a model: mart access (N5), partner row filter (N1), column filter
(N3) and aggregated-only views (N4), combined in one call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import access
from .project import MODELS, Project, _ensure_loaded

# Marts whose rows are summaries already (no drug, manufacturer or prescriber in their grain).
SUMMARY_MARTS = ("mart_therapeutic_area_kpis", "mart_executive_summary", "mart_kpi_scorecard",
                 "mart_dq_completeness")


def governed_view(prj: Project, role: str, model: str, principal: str | None = None,
                  assignments: DataFrame | None = None,
                  aggregate_by: Sequence[str] = (), sums: Sequence[str] = ()) -> DataFrame:
    """``model`` as ``role`` may read it.

    * the role must be allowed the model's domain (and layer);
    * partners see only rows of their assigned therapeutic areas (``assignments``:
      ``partner_id, therapeutic_area``), identified by ``principal``;
    * personal columns, and for partners competitors' columns, are dropped;
    * aggregated-only roles get ``aggregate_by`` groups with ``sums`` (small groups suppressed)
      instead of rows; without ``aggregate_by`` they may read summary marts only.
    """
    _ensure_loaded()
    spec = MODELS[model]
    access.require_access(role, spec.domain, spec.layer)
    df = prj.model(model)
    if role == "partner_manufacturer":
        if principal is None or assignments is None:
            raise PermissionError("partner views need a principal and its assignments")
        df = access.row_filter(df, assignments, principal, "therapeutic_area")
    df = access.columns_for_role(df, role)
    if role in access.AGGREGATED_ONLY_ROLES:
        if aggregate_by:
            return access.aggregated_only(df, aggregate_by, sums, prj.params.min_beneficiaries)
        if model not in SUMMARY_MARTS:
            raise PermissionError(f"role {role} may read {model} aggregated only")
    return df
