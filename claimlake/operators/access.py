"""Row- and column-level access filters, masking, hashing and retention.

Row filters are ``left_semi`` joins against an assignment table (the IN-subquery of a
row access policy); the planner broadcasts the assignment side while it is small.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_identifier, mask_text

# Roles and the mart domains each may read.
ALL_DOMAINS = "*"
ROLE_DOMAINS = {
    "analyst_commercial": ("commercial", "executive"),
    "analyst_customer_success": ("customer_success", "executive"),
    "analyst_pharmacy_ops": ("pharmacy_ops", "executive"),
    "partner_manufacturer": ("enterprise",),
    "admin_data": ALL_DOMAINS,
    "viewer_executive": ("executive", "data_quality"),
}
# Personal columns hidden from roles without full column access.
PII_COLUMNS = ("npi", "last_name_or_org", "first_name", "credentials", "prescriber_key")
ROLES_WITHOUT_PII = ("analyst_commercial", "partner_manufacturer", "viewer_executive")
AGGREGATED_ONLY_ROLES = ("partner_manufacturer", "viewer_executive")
# Columns that show a partner its competitors' products.
COMPETITOR_COLUMNS = ("manufacturer_name", "brand_name", "generic_name", "mfr_report_key",
                      "top_drug_by_spending")


def can_read(role: str, domain: str, layer: str = "marts") -> bool:
    """Mart access by role; only the admin role reads non-mart layers."""
    allowed = ROLE_DOMAINS.get(role)
    if allowed is None:
        return False
    if allowed == ALL_DOMAINS:
        return True
    return layer == "marts" and domain in allowed


def require_access(role: str, domain: str, layer: str = "marts") -> None:
    if not can_read(role, domain, layer):
        raise PermissionError(f"role {role} may not read {layer}.{domain}")


def row_filter(df: DataFrame, assignments: DataFrame, principal: str, df_col: str,
               principal_col: str = "partner_id", value_col: str = "therapeutic_area") -> DataFrame:
    """Keep rows whose ``df_col`` is assigned to ``principal`` (IN-subquery as semi join)."""
    allowed = assignments.where(F.col(principal_col) == F.lit(principal)).select(
        F.col(value_col).alias("_allowed"))
    return df.join(allowed, F.col(df_col) == F.col("_allowed"), "left_semi")


def exclude_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    drop = set(columns)
    return df.select(*[c for c in df.columns if c not in drop])


def columns_for_role(df: DataFrame, role: str) -> DataFrame:
    """Column-level filter: drop personal columns for roles without PII access, and a partner's
    competitors' columns."""
    if role == "partner_manufacturer":
        df = exclude_columns(df, COMPETITOR_COLUMNS)
    return exclude_columns(df, PII_COLUMNS) if role in ROLES_WITHOUT_PII else df


def mask_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: mask_text(c) for c in columns})


def hash_columns(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    return df.withColumns({c: hash_identifier(c, salt) for c in columns})


def retention_filter(df: DataFrame, year_col: str, current_year: int, keep_years: int = 5) -> DataFrame:
    """Keep the current year and the ``keep_years`` before it."""
    return df.where(F.col(year_col) >= F.lit(current_year - keep_years))


def aggregated_only(df: DataFrame, dims: Sequence[str], sums: Sequence[str],
                    min_people: int = 11, people: str = "total_beneficiaries") -> DataFrame:
    """Aggregated view (no row-level detail). Small groups are suppressed: those that describe
    fewer than ``min_people`` people, or, where rows carry no such count, of fewer rows."""
    size = F.sum(people) if people in df.columns else F.count(F.lit(1))
    agg = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("row_count"),
                                *[F.sum(c).alias(c) for c in sums], size.alias("_people"))
    return agg.where(F.col("_people") >= F.lit(min_people)).drop("_people")
