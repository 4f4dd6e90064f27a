"""Role views in the catalog: each role has a database that holds what it may read, and nothing else.

``publish_role`` writes one view for each mart that the role may read (N5), from the registered tables of a warehouse
(``metadata.register_tables``) and the policy table: partner rows by an IN-subquery on the assignments (N1), columns without the
denied ones and those made of them (N3), summaries where the role sees aggregates only (N4). SQL of a role names the views;
the planner sees through them, so filters reach the scan. Refusing a role the base tables and files themselves is the work of the
catalog's or the storage's own permissions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import access
from ..params import Params
from .governance import SUMMARY_MARTS
from .project import MODELS, ModelSpec, Project, _ensure_loaded

ASSIGNMENTS = "partner_assignments"
PARTNER = "partner_manufacturer"

# The grain and sums in which an aggregated-only role sees a mart of detail rows.
SUMMARIES = {
    "mart_manufacturer_performance_report": (("drug_year", "therapeutic_area", "brand_generic_flag"),
                                             ("total_claims", "total_spending")),
    "mart_dq_anomalies": (("drug_year", "therapeutic_area", "anomaly_status"), ("total_claims", "total_spending")),
}
# Columns made of others that are no surrogate key of their model: column -> its sources.
DERIVED = {"top_drug_by_spending": ("generic_name",)}


def denied_columns(spec: ModelSpec, role: str, columns: Sequence[str]) -> set[str]:
    """The columns of a model that a role may not see: the denied ones, keys hashed from a denied column
    of the grain, and columns derived from one."""
    denied = set(access.PII_COLUMNS) if role in access.ROLES_WITHOUT_PII else set()
    if role == PARTNER:
        denied |= set(access.COMPETITOR_COLUMNS)
    hidden = {c for c in columns if c in denied}
    if spec.key and denied & set(spec.grain):
        hidden.add(spec.key)
    return hidden | {c for c, sources in DERIVED.items() if c in columns and denied & set(sources)}


def _ident(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def view_sql(spec: ModelSpec, columns: Sequence[str], database: str, role: str, principal: str | None, params: Params) -> str | None:
    """The SELECT of a role's view of a model with these columns; None where the role may not read it at all."""
    if not access.can_read(role, spec.domain, spec.layer):
        return None
    where = ""
    if role == PARTNER:
        if principal is None:
            raise PermissionError("partner views need a principal")
        if "therapeutic_area" not in columns:
            return None
        where = (f" WHERE therapeutic_area IN (SELECT therapeutic_area FROM {_ident(database, ASSIGNMENTS)}"
                 f" WHERE partner_id = {_text(principal)})")
    hidden = denied_columns(spec, role, columns)
    source = f" FROM {_ident(database, spec.name)}{where}"
    if role in access.AGGREGATED_ONLY_ROLES and spec.name not in SUMMARY_MARTS:
        if spec.name not in SUMMARIES:
            return None
        dims, sums = SUMMARIES[spec.name]
        if hidden & {*dims, *sums}:
            raise PermissionError(f"the summary of {spec.name} shows {sorted(hidden & {*dims, *sums})} to {role}")
        people = "sum(total_beneficiaries)" if "total_beneficiaries" in columns else "count(*)"
        return (f"SELECT {', '.join(map(_ident, dims))}, count(*) AS row_count, "
                + ", ".join(f"sum({_ident(c)}) AS {_ident(c)}" for c in sums) + source
                + f" GROUP BY {', '.join(map(_ident, dims))} HAVING {people} >= {int(params.min_beneficiaries)}")
    return "SELECT " + ", ".join(_ident(c) for c in columns if c not in hidden) + source


def register_assignments(spark: SparkSession, assignments: DataFrame, database: str, path: str) -> None:
    """The policy table (``partner_id, therapeutic_area``), written to ``path`` and named in the base database."""
    assignments.select("partner_id", "therapeutic_area").write.mode("overwrite").parquet(path)
    table = _ident(database, ASSIGNMENTS)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} (partner_id STRING, therapeutic_area STRING) USING parquet LOCATION {_text(path)}")


def role_database(database: str, role: str, principal: str | None = None) -> str:
    """The name of a role's database. Names of databases are plain and ignore case, so a principal's is a digest."""
    tail = "" if principal is None else "__" + hashlib.md5(principal.encode()).hexdigest()
    return f"{database}__{role}{tail}"


def publish_role(prj: Project, database: str, role: str, principal: str | None = None) -> dict[str, str]:
    """Make the role's database anew with a view for each registered model that it may read; name -> SELECT.

    Views of models that the role may no longer read are gone afterwards. Only partners have a
    principal, one database each."""
    _ensure_loaded()
    if role not in access.ROLE_DOMAINS:
        raise PermissionError(f"unknown role {role}")
    if (principal is not None) != (role == PARTNER):
        raise PermissionError("partner views need a principal, others have none")
    spark, own = prj.spark, role_database(database, role, principal)
    spark.sql(f"DROP DATABASE IF EXISTS {_ident(own)} CASCADE")
    spark.sql(f"CREATE DATABASE {_ident(own)}")
    tables = {t.name for t in spark.catalog.listTables(_ident(database)) if not t.isTemporary}
    done = {}
    for spec in MODELS.values():
        if spec.name in tables:
            columns = spark.table(_ident(database, spec.name)).columns
            if text := view_sql(spec, columns, database, role, principal, prj.params):
                spark.sql(f"CREATE VIEW {_ident(own, spec.name)} AS {text}")
                done[spec.name] = text
    return done


def role_session(prj: Project, database: str, role: str, principal: str | None = None) -> SparkSession:
    """A session of its own whose current database is the role's, so that bare names are the role's views."""
    session = prj.spark.newSession()
    session.sql(f"USE {_ident(role_database(database, role, principal))}")
    return session
