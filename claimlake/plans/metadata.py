"""What is known of each model (description, domain, owner, grain, KPIs, exclusions), written to the catalog.

``register_tables`` makes the written tables of a warehouse known to the session's catalog under a database, with a table
comment, properties and column comments, so that ``DESCRIBE EXTENDED`` shows them."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.kpis import KPI_CATALOG
from ..params import DEFAULT
from ..sources.sinks import AUDIT_COLUMN, with_audit
from .build import LAYOUT
from .project import MODELS, ModelSpec, Project, _ensure_loaded

DEFAULT_OWNER = "Data & Analytics"

# What a column that many models share holds.
COLUMN_COMMENTS = {
    "drug_year": "Year of the drug spending", "prescriber_year": "Release year of the prescriber extract",
    "therapeutic_area": "Therapeutic area of the drug; Other where the map has none",
    "is_focus_area": "The area is a focus area", "is_specialty_drug": "Mapped flag, else monthly cost per beneficiary above the threshold",
    "brand_generic_flag": "Brand or Generic", "generic_name": "Generic name of the drug", "brand_name": "Brand name; blank for generics",
    "manufacturer_name": "Manufacturer of the drug", "state": "State of the prescriber", "census_region": "Census region of the state",
    "npi": "Identifier of the prescriber", "total_spending": "Gross drug spending", "total_claims": "Prescription claims",
    "total_beneficiaries": "Beneficiaries with a claim", "total_drug_cost": "Gross drug cost of the claims",
    "total_30day_fills": "Fills in units of 30 days", "total_day_supply": "Days of therapy supplied",
    AUDIT_COLUMN: "Time the row was written",
}


def owner(spec: ModelSpec) -> str:
    return spec.owner or DEFAULT_OWNER


def kpis(spec: ModelSpec) -> list:
    """The catalogue's KPIs whose model this is."""
    return [k for k in KPI_CATALOG if k.model == spec.name]


def exclusions(spec: ModelSpec) -> list[str]:
    return list(dict.fromkeys(k.exclusions.format_map(vars(DEFAULT)) for k in kpis(spec) if k.exclusions))


def properties(spec: ModelSpec) -> dict[str, str]:
    """Table properties of a model; those without a value are left out."""
    out = {"layer": spec.layer, "domain": spec.domain, "model_owner": owner(spec), "grain": ", ".join(spec.grain),
           "kpis": ", ".join(k.name for k in kpis(spec)), "exclusions": "; ".join(exclusions(spec))}
    return {k: v for k, v in out.items() if v}


def column_comment(spec: ModelSpec, name: str) -> str:
    if name == spec.key:
        return f"Surrogate key of {', '.join(spec.grain)}"
    formulas = {k.name: k.formula for k in kpis(spec)}
    return COLUMN_COMMENTS.get(name) or (f"KPI: {formulas[name]}" if name in formulas else "")


def catalogue_frame(prj: Project):
    """One row per model: what ``register_tables`` writes."""
    _ensure_loaded()
    rows = [(s.name, s.layer, s.domain, owner(s), " ".join(s.description.split()), ", ".join(s.grain),
             ", ".join(k.name for k in kpis(s)), "; ".join(exclusions(s))) for s in MODELS.values()]
    return prj.spark.createDataFrame(rows, "model string, layer string, domain string, owner string, description string, "
                                           "grain string, kpis string, exclusions string")


def _text(value: str) -> str:
    return "'" + " ".join(value.split()).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(spec: ModelSpec, schema: StructType) -> str:
    def line(f):
        comment = column_comment(spec, f.name)
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_text(comment)}" if comment else "")
    return ", ".join(map(line, schema.fields))


def register_tables(prj: Project, warehouse: str, database: str) -> list[str]:
    """Create a catalog table for every written intermediate and mart table of ``warehouse``; return their names.

    A table of that name in ``database`` is replaced in the catalog only: its files stay. Tables that were not written
    are left out."""
    _ensure_loaded()
    spark = prj.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_text(os.path.join(warehouse, '_catalog'))}")
    done = []
    for spec in MODELS.values():
        if spec.layer == "staging":
            continue
        path, lazy = os.path.join(warehouse, spec.layer, spec.name), prj.model(spec.name)
        schema = with_audit(lazy).schema if spec.layer == "marts" and AUDIT_COLUMN not in lazy.columns else lazy.schema
        try:
            spark.read.schema(schema).parquet(path)
        except AnalysisException:
            continue
        parts = LAYOUT.get(spec.name, ((), ()))[0]
        table = f"`{database}`.`{spec.name}`"
        props = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties(spec).items())
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({_columns(spec, schema)}) USING parquet"
                  + (f" PARTITIONED BY ({', '.join(f'`{c}`' for c in parts)})" if parts else "")
                  + f" LOCATION {_text(path)} COMMENT {_text(spec.description or spec.name)} TBLPROPERTIES ({props})")
        if parts:
            spark.catalog.recoverPartitions(f"{database}.{spec.name}")
        done.append(spec.name)
    return done


def described(spark, database: str, model: str) -> dict[str, str]:
    """``DESCRIBE EXTENDED`` of a registered table as name -> comment (columns) or value (details)."""
    rows = spark.sql(f"DESCRIBE EXTENDED `{database}`.`{model}`").where(F.col("col_name") != "").collect()
    return {r["col_name"]: (r["comment"] or r["data_type"]) for r in reversed(rows)}
