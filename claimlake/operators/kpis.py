"""The governed KPI catalogue: formulas, exclusions and grains as SQL text, evaluated from that text.

A formula is a Spark SQL expression over the columns of the KPI's model. Its aggregate calls (the innermost ``sum(...)``,
``count(...)``, ``min(...)``, ``max(...)``) are computed exactly by the grain, over the rows that the exclusion keeps; what
is left of the text is evaluated on their results. A formula without such calls is a value of each row. Divisions are taken in
double, values are rounded through a decimal. ``{name}`` in a text is a project parameter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round_to
from ..params import DEFAULT, Params
from .aggregates import percentile_cuts


@dataclass(frozen=True)
class KPI:
    name: str
    formula: str
    grain: tuple[str, ...]
    model: str                            # "" : any model that has the formula's columns
    keep: str = ""                        # the rows that count: what is left after the exclusions
    exclusions: str = ""                  # the same in words
    digits: int | None = None             # rounding; None: as it comes (flags, labels, whole sums)
    owner: str = "Data & Analytics"
    cuts: tuple[tuple[str, str, float], ...] = ()      # names in the formula -> percentile of a column over the kept rows
    columns: tuple[tuple[str, tuple[str, ...]], ...] = ()   # (model, columns) that ``{column}`` runs over

    @property
    def per_row(self) -> bool:
        return not self.columns and not _AGGREGATE.search(self.formula)


_AGGREGATE = re.compile(r"\b(?:sum|count|min|max)\([^()]*\)", re.IGNORECASE)
SUPPRESSED, KEPT_CELLS = "fewer than {min_beneficiaries} beneficiaries", "total_beneficiaries >= {min_beneficiaries}"
OPERATIONS, SUCCESS = "Pharmacy Operations", "Customer Success"

# The governed catalogue.
KPI_CATALOG = (
    KPI("cost_per_claim", "sum(total_spending) / nullif(sum(total_claims), 0)", ("drug_year", "generic_name"),
        "mart_cost_per_claim", KEPT_CELLS, SUPPRESSED, 2),
    KPI("cost_per_beneficiary_per_month", "sum(total_spending) / nullif(12 * sum(total_beneficiaries), 0)",
        ("drug_year", "generic_name"), "mart_cost_per_claim", KEPT_CELLS, SUPPRESSED, 2),
    KPI("cost_per_day_of_therapy", "sum(total_drug_cost) / nullif(sum(total_day_supply), 0)",
        ("drug_year", "generic_name", "state"), "mart_day_supply_efficiency", "total_day_supply > 0",
        "records with zero day supply", 2, OPERATIONS),
    KPI("total_claims", "sum(total_claims)", ("drug_year", "state"), ""),
    KPI("fills_per_beneficiary", "sum(total_30day_fills) / nullif(sum(total_beneficiaries), 0)",
        ("drug_year", "therapeutic_area"), "mart_fill_volume_trends", KEPT_CELLS, SUPPRESSED, 2, OPERATIONS),
    KPI("specialty_drug_flag", "cost_per_beneficiary_monthly > {specialty_cost_threshold}",
        ("drug_year", "generic_name", "brand_name", "manufacturer_name"), "mart_cost_per_claim"),
    KPI("generic_dispensing_rate", "sum(generic_claims) / nullif(sum(brand_claims) + sum(generic_claims), 0) * 100",
        ("drug_year", "therapeutic_area", "state"), "mart_brand_generic_ratio", "total_claims > 0",
        "zero total claims", 1, OPERATIONS),
    KPI("brand_prescribing_rate", "brand_claims / nullif(brand_claims + generic_claims, 0) * 100",
        ("npi", "prescriber_year"), "mart_prescriber_engagement", digits=1, owner=SUCCESS),
    KPI("area_spending_share", "sum(total_spending) / nullif(sum(sum(total_spending)) OVER (PARTITION BY drug_year), 0) * 100",
        ("drug_year", "therapeutic_area"), "mart_therapeutic_area_mix", digits=1, owner="Commercial"),
    KPI("market_share", "total_spending / nullif(ta_total_spending, 0) * 100",
        ("drug_year", "therapeutic_area", "generic_name", "brand_name", "manufacturer_name"),
        "mart_manufacturer_performance_report", KEPT_CELLS, SUPPRESSED, 2, "Enterprise Customers"),
    KPI("prescriber_engagement_tier",
        "CASE WHEN total_claims >= p_high THEN 'High' WHEN total_claims >= p_medium THEN 'Medium' ELSE 'Low' END",
        ("npi", "prescriber_year"), "mart_prescriber_engagement", "total_claims > 0", "prescribers with zero claims",
        owner=SUCCESS, cuts=(("p_high", "total_claims", 0.75), ("p_medium", "total_claims", 0.25))),
    KPI("specialty_adoption_rate", "sum(prescribers_with_specialty_rx) / nullif(sum(prescriber_count), 0) * 100",
        ("drug_year", "prescriber_specialty", "therapeutic_area"), "mart_specialty_adoption_funnel", digits=1, owner=SUCCESS),
    KPI("data_completeness", "count({column}) / nullif(count(*), 0) * 100", ("source_model", "column_name"),
        "mart_dq_completeness", digits=2, columns=(
            ("stg_drug_spending", ("generic_name", "total_spending", "total_claims", "total_beneficiaries")),
            ("stg_prescribers", ("npi", "specialty", "state", "total_claims", "total_drug_cost")))),
    KPI("spending_anomaly",
        "CASE WHEN greatest(abs(cost_per_claim_zscore), abs(monthly_cost_zscore)) > {anomaly_z} THEN 'Anomaly' "
        "WHEN greatest(abs(cost_per_claim_zscore), abs(monthly_cost_zscore)) > {anomaly_warning_z} THEN 'Warning' ELSE 'Normal' END",
        ("drug_year", "generic_name", "brand_name"), "mart_dq_anomalies"),
)
KPIS = {k.name: k for k in KPI_CATALOG}


def _value(text: str, digits: int | None) -> Column:
    value = F.expr(text.replace("/", "* 1D /"))
    return value if digits is None else round_to(value, digits)


def _filled(text: str, params: Params, **more: str) -> str:
    return text.format_map({**vars(params), **more})


def _lifted(formula: str, keep: str, lifted: dict[str, str]) -> str:
    """``formula`` with its aggregate calls replaced by names, which ``lifted`` gets with their text."""
    def name(call: re.Match) -> str:
        text = call.group(0) + (f" FILTER (WHERE {keep})" if keep else "")
        return lifted.setdefault(text, f"_a{len(lifted)}")
    return _AGGREGATE.sub(name, formula)


def kpi_query(df: DataFrame, dims: Sequence[str], names: Sequence[str], params: Params = DEFAULT) -> DataFrame:
    """Catalogue KPIs of ``df`` by ``dims``, each over the rows that its exclusion keeps.

    A group of which no row is kept by any of them is left out. KPIs of single rows can't be grouped
    (``kpi_rows`` gives them); a KPI that needs columns ``df`` does not have raises ``ValueError``."""
    rowwise = [n for n in names if KPIS[n].per_row or KPIS[n].columns]
    if rowwise:
        raise ValueError(f"{rowwise} are not defined over groups")
    lifted: dict[str, str] = {}
    keeps = [_filled(KPIS[n].keep, params) for n in names]
    try:
        texts = {n: _lifted(_filled(KPIS[n].formula, params), k, lifted) for n, k in zip(names, keeps)}
        rows = df.where(" OR ".join(f"({k})" for k in keeps)) if all(keeps) else df
        sums = rows.groupBy(*dims).agg(*[F.expr(call).alias(a) for call, a in lifted.items()])
        return sums.select(*dims, *[_value(t, KPIS[n].digits).alias(n) for n, t in texts.items()])
    except AnalysisException as e:
        raise ValueError(f"{list(names)} can't be evaluated on columns {df.columns}: {e.getCondition()}") from e


def kpi_rows(df: DataFrame, name: str, params: Params = DEFAULT) -> DataFrame:
    """A KPI of single rows: its grain and value for the rows that its exclusion keeps."""
    kpi = KPIS[name]
    if not kpi.per_row:
        raise ValueError(f"{name} is defined over groups")
    try:
        rows = df.where(_filled(kpi.keep, params)) if kpi.keep else df
        if kpi.cuts:
            # One row of cut points, referenced once through an array, so its subquery runs once.
            value, = {column for _, column, _ in kpi.cuts}
            cuts = percentile_cuts(rows, value, [p for _, _, p in kpi.cuts])
            rows = rows.withColumn("_cuts", cuts.select(F.array(*[f"_p{i}" for i in range(len(kpi.cuts))])).scalar())
            rows = rows.select("*", *[F.get("_cuts", F.lit(i)).alias(n) for i, (n, _, _) in enumerate(kpi.cuts)])
        return rows.select(*kpi.grain, _value(_filled(kpi.formula, params), kpi.digits).alias(name))
    except AnalysisException as e:
        raise ValueError(f"{name} can't be evaluated on columns {df.columns}: {e.getCondition()}") from e


def kpi_of_columns(df: DataFrame, name: str, model: str, columns: Sequence[str], params: Params = DEFAULT) -> DataFrame:
    """A KPI that runs over the columns of a model, in one aggregate: a row for each column."""
    kpi = KPIS[name]
    lifted: dict[str, str] = {}
    texts = {c: _lifted(_filled(kpi.formula, params, column=c), kpi.keep, lifted) for c in columns}
    one = df.agg(*[F.expr(call).alias(a) for call, a in lifted.items()]).select(
        *[_value(t, kpi.digits).alias(c) for c, t in texts.items()])
    return (one.unpivot([], list(columns), "column_name", name)
            .select(F.lit(model).alias("source_model"), "column_name", name))


def evaluate(prj, name: str, dims: Sequence[str] = (), model: str = "") -> DataFrame:
    """A KPI from its catalogue entry: on its own model, at its grain (or by ``dims`` of a grouped one).

    ``model`` names the model where the catalogue leaves it open; naming any other than the KPI's own raises."""
    kpi = KPIS[name]
    if model and kpi.model and model != kpi.model:
        raise ValueError(f"{name} is governed on {kpi.model}, not on {model}")
    if kpi.columns:
        parts = [kpi_of_columns(prj.model(m), name, m, cs, prj.params) for m, cs in kpi.columns]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    source = model or kpi.model
    if not source:
        raise ValueError(f"{name} needs the name of a model")
    if kpi.per_row:
        return kpi_rows(prj.model(source), name, prj.params)
    return kpi_query(prj.model(source), dims or kpi.grain, [name], prj.params)
