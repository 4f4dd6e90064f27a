"""Raw file ingest: CSV scan by header name, name clean-up, tolerant column lookup,
value-list and reference-map filters.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import strip_upper

# Prescriber specialties kept at ingest in the original extract.
TARGET_SPECIALTIES = (
    "Gastroenterology",
    "Internal Medicine",
    "Family Practice",
    "Endocrinology, Diabetes & Metabolism",
    "Hematology/Oncology",
    "Rheumatology",
    "Allergy/Immunology",
    "Nurse Practitioner",
    "Physician Assistant",
    "General Practice",
    "Dermatology",
)
# Candidate column names, tried in order (the extract naming varies by year).
SPECIALTY_CANDIDATES = ("prscrbr_type", "provider_type", "specialty_description")
GENERIC_CANDIDATES = ("gnrc_name", "generic_name", "gnrc_drug_name")


class MissingColumnError(ValueError):
    """A delivered file lacks a column of its extract."""


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             infer: bool = False, check_header: bool = False, corrupt_col: str | None = None) -> DataFrame:
    """CSV with header, double-quote quoting, malformed fields as NULL (PERMISSIVE).

    An explicit schema binds by position (``check_header``: names must equal the header);
    ``read_by_header`` binds by name. ``infer`` costs an extra pass.
    """
    r = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
         .option("mode", "PERMISSIVE").option("enforceSchema", not check_header))
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("/", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and replace spaces and '/' with '_' in every column name."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    cols = set(df.columns)
    for c in candidates:
        if c in cols:
            return c
    return None


#: Name of the reason "the row has another number of fields than the header, or is not CSV".
MALFORMED = "malformed row"


def read_by_header(spark: SparkSession, path: str, schema: StructType,
                   candidates: Mapping[str, Sequence[str]] | None = None,
                   casts: Mapping[str, str] | None = None, reasons_col: str | None = None) -> DataFrame:
    """A CSV file (or a folder of files with one header) as ``schema``, bound by header name.

    Header names are cleaned (``clean_name``); each column is the first present of its
    ``candidates`` (its own name unless given), so order and further columns do not matter. A column
    that is missing raises, and so does a file of the folder whose header differs from the first.

    With ``reasons_col`` each row also gets an array of what was rejected in it: the columns of ``casts`` whose text
    is not blank and does not cast to their type, or else ``MALFORMED``. Rejected rows are kept (their values are
    null once cast); ``rejection_counts`` counts them in the pass that reads the file.
    """
    header = read_csv(spark, path).columns
    text = StructType([StructField(c, StringType()) for c in header])
    corrupt = f"_corrupt_{len(header)}"
    if reasons_col:
        text = text.add(corrupt, StringType())
    rows = normalise_columns(read_csv(spark, path, text, check_header=True, corrupt_col=corrupt if reasons_col else None))
    found = {f.name: first_present(rows, (candidates or {}).get(f.name, (f.name,))) for f in schema.fields}
    missing = [name for name, c in found.items() if c is None]
    if missing:
        raise MissingColumnError(f"{path}: no column for {missing}; header has {rows.columns}")
    out = [F.col(found[f.name]).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    if reasons_col:
        failed = [F.when(F.col(corrupt).isNull() & (F.trim(found[c]) != "") & F.col(found[c]).try_cast(t).isNull(), F.lit(c)) for c, t in (casts or {}).items()]
        malformed = F.when(F.col(corrupt).isNotNull(), F.lit(MALFORMED))
        out.append(F.array_compact(F.array(malformed, *failed)).alias(reasons_col))
    return rows.select(*out)


def rejection_counts(casts: Mapping[str, str], reasons_col: str) -> list[Column]:
    """Aggregates for an observation: the rows, and how many were rejected for each reason."""
    reasons = [MALFORMED, *casts]
    return [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.array_contains(reasons_col, r)).alias(r) for r in reasons]


def filter_values(df: DataFrame, candidates: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keep rows whose (first present) column is in ``values``; no such column: keep all."""
    col = first_present(df, candidates)
    if col is None:
        warnings.warn(f"none of {list(candidates)} present; keeping all rows", stacklevel=2)
        return df
    return df.where(F.col(col).isin(*values))


def filter_to_reference(df: DataFrame, candidates: Sequence[str], reference: DataFrame,
                        reference_col: str, max_bytes: int = 64 << 20) -> DataFrame:
    """Keep rows whose name is in a reference map, comparing strip+upper on both sides.

    A ``left_semi`` join against the distinct reference names, broadcast once their size
    is shown to be within ``max_bytes``.
    """
    from ..operators.joins import checked_broadcast
    col = first_present(df, candidates)
    if col is None:
        warnings.warn(f"none of {list(candidates)} present; keeping all rows", stacklevel=2)
        return df
    names = reference.select(strip_upper(reference_col).alias("_ref")).distinct()
    names = checked_broadcast(names, ["_ref"], max_bytes, "reference names")
    return df.join(names, strip_upper(col) == F.col("_ref"), "left_semi")
