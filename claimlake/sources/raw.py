"""The five model inputs (three raw extracts, two reference maps) and where they come from."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .tables import DriverTables

RAW_TABLES = ("raw_part_d_spending", "raw_prescribers", "raw_prescribers_drug")
SEED_TABLES = ("seed_therapeutic_area_map", "seed_state_region_map")
INPUTS = RAW_TABLES + SEED_TABLES
REASONS = "_rejected_for"


class RawSources:
    """Named registry of input DataFrames (built lazily, once per name)."""

    def __init__(self, spark: SparkSession, builders: dict[str, Callable[[], DataFrame]],
                 origin: str = ""):
        self.spark = spark
        self._builders = builders
        self._frames: dict[str, DataFrame] = {}
        self.origin = origin
        #: Rejected rows of an input, where it is read from files.
        self.rejected: Callable[[str], DataFrame] | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name]()
        return self._frames[name]

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, ordered_until: str | None = None) -> "RawSources":
        """Inputs derived from the driver's TPC-H style tables (see ``fixtures``); with
        ``ordered_until``, as a delivery of that day held them: orders up to that date."""
        t = DriverTables(spark, sf_dir, ordered_until)
        return cls(spark, {
            "raw_part_d_spending": lambda: fixtures.drug_spending_wide(t),
            "raw_prescribers": lambda: fixtures.prescribers(t),
            "raw_prescribers_drug": lambda: fixtures.prescriber_drugs(t),
            "seed_therapeutic_area_map": lambda: fixtures.therapeutic_area_map(t),
            "seed_state_region_map": lambda: fixtures.state_region_map(t),
        }, origin=sf_dir)

    @classmethod
    def from_driver_tables_via(cls, spark: SparkSession, sf_dir: str, base_path: str) -> "RawSources":
        """As ``from_driver_tables``, but the shared order-line join is written once to
        ``base_path`` (a shared folder) and the three extracts aggregate that table."""
        t = DriverTables(spark, sf_dir)
        fixtures.line_base(t).write.mode("overwrite").parquet(base_path)

        def b():
            return spark.read.parquet(base_path)
        return cls(spark, {
            "raw_part_d_spending": lambda: fixtures.drug_spending_wide(t, base=b()),
            "raw_prescribers": lambda: fixtures.prescribers(t, base=b()),
            "raw_prescribers_drug": lambda: fixtures.prescriber_drugs(t, base=b()),
            "seed_therapeutic_area_map": lambda: fixtures.therapeutic_area_map(t),
            "seed_state_region_map": lambda: fixtures.state_region_map(t),
        }, origin=sf_dir)

    @classmethod
    def from_csv(cls, spark: SparkSession, paths: dict[str, str], years: Sequence[int],
                 filters: bool = True, rows: dict[str, tuple[Observation, Observation]] | None = None) -> "RawSources":
        """Delivered CSV extracts and seed files, bound by header name (``read_by_header``).

        ``paths`` maps each input name to a file or folder. With ``filters`` the prescriber extract keeps
        the target specialties, and the prescriber-drug extract the drugs of the area map, as
        the original ingest does. ``rows`` receives two observations for each input, filled by the job that reads it:
        of the rows read, with the number rejected for each reason (a column whose text does not cast, a
        malformed row), and of the rows kept. ``rejected(name)`` gives the rejected rows with their reasons.
        """
        from . import schemas
        from .fixtures import SPENDING_STUBS
        from .ingest import (GENERIC_CANDIDATES, SPECIALTY_CANDIDATES, TARGET_SPECIALTIES,
                             filter_to_reference, filter_values, read_by_header, rejection_counts)

        candidates = {"gnrc_name": GENERIC_CANDIDATES, "prscrbr_type": SPECIALTY_CANDIDATES}
        layouts = {"raw_part_d_spending": schemas.spending_schema(years, SPENDING_STUBS),
                   "raw_prescribers": schemas.prescribers_schema(),
                   "raw_prescribers_drug": schemas.prescriber_drugs_schema(),
                   "seed_therapeutic_area_map": schemas.area_map_schema(),
                   "seed_state_region_map": schemas.region_map_schema()}

        def read(name, reasons=None):
            known = candidates if name in RAW_TABLES else {}
            return read_by_header(spark, paths[name], layouts[name], known, schemas.casts(name, layouts[name]), reasons)

        def kept(name, df):
            if filters and name == "raw_prescribers":
                return filter_values(df, SPECIALTY_CANDIDATES, TARGET_SPECIALTIES)
            if filters and name == "raw_prescribers_drug":
                return filter_to_reference(df, GENERIC_CANDIDATES, read("seed_therapeutic_area_map"), "generic_name")
            return df

        def build(name):
            if rows is None:
                return kept(name, read(name))
            seen, left = Observation(f"{name} read"), Observation(f"{name} kept")
            rows[name] = (seen, left)
            checked = read(name, REASONS).observe(seen, *rejection_counts(schemas.casts(name, layouts[name]), REASONS))
            return kept(name, checked.drop(REASONS)).observe(left, F.count(F.lit(1)).alias("rows"))
        out = cls(spark, {n: (lambda n=n: build(n)) for n in INPUTS}, origin=",".join(sorted(paths.values())))
        out.rejected = lambda name: read(name, REASONS).where(F.size(REASONS) > 0)
        return out

    @classmethod
    def from_directory(cls, spark: SparkSession, path: str, fmt: str = "parquet") -> "RawSources":
        """Inputs previously written as tables (``<path>/<name>``)."""
        return cls(spark, {n: (lambda n=n: spark.read.format(fmt).load(os.path.join(path, n)))
                           for n in INPUTS}, origin=path)
