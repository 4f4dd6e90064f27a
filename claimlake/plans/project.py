"""Model registry and the per-run project context.

A model is a plain function ``(Project) -> DataFrame``. It reads other models through
``prj.model(name)``, which builds each model once per project, so a model read by ten
marts is one DataFrame (and, once materialised, one table scan).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import checked_broadcast
from ..params import DEFAULT, Params
from ..sources.raw import RawSources


@dataclass(frozen=True)
class ModelSpec:
    name: str
    fn: Callable[["Project"], DataFrame]
    layer: str                       # staging | intermediate | marts
    domain: str = ""                 # commercial, customer_success, ...
    grain: tuple[str, ...] = ()
    key: str | None = None           # surrogate key column, declared unique
    not_null: tuple[str, ...] = ()   # declared not-null columns
    description: str = ""
    owner: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)

    @property
    def all_tags(self) -> tuple[str, ...]:
        return (self.layer,) + ((self.domain,) if self.domain else ()) + self.tags


MODELS: dict[str, ModelSpec] = {}


def model(layer: str, domain: str = "", grain: Sequence[str] = (), key: str | None = None,
          not_null: Sequence[str] = (), description: str = "", owner: str = "",
          tags: Sequence[str] = ()):
    def deco(fn):
        MODELS[fn.__name__] = ModelSpec(fn.__name__, fn, layer, domain, tuple(grain), key,
                                        tuple(not_null), description or (fn.__doc__ or ""),
                                        owner, tuple(tags))
        return fn
    return deco


def select_models(tags: Sequence[str] = (), names: Sequence[str] = ()) -> list[ModelSpec]:
    """Models carrying every tag in ``tags`` (layer or domain), or named in ``names``."""
    out = []
    for spec in MODELS.values():
        if names and spec.name not in names:
            continue
        if tags and not set(tags) <= set(spec.all_tags):
            continue
        out.append(spec)
    return out


class Project:
    def __init__(self, spark: SparkSession, sources: RawSources, params: Params = DEFAULT):
        self.spark = spark
        self.sources = sources
        self.params = params
        self._models: dict[str, DataFrame] = {}
        self._seeds: dict[str, DataFrame] = {}

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str,
                           params: Params = DEFAULT) -> "Project":
        return cls(spark, RawSources.from_driver_tables(spark, sf_dir), params)

    def raw(self, name: str) -> DataFrame:
        return self.sources[name]

    def seed_frame(self, name: str, frame: DataFrame, keys: Sequence[str]) -> DataFrame:
        """A reference map, size- and key-checked once per project, then broadcast."""
        if name not in self._seeds:
            self._seeds[name] = checked_broadcast(frame, keys, self.params.max_broadcast_bytes, name)
        return self._seeds[name]

    def model(self, name: str) -> DataFrame:
        if name not in self._models:
            _ensure_loaded()
            self._models[name] = MODELS[name].fn(self)
        return self._models[name]

    def use_table(self, name: str, df: DataFrame) -> None:
        """Serve ``name`` from an already written table from now on."""
        self._models[name] = df

    def checkpoint(self, names: Sequence[str]) -> None:
        """Cut lineage of models read by many consumers: reliable checkpoint into the
        shared folder named by ``spark.checkpoint.dir`` (set only when unset)."""
        from ..session import shared_dir
        shared_dir(self.spark)
        for n in names:
            self._models[n] = self.model(n).checkpoint(eager=True)

    def materialize(self, names: Sequence[str], path: str, fmt: str = "parquet", **options: str) -> dict[str, str]:
        """Write models as tables under ``path``, with the writer's ``options``, and read them back from there.

        Later models then scan the written table instead of recomputing its lineage; a
        lost executor costs a re-read, not a recompute.
        """
        written = {}
        for n in names:
            target = os.path.join(path, n)
            self.model(n).write.mode("overwrite").options(**options).format(fmt).save(target)
            self._models[n] = self.spark.read.format(fmt).load(target)
            written[n] = target
        return written


def _ensure_loaded() -> None:
    # Importing the model modules registers them.
    from . import intermediate, marts, staging  # noqa: F401
