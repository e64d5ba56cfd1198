"""Jobs over named tables, run in the order of what they need."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from .schemas import Table
from .sources import tables

log = logging.getLogger(__name__)


class CriticalWarning(RuntimeError):
    """A quality check that must stop the pipeline."""


@dataclass(frozen=True)
class Job:
    """``function(**inputs, **params)`` makes one table, or a dict of them by output name."""

    name: str
    function: Callable[..., DataFrame | Mapping[str, DataFrame]]
    inputs: Mapping[str, str]
    outputs: Sequence[str]
    params: Mapping[str, object] = field(default_factory=dict)
    stop_if: Callable[[Mapping[str, DataFrame]], bool] | None = None


@dataclass
class Catalog:
    """Where tables lie: declared ones by ``Table``, and others as Parquet."""

    spark: SparkSession
    root: str
    declared: Mapping[str, Table] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.declared[name], self.path(name)) if name in self.declared else self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame) -> None:
        if name in self.declared:
            tables.write(df, self.declared[name], self.path(name), "overwrite")
        else:
            df.write.mode("overwrite").parquet(self.path(name))


def order(jobs: Sequence[Job]) -> list[Job]:
    """Each job after those that make its inputs; raises on a cycle or on two makers of a table."""
    maker: dict[str, str] = {}
    for j in jobs:
        for o in j.outputs:
            if o in maker:
                raise ValueError(f"{o} is made by {maker[o]} and by {j.name}")
            maker[o] = j.name
    by_name = {j.name: j for j in jobs}
    needs = {j.name: {maker[i] for i in j.inputs.values() if i in maker} for j in jobs}
    return [by_name[n] for n in TopologicalSorter(needs).static_order()]


def run(jobs: Sequence[Job], catalog: Catalog) -> dict[str, float]:
    """Run all jobs, each on written inputs; returns the seconds each took. A failure or critical warning stops the rest."""
    took: dict[str, float] = {}
    for job in order(jobs):
        began = time.perf_counter()
        made = job.function(**{k: catalog.read(v) for k, v in job.inputs.items()}, **job.params)
        made = made if isinstance(made, Mapping) else {job.outputs[0]: made}
        for name, df in made.items():
            catalog.write(name, df)
        took[job.name] = time.perf_counter() - began
        log.info("%s took %.1f s", job.name, took[job.name])
        if job.stop_if and job.stop_if({n: catalog.read(n) for n in made}):
            raise CriticalWarning(job.name)
    return took
