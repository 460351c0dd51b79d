"""The snapshots and the published warehouse of one set of test tables, written once.

Snapshots are landed and a run is published under the session's shared folder. Each query then
reads landed or published tables, as analysts do; nothing is kept in executor memory."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import cached_property
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.warehouse import Warehouse
from tidemark.plans.refresh import raw_root, run
from tidemark.plans.tidy import long_rows, typed_wide
from tidemark.session import FILE_EXPANSION, shared_dir, sized_shuffles
from tidemark.sources.files import folder_bytes
from tidemark.sources.snapshots import land_snapshot, read_snapshot
from tidemark.sources.tables import current_paths, read_paths
from workload import inputs
from workload.inputs import AS_OF_YEAR, CURRENT, PRIOR, SETTINGS

RUN_TS = datetime(2026, 1, 5)
_READY: dict[tuple, Workspace] = {}
_LOCK = Lock()


@dataclass(frozen=True)
class Workspace:
    spark: SparkSession
    root: str

    def wide(self, day: str = CURRENT) -> DataFrame:
        """A landed snapshot, under the column names the library works with."""
        return read_snapshot(self.spark, raw_root(self.root), day)

    def typed(self, day: str = CURRENT) -> DataFrame:
        return typed_wide(self.wide(day), SETTINGS)

    def long(self, day: str = CURRENT, carry: tuple[str, ...] = ("k", "y")) -> DataFrame:
        return long_rows(self.typed(day), SETTINGS, carry)

    @cached_property
    def paths(self) -> dict[str, list[str]]:
        """The published folders; a workspace is published once."""
        return current_paths(self.spark, self.root)

    def table(self, name: str) -> DataFrame:
        return read_paths(self.spark, name, self.paths[name])

    def warehouse(self) -> Warehouse:
        dims = ("dim_region", "dim_date", "dim_indicator")
        return Warehouse(*map(self.table, ("fact_health_indicator", *dims, "fact_periods")))


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors can reach."""
    return f"{shared_dir(spark)}/{purpose}-{uuid4().hex}"


def _land(spark: SparkSession, sf_dir: str, root: str) -> Workspace:
    space = Workspace(spark, root)
    row = (F.col("k") * 10000 + F.col("y")).alias("source_row")
    current = inputs.wide(spark, sf_dir).withColumnsRenamed(SETTINGS.renames).select("*", row)
    volume = sum(folder_bytes(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part"))
    with sized_shuffles(spark, FILE_EXPANSION * volume):
        land_snapshot(current, raw_root(root), CURRENT)
    # From the landed rows: line items are aggregated once for both snapshots.
    land_snapshot(inputs.prior_wide(space.wide()), raw_root(root), PRIOR)
    return space


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of ``sf_dir``, built on first use by this application."""
    sizes = tuple(folder_bytes(spark, f"{sf_dir}/{t}.parquet") for t in ("lineitem", "part"))
    key = (spark.sparkContext.applicationId, sf_dir, sizes)
    with _LOCK:
        if key not in _READY:
            space = _land(spark, sf_dir, scratch(spark, "workspace"))
            run(spark, space.root, CURRENT, SETTINGS, RUN_TS, as_of_year=AS_OF_YEAR)
            _READY[key] = space
        return _READY[key]
