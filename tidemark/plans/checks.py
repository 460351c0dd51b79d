"""Checks of the published tables that read, after appending runs, what these have added."""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256
from time import time_ns

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.increments import first_state, next_state, results
from tidemark.operators.quality import LENGTH_CHECKS, STANDARD_CHECKS, Check
from tidemark.sources.files import storage
from tidemark.sources.schemas import PARTITIONS, SCHEMAS
from tidemark.sources.tables import (
    GROWING,
    constant_rows,
    partition_folders,
    paths_after,
    published_rows,
    read_paths,
)


def check_published(
    spark: SparkSession, root: str, checks: Sequence[Check] = (*STANDARD_CHECKS, *LENGTH_CHECKS)
) -> DataFrame:
    """The results of ``checks`` on the published tables, a row per check, as ``run_checks`` gives them.

    The state is kept below ``<root>/checks``, with the folders it stands for. If only appending runs
    were published since, the folders they added are checked, and keys are compared with the earlier
    rows of the same partitions; tables that a run writes whole are checked whole. Otherwise, and
    the first time, all rows are checked. A check that dies leaves the state before it."""
    log = published_rows(spark, root)
    current = paths_after(log)
    folder = f"{root}/checks/{sha256(repr(tuple(checks)).encode()).hexdigest()[:16]}"
    tables = {n: read_paths(spark, n, p) for n, p in current.items()}
    saved = _latest(spark, folder)
    state = None
    if saved is not None:
        covered, seen = _covered(spark, saved)
        if all(r.mode == "append" for r in log[seen:] if r.table_name in GROWING) and all(
            set(paths) <= set(current.get(n, ())) for n, paths in covered.items() if n in GROWING
        ):
            added, earlier = {}, {}
            for name in {c.table for c in checks} & set(GROWING) & set(covered):
                new = [p for p in current[name] if p not in covered[name]]
                before = _meeting(spark, name, covered[name], new)
                added[name] = read_paths(spark, name, new) if new else _empty(spark, name)
                earlier[name] = read_paths(spark, name, before) if before else _empty(spark, name)
            known = spark.read.parquet(f"{saved}/state")
            state = next_state(known, tables, added, earlier, checks)
    if state is None:
        state = first_state(tables, checks)
    own = f"{folder}/{time_ns():020d}"
    state.write.parquet(f"{own}/state")
    rows = [(n, p, len(log)) for n, paths in current.items() for p in paths]
    constant_rows(spark, rows, ["table_name", "path", "published"]).coalesce(1).write.parquet(f"{own}/covered")
    return results(spark.read.parquet(f"{own}/state"), checks)


def _empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def _meeting(spark: SparkSession, name: str, earlier: list[str], new: list[str]) -> list[str]:
    """The earlier folders in which a key of the new rows may be: the keys of a partitioned table
    hold its partition columns, so only equal partitions can have one."""
    if name not in PARTITIONS or not new:
        return earlier if new else []
    there = partition_folders(spark, name, new)
    before = partition_folders(spark, name, earlier)
    return [folder for key, folders in sorted(before.items()) if key in there for folder in folders]


def _latest(spark: SparkSession, folder: str) -> str | None:
    """The newest complete state: what it stands for is written after it."""
    path, store = storage(spark, folder)
    if not store.exists(path):
        return None
    names = sorted(s.getPath().getName() for s in store.listStatus(path))
    for name in reversed(names):
        done, _ = storage(spark, f"{folder}/{name}/covered/_SUCCESS")
        if store.exists(done):
            return f"{folder}/{name}"
    return None


def _covered(spark: SparkSession, saved: str) -> tuple[dict[str, list[str]], int]:
    """Folders by table, a row per folder as in the list of published ones; and that list's length."""
    out: dict[str, list[str]] = {}
    seen = 0
    for r in spark.read.parquet(f"{saved}/covered").collect():
        out.setdefault(r.table_name, []).append(r.path)
        seen = int(r.published)
    return out, seen
