"""Removing the folders of runs that nobody reads any more."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tidemark.sources.files import remove_folder, storage
from tidemark.sources.schemas import PARTITIONS
from tidemark.sources.tables import RUN, partition_folders, paths_after, published_rows


def expire_runs(spark: SparkSession, root: str, age: timedelta, now: datetime) -> list[str]:
    """Remove what no state of the last ``age`` consists of, and return the folders.

    A reader keeps the folders that were current when it began. So those of every state stay that was
    current at ``now - age`` or later; with ``age`` above the longest query no reader loses its files.
    A run begins on the current state, which always stays, so what a refreshing run keeps is there
    when it is published. Folders of runs that were never published go when they are older than
    ``age``, which has to be above the longest run as well.

    The driver lists folders of runs, and of partitions where only some of a run are left."""
    cutoff = now - age
    live = {_qualified(spark, p) for p in _live(published_rows(spark, root), cutoff.timestamp())}
    removed = []
    for folder, modified in _run_folders(spark, root):
        below = {p for p in live if p.startswith(f"{folder}/")}
        if folder in live or (below and not _partitioned(folder)):
            continue
        if below:
            table = folder.split("/")[-2]
            parts = [p for own in partition_folders(spark, table, [folder]).values() for p in own]
            removed += [p for p in map(lambda x: _qualified(spark, x), parts) if p not in below]
        elif modified < cutoff.timestamp():
            removed.append(folder)
    for path in removed:
        remove_folder(spark, path)
    return removed


def _live(rows: list, cutoff: float) -> set[str]:
    """The folders of the state at ``cutoff`` (seconds) and of all later ones."""
    runs: dict[str, list] = {}
    for row in rows:
        runs.setdefault(row.run_id, []).append(row)
    lots, found, so_far = list(runs.values()), set(), []
    for own, following in zip(lots, [*lots[1:], None]):  # noqa: B905
        so_far += own
        if following is None or following[0].published_ns / 1e9 >= cutoff:
            found.update(p for paths in paths_after(so_far).values() for p in paths)
    return found


def _run_folders(spark: SparkSession, root: str) -> list[tuple[str, float]]:
    """The folders of runs and when they were last changed (seconds)."""
    found = []
    for pattern in (f"{root}/runs/*", *(f"{root}/{name}/{RUN}=*" for name in PARTITIONS)):
        where, store = storage(spark, pattern)
        for status in store.globStatus(where) or ():
            found.append((status.getPath().toString(), status.getModificationTime() / 1000))
    return found


def _partitioned(folder: str) -> bool:
    return folder.split("/")[-1].startswith(f"{RUN}=")


def _qualified(spark: SparkSession, path: str) -> str:
    where, store = storage(spark, path)
    return store.makeQualified(where).toString()
