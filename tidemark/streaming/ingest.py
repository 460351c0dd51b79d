"""Incremental ingest of dated snapshot folders."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Settings
from tidemark.plans.refresh import MALFORMED, raw_root, run
from tidemark.session import shared_dir
from tidemark.sources.files import (
    dated_folders,
    read_aliases,
    read_wide,
    snapshot_files,
    with_snapshot_date,
)
from tidemark.sources.snapshots import changed_dates, land_snapshot, record_files, recorded_files

# Called with each date and the folders that hold its files, oldest first.
OnSnapshots = Callable[[SparkSession, dict[date, list[str]]], None]

# What a binary-file source reports per file; only the path is ever read.
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def stream_snapshots(
    spark: SparkSession,
    source_root: str,
    on_snapshots: OnSnapshots,
    checkpoint: str | None = None,
    pattern: str = "*.csv",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Call ``on_snapshots(spark, folders)`` for the dated folders that have new files, then stop.

    The stream carries file names only, so its checkpoint remembers which files were seen, while
    the rows are read by ``on_snapshots`` as an ordinary job with the header of the file. A date
    comes with all its folders as they are found then, so how many files make a batch does not
    change what it gets last. A batch may be delivered again after a failure: ``on_snapshots`` has
    to replace, not add. The checkpoint belongs to one source and one purpose."""
    listing = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source_root)
        .select("path")
    )

    def each_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        days = with_snapshot_date(batch).select("snapshot_date").distinct()
        files = snapshot_files(session, source_root, pattern)
        on_snapshots(session, _folders(files.join(days, "snapshot_date", "left_semi")))

    own = sha256(f"{source_root}|{pattern}".encode()).hexdigest()[:16]
    return (
        listing.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint or f"{shared_dir(spark)}/snapshot-stream-{own}")
        .trigger(availableNow=True)
        .start()
    )


def _folders(files: DataFrame) -> dict[date, list[str]]:
    """Dates and their folders, a row per folder, oldest date first."""
    found: dict[date, list[str]] = {}
    for row in files.select("snapshot_date", "folder").distinct().orderBy("snapshot_date", "folder").collect():
        found.setdefault(row.snapshot_date, []).append(row.folder)
    return found


def land_folders(raw: str, settings: Settings, pattern: str = "*.csv") -> OnSnapshots:
    """An ``on_snapshots`` that reads the files of each date and lands them under it. Lines with
    too many fields are landed as they are, in ``malformed_line``. Names, lengths and modification
    times are listed before the files are read, so one that changes meanwhile is seen next time."""

    def land(spark: SparkSession, folders: dict[date, list[str]]) -> None:
        for day, paths in folders.items():
            files = snapshot_files(spark, paths, pattern).where(F.col("snapshot_date") == F.lit(day))
            wide = read_wide(
                spark,
                [f"{path}/{pattern}" for path in paths],
                settings.renames,
                settings.na_tokens,
                row_id="source_row",
                file_col="file",
                malformed_col=MALFORMED,
            )
            land_snapshot(wide, raw, day)
            record_files(files.where(F.col("folder").isin(paths)), raw)

    return land


def refresh_folders(
    root: str, settings: Settings, alias_path: str | None = None, pattern: str = "*.csv"
) -> OnSnapshots:
    """An ``on_snapshots`` for the whole chain: land all dates, then publish one run of the newest
    date that is landed. Files that come late for an older date change what the newest is compared
    with, and never take its place; ``run`` publishes an older date for who asks for it. Partitions
    whose rows are as they were published are kept, so a late file costs what it touches."""
    land = land_folders(raw_root(root), settings, pattern)

    def refresh(spark: SparkSession, folders: dict[date, list[str]]) -> None:
        if not folders:
            return
        land(spark, folders)
        newest = dated_folders(spark, raw_root(root))[-1]
        aliases = read_aliases(spark, alias_path) if alias_path else None
        run(spark, root, newest, settings, datetime.now(timezone.utc), aliases, mode="refresh")

    return refresh


def pending_folders(
    spark: SparkSession, source_root: str, raw: str, pattern: str = "*.csv", again: bool = False
) -> dict[date, list[str]]:
    """The dates, with their folders, that have a file which is not landed as it is now: one that is
    new, was corrected under its name, or was taken away. All dates ``again``."""
    if not dated_folders(spark, source_root):
        return {}
    files = snapshot_files(spark, source_root, pattern)
    if not again:
        days = changed_dates(files, recorded_files(spark, raw))
        files = files.join(days, "snapshot_date", "left_semi")
    return _folders(files)


def land_pending(
    spark: SparkSession,
    source_root: str,
    root: str,
    settings: Settings,
    pattern: str = "*.csv",
    again: bool = False,
) -> list[str]:
    """Land every date that has a file which is not landed as it is now, with all its files, or all
    dates ``again``; no stream, no checkpoint. Returns the dates."""
    raw = raw_root(root)
    folders = pending_folders(spark, source_root, raw, pattern, again)
    land_folders(raw, settings, pattern)(spark, folders)
    return [str(day) for day in folders]


def refresh_pending(
    spark: SparkSession,
    source_root: str,
    root: str,
    settings: Settings,
    alias_path: str | None = None,
    pattern: str = "*.csv",
) -> list[str]:
    """Land as ``land_pending`` does, and publish the newest date if anything was landed. This finds
    corrected files, which a stream does not see: it knows a file by its name."""
    folders = pending_folders(spark, source_root, raw_root(root), pattern)
    refresh_folders(root, settings, alias_path, pattern)(spark, folders)
    return [str(day) for day in folders]
