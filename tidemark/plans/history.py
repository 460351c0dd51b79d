"""The published history of values: kept up to date with the landed snapshots."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators.history import history_of, last_values, merge_snapshot
from tidemark.operators.reshape import apply_indicator_metadata, present_indicators, unpivot_indicators
from tidemark.plans.refresh import raw_root, well_formed
from tidemark.plans.tidy import KEYS, WIDE_KEYS, long_rows, typed_wide
from tidemark.session import FILE_EXPANSION, sized_shuffles
from tidemark.sources.files import dated_folders, folder_bytes, remove_folder
from tidemark.sources.snapshots import read_snapshot, recorded_files
from tidemark.sources.tables import (
    constant_rows,
    current_paths,
    new_run_id,
    publish,
    published_version,
    read_paths,
    table_path,
    write_tables,
)

CLOSED, OPEN, MERGED = "value_history_closed", "value_history_open", "value_history_dates"


def snapshot_values(
    spark: SparkSession, root: str, day: str, settings: Settings, aliases: DataFrame | None, row_col: str
) -> DataFrame:
    """A row per key with a value of one landed snapshot."""
    typed = typed_wide(well_formed(read_snapshot(spark, raw_root(root), day)), settings, aliases)
    figures = present_indicators(typed, settings.indicators)
    codes = {i.code for i in settings.indicators if i.source_col in figures}
    if len(codes) < len(figures) or not figures:  # columns that share a code are one list of rows
        return last_values(long_rows(typed, settings, [row_col]), KEYS, order_col=row_col)
    wide = last_values(typed, WIDE_KEYS, figures, row_col)
    long = apply_indicator_metadata(unpivot_indicators(wide, settings.indicators, WIDE_KEYS), settings.indicators)
    return long.where(F.col("value").isNotNull()).select(*KEYS, "value")


def landed_marks(spark: SparkSession, root: str) -> dict[str, str]:
    """The landed dates, each with a digest of its files' identities."""
    listed = recorded_files(spark, raw_root(root)).groupBy("snapshot_date").agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list(F.concat_ws("|", "file", "file_bytes", "file_modified"))), ";"), 256)
        .alias("mark")
    )
    known = {str(r.snapshot_date): r.mark for r in listed.collect()}
    return {day: known.get(day, "") for day in dated_folders(spark, raw_root(root))}


def update_history(
    spark: SparkSession,
    root: str,
    settings: Settings,
    run_ts: datetime,
    aliases: DataFrame | None = None,
    row_col: str = "source_row",
) -> list[str]:
    """Bring the history up to the landed snapshots and publish it. Returns the dates that were read.

    Dates later than all merged ones are merged one by one: what they close is added beside the
    closed intervals, the open ones are written anew. If a merged date was landed again with other
    files, or one came in between, the history is made of all snapshots at once."""
    base, current, marks = published_version(spark, root), current_paths(spark, root), landed_marks(spark, root)
    if not marks:
        return []
    merged = {}
    if MERGED in current:
        merged = {str(r.snapshot_date): r.mark for r in read_paths(spark, MERGED, current[MERGED]).collect()}
    new = [day for day in marks if day not in merged]
    in_order = not new or not merged or min(new) > max(merged)
    grows = bool(merged) and in_order and all(marks.get(day) == mark for day, mark in merged.items())
    if grows and not new:
        return []
    days, run_id = new if grows else list(marks), new_run_id(run_ts)
    volume = sum(folder_bytes(spark, f"{raw_root(root)}/snapshot_date={d}") for d in days)
    if grows:
        volume += sum(folder_bytes(spark, p) for p in current[OPEN])
    with sized_shuffles(spark, FILE_EXPANSION * volume):
        values = {d: snapshot_values(spark, root, d, settings, aliases, row_col) for d in days}
        if grows:
            rows = read_paths(spark, OPEN, current[OPEN])
            closed = None
            for place, day in enumerate(days):
                step = _written(spark, root, run_id, f"step-{place}", merge_snapshot(rows, values[day], day, KEYS))
                done = step.where("valid_to is not null")
                closed = done if closed is None else closed.unionByName(done)
                rows = step.where("valid_to is null")
        else:
            dated = [v.withColumn("snapshot_date", F.lit(d).cast("date")) for d, v in values.items()]
            every = _written(spark, root, run_id, "all", history_of(reduce(DataFrame.unionByName, dated), KEYS))
            closed, rows = every.where("valid_to is not null"), every.where("valid_to is null")
        dates = constant_rows(spark, list(marks.items()), ["snapshot_date", "mark"])
        write_tables({CLOSED: closed, OPEN: rows, MERGED: dates}, root, run_id)
    publish(spark, root, run_id, run_ts, "append" if grows else "replace", [CLOSED, OPEN, MERGED], base=base)
    remove_folder(spark, table_path(root, run_id, "_history"))
    return days


def _written(spark: SparkSession, root: str, run_id: str, name: str, df: DataFrame) -> DataFrame:
    path = f"{table_path(root, run_id, '_history')}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All intervals, closed and open, as published."""
    paths = current_paths(spark, root)
    return read_paths(spark, CLOSED, paths[CLOSED]).unionByName(read_paths(spark, OPEN, paths[OPEN]))
