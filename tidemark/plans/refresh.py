"""One run: landed snapshot to published staging and warehouse tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators.metrics import load_audit
from tidemark.operators.reshape import present_indicators
from tidemark.operators.warehouse import (
    Warehouse,
    build_dim_date,
    build_dim_indicator,
    build_dim_region,
    build_fact,
    build_periods,
    merge_periods,
)
from tidemark.functions.text import quoted
from tidemark.plans.tidy import (
    KEYS,
    REGION_ATTRS,
    flagged_rows,
    quarantined_rows,
    seen_regions,
    snapshot_revision_values,
    snapshot_revisions,
    typed_wide,
)
from tidemark.session import FILE_EXPANSION, shared_dir, sized_shuffles
from tidemark.sources.files import dated_folders, folder_bytes, remove_folder
from tidemark.sources.schemas import PARTITIONS, QUALITY_LOG, STAGING, conform
from tidemark.sources.snapshots import prior_snapshot_date, read_snapshot
from tidemark.sources.tables import (
    BOOKKEEPING,
    check_mode,
    constant_rows,
    current_paths,
    key_conflicts,
    new_run_id,
    partition_folders,
    publish,
    published_bytes,
    published_version,
    read_paths,
    read_published,
    run_folder,
    same_table,
    table_path,
    write_tables,
)

MALFORMED = "malformed_line"
PRIMARY_KEYS = {"stg_health_indicators": KEYS, "stg_regions": ("region_key",)}


@dataclass(frozen=True)
class RunResult:
    run_id: str
    snapshot_date: str
    prior_snapshot: str | None
    counts: dict[str, int] = field(default_factory=dict)


def raw_root(root: str) -> str:
    return f"{root}/raw"


def landed_dates(spark: SparkSession, root: str) -> DataFrame:
    """The dates of the landed snapshots."""
    dates = [(d,) for d in dated_folders(spark, raw_root(root))]
    return constant_rows(spark, dates, ["snapshot_date"])


def run(
    spark: SparkSession,
    root: str,
    snapshot_date: date | str,
    settings: Settings,
    run_ts: datetime,
    aliases: DataFrame | None = None,
    mode: str = "replace",
    as_of_year: int | None = None,
    row_col: str = "source_row",
) -> RunResult:
    """Clean one landed snapshot, compare it with the one before, rebuild the warehouse and make
    all of it current. ``run_ts`` is the only clock, so a repeated run writes the same rows.

    The text of each snapshot is parsed once: its rows, typed and with standardised regions, are
    written as wide as they are, and every output is made from that. Unpivoting is cheap and narrow,
    so the long form, four times the rows, is not kept.

    In mode ``refresh`` a partition of staging whose rows are the same as those published stays as it
    is, with its facts, and keeps its earlier ``loaded_at``; only the others are written.

    Raises ConcurrentRun, and publishes nothing, if another run was published since this one began."""
    check_mode(mode)
    run_id, base = new_run_id(run_ts), published_version(spark, root)
    prior = prior_snapshot_date(landed_dates(spark, root), snapshot_date).first()[0]
    snapshots = [str(d) for d in (snapshot_date, prior) if d is not None]
    volume = sum(folder_bytes(spark, f"{raw_root(root)}/snapshot_date={d}") for d in snapshots)
    if mode == "append":  # new keys are compared with those that are loaded already
        volume += published_bytes(spark, root)
    frames = [read_snapshot(spark, raw_root(root), d) for d in snapshots]
    if not present_indicators(frames[0], settings.indicators):
        raise ValueError(f"snapshot {snapshot_date} has none of the configured indicators")
    scratch = f"{shared_dir(spark)}/typed-{run_id}"
    with sized_shuffles(spark, FILE_EXPANSION * volume):
        counts, kept = _write_all(
            spark,
            root,
            run_id,
            frames,
            _typed_once(frames, scratch, settings, aliases, row_col),
            settings,
            prior,
            F.lit(run_ts),
            mode,
            run_ts.year if as_of_year is None else as_of_year,
            row_col,
        )
    publish(spark, root, run_id, run_ts, mode, list(counts), kept, base)
    log_loads(spark, root, counts, run_ts)
    remove_folder(spark, scratch)
    figures = {n: c for n, c in counts.items() if n not in BOOKKEEPING}
    return RunResult(run_id, str(snapshot_date), None if prior is None else str(prior), figures)


def _typed_once(
    snapshots: list[DataFrame], path: str, settings: Settings, aliases: DataFrame | None, row_col: str
) -> list[DataFrame]:
    """The typed wide rows of each snapshot, written below ``path`` and read back. They go to the
    shared folder, not to memory: a lost executor costs no parsing again."""

    def once(place: int) -> DataFrame:
        typed = typed_wide(well_formed(snapshots[place]), settings, aliases)
        rows = [row_col] if row_col in typed.columns else []
        typed = typed.select(
            *rows, "region_key", *REGION_ATTRS, "year",
            *(quoted(c) for c in present_indicators(typed, settings.indicators)),
        )
        typed.write.parquet(f"{path}/{place}")
        return typed.sparkSession.read.schema(typed.schema).parquet(f"{path}/{place}")

    with ThreadPoolExecutor(len(snapshots)) as pool:
        return list(pool.map(once, range(len(snapshots))))


def _write_all(
    spark: SparkSession,
    root: str,
    run_id: str,
    snapshots: list[DataFrame],
    typed_rows: list[DataFrame],
    settings: Settings,
    prior_date: date | None,
    stamp: Column,
    mode: str,
    as_of_year: int,
    row_col: str,
) -> tuple[dict[str, int], dict[str, list[str]]]:
    """Write every table of a run from the snapshot and, if there is one, the one before it.
    Returns the numbers of rows, and the folders of earlier runs that are kept."""
    counts: dict[str, int] = {}
    current = {} if mode == "replace" else current_paths(spark, root)
    kept: dict[str, list[str]] = {}

    def write(dealt: tuple[str, ...] = (), **frames: DataFrame) -> dict[str, DataFrame]:
        counts.update(write_tables(frames, root, run_id, dealt))
        return {
            n: read_paths(spark, n, [*kept.get(n, ()), table_path(root, run_id, n)]) for n in frames
        }

    typed, *before = typed_rows
    revisions = None
    if before:
        revisions = snapshot_revisions(typed, *before, settings, prior_date)
        revisions = revisions.withColumn("detected_at", stamp)
    first = write(
        stg_data_revisions=_or_empty(spark, revisions, "stg_data_revisions"),
        stg_rejected_rows=_with_malformed(
            quarantined_rows(typed, settings, as_of_year, stamp, row_col), snapshots[0], stamp, row_col
        ),
        stg_regions=_by_name(seen_regions(typed, settings, as_of_year, row_col)),
    )

    # From here on the revisions are read as written: their size is known, and where no key has
    # several values the snapshots are not read for the list of them.
    found = values = None
    if before:
        found = first["stg_data_revisions"]
        values = snapshot_revision_values(typed, *before, found, settings)
    rows = flagged_rows(typed, found, settings, as_of_year, stamp)
    same, dealt = [], ()
    if mode == "refresh":
        marks = write(partition_marks=partition_marks(rows))["partition_marks"]
        same = _unchanged(spark, marks, current)
    if same:
        fact_keys = [(code, year * 10000 + 101) for code, year in same]
        kept["stg_health_indicators"] = _folders_of(spark, "stg_health_indicators", current, same)
        kept["fact_health_indicator"] = _folders_of(spark, "fact_health_indicator", current, fact_keys)
        keys = ["indicator_code", "year"]
        rows = rows.join(constant_rows(spark, same, keys), keys, "left_anti")
    else:
        rows = flagged_rows(typed, found, settings, as_of_year, stamp, deal=("year", "region_key"))
        dealt = ("stg_health_indicators",)
    second = write(
        dealt,
        stg_health_indicators=rows,
        stg_revision_values=_or_empty(spark, values, "stg_revision_values"),
    )
    staged = {**first, **second}
    if mode == "append":
        for name in PARTITIONS:
            if not all(same_table(p, table_path(root, run_id, name)) for p in current.get(name, ())):
                raise ValueError(f"{name} is in an earlier layout: replace it before appending")
        refuse_repeated_keys(spark, current, staged)

    indicators = staged["stg_health_indicators"]
    dims = {
        "dim_region": build_dim_region(staged["stg_regions"]),
        "dim_date": build_dim_date(indicators),
        "dim_indicator": build_dim_indicator(indicators),
    }
    if mode == "append":
        dims = {n: beside_current(spark, current, n, df) for n, df in dims.items()}
        # Years and indicators may have been there already; region keys are new.
        dims |= {n: dims[n].distinct() for n in ("dim_date", "dim_indicator")}
    dims = write(**dims)
    # Joined to the dimensions as written, whose sizes are known as well. A run has facts for the
    # rows it wrote only: an appending run refuses keys that are loaded, a refreshing one keeps the
    # facts of the partitions that are the same.
    own = read_paths(
        spark, "stg_health_indicators", [table_path(root, run_id, "stg_health_indicators")]
    )
    last = {"fact_health_indicator": build_fact(own, **dims)}
    # Rows that were appended to before there were marks have none to add to.
    if mode == "replace" or (mode == "append" and ("partition_marks" in current or not current)):
        last["partition_marks"] = partition_marks(own)
        if mode == "append":
            marks = beside_current(spark, current, "partition_marks", last["partition_marks"])
            last["partition_marks"] = merge_marks(marks)
    periods = build_periods(write(**last)["fact_health_indicator"])
    if mode == "append":
        periods = beside_current(spark, current, "fact_periods", periods)
    write(fact_periods=merge_periods(periods))
    return counts, kept


def partition_marks(rows: DataFrame) -> DataFrame:
    """Per partition of staging: rows, and two sums of hashes of all their columns but the time of
    loading. They do not depend on the order of rows, and those of two lots add up."""
    rows = conform(rows, "stg_health_indicators").drop("loaded_at")
    hashed = [F.xxhash64(F.lit(i), *rows.columns).cast("decimal(38,0)") for i in range(2)]
    return rows.groupBy("indicator_code", "year").agg(
        F.count(F.lit(1)).alias("staged_rows"), F.sum(hashed[0]).alias("one"), F.sum(hashed[1]).alias("other")
    )


def merge_marks(marks: DataFrame) -> DataFrame:
    """One mark per partition from those of several lots of rows."""
    sums = [F.sum(c).alias(c) for c in ("staged_rows", "one", "other")]
    return marks.groupBy("indicator_code", "year").agg(*sums)


def _unchanged(
    spark: SparkSession, marks: DataFrame, current: dict[str, list[str]]
) -> list[tuple[str, int]]:
    """The partitions whose marks are those of the current tables: one row per indicator and year at
    most. None if the current tables have no marks, or are not laid out by partitions."""
    if "partition_marks" not in current:
        return []
    if not all(run_folder(p) for name in PARTITIONS for p in current.get(name, ())):
        return []
    known = read_paths(spark, "partition_marks", current["partition_marks"])
    return [(r.indicator_code, r.year) for r in marks.intersect(known).collect()]


def _folders_of(
    spark: SparkSession, name: str, current: dict[str, list[str]], keys: list[tuple]
) -> list[str]:
    """The folders of the partitions ``keys`` of a current table."""
    wanted = {tuple(map(str, k)) for k in keys}
    found = partition_folders(spark, name, current.get(name, ()))
    return [folder for key, folders in sorted(found.items()) if key in wanted for folder in folders]


def well_formed(wide: DataFrame) -> DataFrame:
    """The rows of a landed snapshot whose lines had no more fields than the header."""
    if MALFORMED not in wide.columns:
        return wide
    return wide.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def _with_malformed(rejected: DataFrame, wide: DataFrame, stamp: Column, row_col: str) -> DataFrame:
    """The rejected rows and, as one row each, the lines that were malformed."""
    if MALFORMED not in wide.columns:
        return rejected.withColumn("raw_line", F.lit(None).cast("string"))
    lines = wide.where(F.col(MALFORMED).isNotNull()).select(
        F.col(row_col).cast("bigint").alias("source_row"),
        F.lit("malformed_line").alias("reject_reason"),
        F.col(MALFORMED).alias("raw_line"),
        stamp.alias("loaded_at"),
    )
    return rejected.unionByName(lines, allowMissingColumns=True)


def _or_empty(spark: SparkSession, df: DataFrame | None, name: str) -> DataFrame:
    return spark.createDataFrame([], STAGING[name]) if df is None else df


def _by_name(regions: DataFrame) -> DataFrame:
    return regions.orderBy(F.asc_nulls_last("region_name"), "region_key")


def refuse_repeated_keys(
    spark: SparkSession, current: dict[str, list[str]], staged: dict[str, DataFrame]
) -> None:
    """Raise ValueError if a staged row has a key that is already in the current tables."""
    for name, keys in PRIMARY_KEYS.items():
        if name in current:
            existing = read_paths(spark, name, current[name])
            if not key_conflicts(staged[name], existing, keys).isEmpty():
                raise ValueError(f"append would repeat keys of {name}")


def beside_current(
    spark: SparkSession, current: dict[str, list[str]], name: str, new: DataFrame
) -> DataFrame:
    """The current rows of a table, if it has any, and the new ones."""
    new = conform(new, name)
    return read_paths(spark, name, current[name]).unionByName(new) if name in current else new


def log_loads(
    spark: SparkSession, root: str, counts: dict[str, int], run_ts: datetime
) -> None:
    """Append the audit rows of the staging tables to the quality log."""
    rows = [(n, c) for n, c in counts.items() if n in STAGING]
    loads = constant_rows(spark, rows, ["table_name", "row_count"]).withColumn(
        "row_count", F.col("row_count").cast("bigint")
    )
    load_audit(loads, F.lit(run_ts)).coalesce(1).write.mode("append").parquet(
        f"{root}/{QUALITY_LOG}"
    )


def read_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The published star schema."""
    tables = read_published(spark, root)
    return Warehouse(
        tables["fact_health_indicator"],
        tables["dim_region"],
        tables["dim_date"],
        tables["dim_indicator"],
        tables["fact_periods"],
    )
