"""One query per operator, each over whole tables.

Queries of the cleaning operators read the landed snapshots; queries of the warehouse and the
reports read the published tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Indicator
from tidemark.functions.coverage import LOW
from tidemark.functions.numbers import to_year
from tidemark.functions.regions import region_key, region_type
from tidemark.functions.text import normalise_code, strip_text, to_flag
from tidemark.operators import (
    history,
    metrics,
    quality,
    regions,
    reshape,
    revisions,
    validate,
    warehouse,
)
from tidemark.operators.quality import AcceptedRange, Relationship
from tidemark.plans.checks import check_published
from tidemark.plans import reports
from tidemark.plans.catalog import publish_catalog
from tidemark.plans.history import read_history, update_history
from tidemark.plans.refresh import raw_root, run
from tidemark.plans.tidy import KEYS, REGION_ATTRS, seen_regions, snapshot_revisions
from tidemark.sources import snapshots
from tidemark.sources.files import read_aliases, read_wide, remove_folder, storage
from tidemark.sources.retention import expire_runs
from tidemark.sources.schemas import STAGING
from tidemark.sources.tables import read_published, register_views
from tidemark.streaming.ingest import (
    land_folders,
    land_pending,
    refresh_folders,
    refresh_pending,
    stream_snapshots,
)
from workload import inputs
from workload.inputs import AS_OF_YEAR, CURRENT, PRIOR, SETTINGS
from workload.workspace import RUN_TS, Workspace, scratch, workspace

Query = Callable[[SparkSession, str], DataFrame]

MAIN = SETTINGS.main_indicator
COVERAGE = "coverage_pct"
CHOSEN_REGIONS = ("C0000004", "C0000005", "C0000008", "C0000009", "C0000015")
_QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, which every reader of the results shows alike."""
    casts = {
        name: F.col(name).cast("string" if kind == "date" else "double")
        for name, kind in df.dtypes
        if kind == "date" or kind.startswith("decimal")
    }
    return df.withColumns(casts) if casts else df


def on_tables(fn: Query) -> Query:
    """Register a query that reads the test tables themselves."""
    _QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


def on_workspace(fn: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register a query that reads landed or published tables."""
    _QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(workspace(spark, sf_dir)))
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# Sources and sinks


def _write_csv(df: DataFrame, path: str, quote: str = '"', mode: str = "error") -> None:
    """A snapshot file as it is found in the wild: source column names, quoted where needed."""
    names = {new: old for old, new in SETTINGS.renames.items()}
    df.drop("source_row").withColumnsRenamed(names).write.csv(
        path,
        mode=mode,
        header=True,
        quote=quote,
        escape=quote,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


@on_workspace
def read_wide_roundtrip(w: Workspace) -> DataFrame:
    folder = scratch(w.spark, "csv")
    _write_csv(w.wide(), folder)
    return read_wide(w.spark, folder, SETTINGS.renames)


@on_workspace
def read_wide_malformed(w: Workspace) -> DataFrame:
    """A file with lines that have a field too many beside one without: lines are kept apart,
    none is cut."""
    folder, many = scratch(w.spark, "csv"), F.col("k") % 50 == 0
    _write_csv(w.wide().where(~many), f"{folder}/good")
    # Quoted by a sign that the reader does not know, so the comma in the name separates fields.
    split = w.wide().where(many).withColumn("region_name", F.concat("region_name", F.lit(",x")))
    _write_csv(split, f"{folder}/bad", quote="~")
    return read_wide(
        w.spark, [f"{folder}/good", f"{folder}/bad"], SETTINGS.renames, malformed_col="line"
    )


@on_workspace
def land_snapshot_idempotent(w: Workspace) -> DataFrame:
    root = scratch(w.spark, "landed")
    for day in (PRIOR, CURRENT, PRIOR):
        snapshots.land_snapshot(w.wide(day), root, day)
    return w.spark.read.parquet(root).select("snapshot_date", *_WIDE)


@on_workspace
def stream_ingest(w: Workspace) -> DataFrame:
    """Two dated folders and one that is none, taken in by the stream."""
    source, raw = scratch(w.spark, "source"), scratch(w.spark, "raw")
    for folder, day in ((PRIOR, PRIOR), (CURRENT, CURRENT), ("not-a-date", PRIOR)):
        _write_csv(w.wide(day), f"{source}/{folder}")
    stream = stream_snapshots(
        w.spark, source, land_folders(raw, SETTINGS), checkpoint=scratch(w.spark, "stream")
    )
    stream.awaitTermination()
    return _numbered(w.spark.read.parquet(raw)).select("snapshot_date", *_WIDE)


_WIDE = ("k", "y", "region_name", "iso_code", "year", "ind_f", "ind_a", "ind_b", "ind_c")


def _numbered(landed: DataFrame) -> DataFrame:
    return landed.withColumns({"k": F.col("k").cast("bigint"), "y": F.col("y").cast("int")})


@on_workspace
def land_second_file(w: Workspace) -> DataFrame:
    """A date of which half the rows come in a file after the date was landed."""
    source, root = scratch(w.spark, "source"), scratch(w.spark, "root")
    for late in (0, 1):
        half = w.wide(PRIOR).where(F.col("k") % 2 == late)
        _write_csv(half, f"{source}/{PRIOR}", mode="append")
        land_pending(w.spark, source, root, SETTINGS)
    return _numbered(snapshots.read_snapshot(w.spark, raw_root(root), PRIOR)).select(*_WIDE)


def _put_csv(df: DataFrame, path: str) -> None:
    """Snapshot files of fixed names at ``path``, in place of those that were there."""
    aside = scratch(df.sparkSession, "csv")
    _write_csv(df, aside)
    remove_folder(df.sparkSession, path)
    target, store = storage(df.sparkSession, path)
    store.mkdirs(target)
    for status in store.listStatus(storage(df.sparkSession, aside)[0]):
        name = status.getPath().getName()
        if name.startswith("part-"):
            store.rename(status.getPath(), storage(df.sparkSession, f"{path}/{name[:10]}.csv")[0])


@on_workspace
def land_corrected_file(w: Workspace) -> DataFrame:
    """What is published after a date's files, landed and published, were corrected under their names."""
    source, root = scratch(w.spark, "source"), scratch(w.spark, "root")
    for figures in (PRIOR, CURRENT):
        _put_csv(w.wide(figures), f"{source}/{CURRENT}")
        refresh_pending(w.spark, source, root, SETTINGS)
    return read_published(w.spark, root)["stg_health_indicators"].drop("loaded_at")


@on_workspace
def refresh_late_file(w: Workspace) -> DataFrame:
    """What is published after a file came late for the older of two dates."""
    source, root = scratch(w.spark, "source"), scratch(w.spark, "root")
    checkpoint = scratch(w.spark, "stream")

    def refresh() -> None:
        step = refresh_folders(root, SETTINGS)
        stream_snapshots(w.spark, source, step, checkpoint).awaitTermination()

    _write_csv(w.wide(PRIOR), f"{source}/{PRIOR}")
    _write_csv(w.wide(), f"{source}/{CURRENT}")
    refresh()
    new_regions = w.wide().where(F.col("k") % 29 == 0)
    _write_csv(new_regions, f"{source}/{PRIOR}", mode="append")
    refresh()
    return read_published(w.spark, root)["stg_health_indicators"].drop("loaded_at")


def _event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events seen as files: a day is a snapshot, an event type a file in it."""
    return inputs.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("snapshot_date"), F.col("event_type").alias("file"), "ts"
    )


@on_tables
def source_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.source_row_counts(_event_files(spark, sf_dir))


@on_tables
def pending_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a month of which the first half is landed."""
    files = _event_files(spark, sf_dir)
    return snapshots.pending_snapshots(files, files.where(F.dayofmonth("ts") <= 15))


@on_tables
def prior_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.prior_snapshot_date(_event_files(spark, sf_dir), "2024-01-15")


@on_workspace
def stage_indicators(w: Workspace) -> DataFrame:
    return w.table("stg_health_indicators").drop("loaded_at")


@on_workspace
def stage_append(w: Workspace) -> DataFrame:
    """Two snapshots without a region in common, the second appended to the first."""
    root = scratch(w.spark, "append")
    for place, day in enumerate((PRIOR, CURRENT)):
        half = w.wide().where(F.col("k") % 2 == place)
        snapshots.land_snapshot(half, raw_root(root), day)
        mode = "append" if place else "replace"
        run(w.spark, root, day, SETTINGS, RUN_TS, mode=mode, as_of_year=AS_OF_YEAR)
    return read_published(w.spark, root)["fact_health_indicator"].drop("loaded_at")


@on_workspace
def expire_replaced_runs(w: Workspace) -> DataFrame:
    """Rows of the published tables, and folders of the fact table, after a date was published twice
    and the replaced run was removed."""
    root = scratch(w.spark, "expired")
    snapshots.land_snapshot(w.wide(), raw_root(root), CURRENT)
    for _ in range(2):
        run(w.spark, root, CURRENT, SETTINGS, RUN_TS, as_of_year=AS_OF_YEAR)
    expire_runs(w.spark, root, timedelta(0), datetime.now(timezone.utc))
    left, store = storage(w.spark, f"{root}/fact_health_indicator")
    tables = read_published(w.spark, root)
    rows = metrics.view_status({n: tables[n] for n in STAGING})
    return rows.select(
        F.col("view_name").alias("table_name"), "row_count", F.lit(len(store.listStatus(left))).alias("run_folders")
    )


@on_workspace
def published_rejects(w: Workspace) -> DataFrame:
    return w.table("stg_rejected_rows").drop("loaded_at")


@on_workspace
def published_revisions(w: Workspace) -> DataFrame:
    return w.table("stg_data_revisions").drop("detected_at")


@on_workspace
def published_revision_values(w: Workspace) -> DataFrame:
    return w.table("stg_revision_values")


def _catalog(w: Workspace, view: str) -> DataFrame:
    publish_catalog(w.spark, w.root, SETTINGS)
    return w.spark.table(f"reporting.{view}")


@on_workspace
def catalog_trends(w: Workspace) -> DataFrame:
    return _catalog(w, "rpt_vaccination_trends")


@on_workspace
def catalog_comparison(w: Workspace) -> DataFrame:
    return _catalog(w, "rpt_regional_comparison")


@on_workspace
def catalog_below_threshold(w: Workspace) -> DataFrame:
    return _catalog(w, "rpt_below_threshold")


def _published_counts(w: Workspace) -> DataFrame:
    staged = {n: w.table(n) for n in STAGING}
    return metrics.view_status(staged).select(F.col("view_name").alias("table_name"), "row_count")


@on_workspace
def load_audit(w: Workspace) -> DataFrame:
    return metrics.load_audit(_published_counts(w))


@on_workspace
def view_row_counts(w: Workspace) -> DataFrame:
    wh = w.warehouse()
    views = {
        "trends": reports.vaccination_trends(wh, MAIN),
        "comparison": reports.regional_comparison(wh, MAIN),
        "below_threshold": reports.below_threshold(wh, MAIN),
    }
    register_views(views)
    return metrics.view_status({n: w.spark.table(n) for n in views})


# Projections, filters and scalar functions


@on_workspace
def unpivot_indicators(w: Workspace) -> DataFrame:
    return reshape.unpivot_indicators(w.wide(), SETTINGS.indicators, ["k", "y"])


@on_workspace
def coerce_numeric(w: Workspace) -> DataFrame:
    values = [i.source_col for i in SETTINGS.indicators]
    return reshape.coerce_numeric(w.wide(), values).select(
        "k", "y", to_year(F.col("year")).alias("year"), *values
    )


@on_workspace
def indicator_metadata(w: Workspace) -> DataFrame:
    """The year column is unpivoted too, as an indicator nobody described: its rows go."""
    unknown = Indicator("year", "year", "year", "none", "none")
    long = reshape.unpivot_indicators(w.wide(), (*SETTINGS.indicators, unknown), ["k", "y"])
    described = reshape.apply_indicator_metadata(long, SETTINGS.indicators)
    return described.drop("indicator_source_col")


def _standardised(w: Workspace) -> DataFrame:
    return regions.standardise_regions(w.wide(), country_len=SETTINGS.country_len)


@on_workspace
def standardise_regions(w: Workspace) -> DataFrame:
    return _standardised(w).select("k", "y", "region_key", *REGION_ATTRS)


@on_tables
def alias_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = regions.fill_from_alias(
        _standardised(workspace(spark, sf_dir)), inputs.aliases(spark, sf_dir)
    )
    return filled.select("k", "y", "region_name", "iso_code")


@on_tables
def alias_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files: of a name in several files, the row of the last file counts."""
    given, folder = inputs.aliases(spark, sf_dir), scratch(spark, "aliases")
    for row in (1, 2):
        rows = given.where(F.col("alias_row") == row).select("alias", "iso_code", F.lit("x").alias("notes"))
        rows.write.csv(f"{folder}/{row}", header=True, ignoreTrailingWhiteSpace=False)
    read = read_aliases(spark, [f"{folder}/1", f"{folder}/2"])
    filled = regions.fill_from_alias(_standardised(workspace(spark, sf_dir)), read)
    return filled.select("k", "y", "region_name", "iso_code")


@on_workspace
def region_type_counts(w: Workspace) -> DataFrame:
    code = normalise_code(F.col("iso_code"))
    kind = region_type(code, SETTINGS.aggregate_prefix, SETTINGS.country_len)
    return w.wide().groupBy(kind.alias("region_type")).agg(F.count(F.lit(1)).alias("wide_rows"))


@on_workspace
def region_key_slug(w: Workspace) -> DataFrame:
    """Keys as they would be if no region had a code."""
    name = strip_text(F.col("region_name"))
    no_code = F.lit(None).cast("string")
    return w.wide().select("k", "y", region_key(no_code, name).alias("region_key"))


def rules() -> list[validate.Rule]:
    return validate.row_rules(SETTINGS, AS_OF_YEAR)


@on_workspace
def validate_rejects(w: Workspace) -> DataFrame:
    columns = ["k", "y", "region_name", "iso_code", "year", "indicator_code", "value", validate.REASON]
    return validate.rejected_rows(w.long(), rules(), columns)


@on_workspace
def validate_clean(w: Workspace) -> DataFrame:
    return validate.valid_rows(w.long(), rules()).select("k", "y", *KEYS, "value")


@on_workspace
def quality_flags(w: Workspace) -> DataFrame:
    """Flags of the long rows; the published rows take theirs from the wide ones."""
    found = revisions.detect_revisions(w.long(), w.long(PRIOR), KEYS)
    valid = validate.with_missing_flag(validate.valid_rows(w.long(), rules()))
    flagged = validate.with_estimated_flag(revisions.flag_revised(valid, found, KEYS))
    return flagged.select("k", "y", "indicator_code", "is_missing", "is_revised", "is_estimated")


@on_tables
def coerce_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 3
    text = F.when(k == 0, "True").when(k == 1, "False").otherwise("weird")
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", to_flag(text).alias("flag"))


# Revisions


def _found(w: Workspace) -> DataFrame:
    return snapshot_revisions(w.typed(), w.typed(PRIOR), SETTINGS, PRIOR)


@on_workspace
def detect_revisions(w: Workspace) -> DataFrame:
    return _found(w).select(
        *KEYS, "old_value", "new_value", "old_rows", "new_rows", "prior_snapshot"
    )


@on_workspace
def revision_values(w: Workspace) -> DataFrame:
    return revisions.revision_values(w.long(), w.long(PRIOR), _found(w), KEYS)


@on_tables
def order_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against an earlier state of the table: late orders not there yet, some prices off
    by one."""
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    off = F.when(F.col("o_orderkey") % 19 == 0, 1.0).otherwise(0.0)
    earlier = orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    earlier = earlier.withColumn("o_totalprice", F.col("o_totalprice") + off)
    found = revisions.detect_revisions(orders, earlier, ["o_orderkey"], ["o_totalprice"])
    return found.drop("prior_snapshot")


# History

THIRD = "2024-01-22"


def _history(w: Workspace) -> DataFrame:
    """Three snapshots, of which the last is as the first, merged as they are landed."""
    root = scratch(w.spark, "history")
    for day, figures in ((PRIOR, PRIOR), (CURRENT, CURRENT), (THIRD, PRIOR)):
        snapshots.land_snapshot(w.wide(figures), raw_root(root), day)
        update_history(w.spark, root, SETTINGS, RUN_TS)
    return read_history(w.spark, root)


@on_workspace
def value_history(w: Workspace) -> DataFrame:
    return _history(w)


@on_workspace
def value_as_of(w: Workspace) -> DataFrame:
    """Each figure as it was known between the second and the third snapshot."""
    return history.as_of(_history(w), "2024-01-20").drop(*history.INTERVAL)


# Dimensions and fact


@on_workspace
def regions_first_seen(w: Workspace) -> DataFrame:
    seen = seen_regions(w.typed(), SETTINGS, AS_OF_YEAR)
    return seen.orderBy(F.asc_nulls_last("region_name"), "region_key")


@on_workspace
def dim_region(w: Workspace) -> DataFrame:
    return warehouse.build_dim_region(w.table("stg_regions"))


@on_workspace
def dim_date(w: Workspace) -> DataFrame:
    return warehouse.build_dim_date(w.table("stg_health_indicators"))


@on_workspace
def dim_indicator(w: Workspace) -> DataFrame:
    return warehouse.build_dim_indicator(w.table("stg_health_indicators"))


@on_workspace
def fact_indicator(w: Workspace) -> DataFrame:
    dims = (w.table("dim_region"), w.table("dim_date"), w.table("dim_indicator"))
    return warehouse.build_fact(w.table("stg_health_indicators"), *dims).drop("loaded_at")


@on_workspace
def star_lookup(w: Workspace) -> DataFrame:
    return warehouse.star(w.warehouse()).select(
        "region_id", "region_name", "region_type_label", "year", "indicator_name", "value"
    )


# Reports


def _trends(w: Workspace) -> DataFrame:
    return reports.vaccination_trends(w.warehouse(), MAIN, COVERAGE)


def _comparison(w: Workspace, indicator: str = MAIN) -> DataFrame:
    return reports.regional_comparison(w.warehouse(), indicator, coverage=COVERAGE)


def _below(w: Workspace) -> DataFrame:
    return reports.below_threshold(w.warehouse(), MAIN, SETTINGS.threshold, COVERAGE)


@on_workspace
def vaccination_trends(w: Workspace) -> DataFrame:
    return reports.ordered("trends", _trends(w), COVERAGE)


@on_workspace
def regional_comparison(w: Workspace) -> DataFrame:
    return reports.ordered("comparison", _comparison(w), COVERAGE)


@on_workspace
def below_threshold(w: Workspace) -> DataFrame:
    return reports.ordered("below_threshold", _below(w), COVERAGE)


@on_workspace
def comparison_other_indicator(w: Workspace) -> DataFrame:
    return reports.ordered("comparison", _comparison(w, "A"), COVERAGE)


@on_workspace
def comparison_low_band(w: Workspace) -> DataFrame:
    return reports.comparison_by_band(_comparison(w), LOW)


def _chosen_names(w: Workspace, keys: tuple[str, ...]) -> list[str]:
    """The names behind a handful of keys, as a user would pick them from a list."""
    picked = w.table("dim_region").where(F.col("region_key").isin(*keys))
    return [row.region_name for row in picked.select("region_name").collect()]


@on_workspace
def trends_selected(w: Workspace) -> DataFrame:
    return reports.trends_for(_trends(w), _chosen_names(w, CHOSEN_REGIONS))


@on_workspace
def recent_for_region(w: Workspace) -> DataFrame:
    name = _chosen_names(w, CHOSEN_REGIONS[:1])[0]
    return reports.recent_for_region(w.warehouse(), name, MAIN)


@on_workspace
def series_by_region(w: Workspace) -> DataFrame:
    return reports.series_by_region(_trends(w), COVERAGE)


@on_workspace
def region_list(w: Workspace) -> DataFrame:
    return reports.region_list(_trends(w))


@on_workspace
def region_names_locale(w: Workspace) -> DataFrame:
    """The first and last names of each kind of region, many with accents or a capital letter."""
    name, size = F.col("region_name"), F.length("region_name")
    accented = F.when(size % 2 == 0, F.translate(name, "aeou", "áéöü")).otherwise(name)
    names = w.table("dim_region").withColumn(
        "region_name", F.when(size % 3 == 0, F.initcap(accented)).otherwise(accented)
    )
    return reports.first_and_last(names, "region_type_label", "region_name")


@on_workspace
def top_regions(w: Workspace) -> DataFrame:
    return reports.top_regions(_comparison(w), coverage=COVERAGE)


@on_workspace
def bottom_regions(w: Workspace) -> DataFrame:
    return reports.bottom_regions(_below(w), coverage=COVERAGE)


@on_workspace
def latest_year(w: Workspace) -> DataFrame:
    return reports.latest_year(w.warehouse(), MAIN)


@on_workspace
def count_below_threshold(w: Workspace) -> DataFrame:
    return metrics.count_below(w.table("stg_health_indicators"), MAIN, SETTINGS.threshold)


@on_workspace
def headline_metrics(w: Workspace) -> DataFrame:
    return reports.headline(w.warehouse(), MAIN, SETTINGS.threshold)


# Quality


@on_workspace
def quality_stats(w: Workspace) -> DataFrame:
    stats = metrics.quality_stats(
        w.table("stg_health_indicators"),
        w.table("stg_regions"),
        w.table("stg_rejected_rows"),
        w.table("stg_data_revisions"),
        w.table("stg_revision_values"),
        MAIN,
        SETTINGS.threshold,
    )
    return stats.withColumn("revisions_detected", F.col("revisions_detected").cast("bigint"))


@on_workspace
def reject_summary(w: Workspace) -> DataFrame:
    return validate.reject_summary(w.table("stg_rejected_rows"))


@on_tables
def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = workspace(spark, sf_dir)
    tables = {n: space.table(n) for n in space.paths}
    for name in ("orders", "customer", "lineitem", "events"):
        tables[name] = inputs.table(spark, sf_dir, name)
    more = (
        Relationship("orders", "o_custkey", "customer", "c_custkey"),
        Relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
        AcceptedRange("events", "value", 0, 100),
    )
    return quality.run_checks(tables, (*quality.STANDARD_CHECKS, *more))


@on_workspace
def dq_checks_added(w: Workspace) -> DataFrame:
    """The standard checks after a second snapshot was appended to a first that was checked: what was
    added is checked, and met with the earlier keys of its partitions."""
    root = scratch(w.spark, "checked")
    for place, day in enumerate((PRIOR, CURRENT)):
        half = w.wide().where(F.col("k") % 2 == place)
        snapshots.land_snapshot(half, raw_root(root), day)
        mode = "append" if place else "replace"
        run(w.spark, root, day, SETTINGS, RUN_TS, mode=mode, as_of_year=AS_OF_YEAR)
        results = check_published(w.spark, root, quality.STANDARD_CHECKS)
    return results


@on_tables
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = inputs.table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])
