"""Command line: the steps of a refresh, and a look at what they published."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions.coverage import AT_TARGET, LOW, MODERATE
from tidemark.operators.metrics import quality_stats, view_status
from tidemark.operators.quality import RowCount, run_checks
from tidemark.plans import reports
from tidemark.plans.checks import check_published
from tidemark.plans.history import update_history
from tidemark.plans.refresh import raw_root, read_warehouse, run
from tidemark.session import build_session, sized_shuffles
from tidemark.sources.files import dated_folders, read_aliases
from tidemark.sources.retention import expire_runs
from tidemark.sources.snapshots import source_row_counts
from tidemark.sources.tables import MODES, published_bytes, read_published
from tidemark.streaming.ingest import (
    land_pending,
    refresh_folders,
    refresh_pending,
    stream_snapshots,
)

SETTINGS = Settings()
COVERAGE = "coverage_pct"


def _reports(
    spark: SparkSession, root: str, indicator: str = SETTINGS.main_indicator
) -> dict[str, DataFrame]:
    w, target = read_warehouse(spark, root), SETTINGS.threshold
    return {
        "trends": reports.vaccination_trends(w, indicator, COVERAGE),
        "comparison": reports.regional_comparison(
            w, indicator, target, SETTINGS.moderate_floor, COVERAGE
        ),
        "below_threshold": reports.below_threshold(w, indicator, target, COVERAGE),
    }


def land(spark: SparkSession, args: argparse.Namespace) -> int:
    days = land_pending(spark, args.source, args.root, SETTINGS, again=args.again)
    if days:
        landed = spark.read.parquet(raw_root(args.root))
        counts = source_row_counts(landed.where(F.col("snapshot_date").isin(days)))
        for row in counts.orderBy("snapshot_date", "file").toLocalIterator():
            print(f"{row.snapshot_date} {row.file}: {row.row_count} rows")
    return 0


def build(spark: SparkSession, args: argparse.Namespace) -> int:
    days = [args.date] if args.date else dated_folders(spark, raw_root(args.root))[-1:]
    if not days:
        print(f"no snapshot is landed under {args.root}", file=sys.stderr)
        return 1
    aliases = read_aliases(spark, args.aliases) if args.aliases else None
    now = datetime.now(timezone.utc)
    for name, rows in run(
        spark, args.root, days[0], SETTINGS, now, aliases, args.mode
    ).counts.items():
        print(f"{name}: {rows} rows")
    tables = read_published(spark, args.root)
    with sized_shuffles(spark, published_bytes(spark, args.root)):
        quality_stats(
            tables["stg_health_indicators"],
            tables["stg_regions"],
            tables["stg_rejected_rows"],
            tables["stg_data_revisions"],
            tables["stg_revision_values"],
            SETTINGS.main_indicator,
            SETTINGS.threshold,
        ).show(vertical=True, truncate=False)
    return 0


def refresh(spark: SparkSession, args: argparse.Namespace) -> int:
    step = refresh_folders(args.root, SETTINGS, args.aliases)
    stream_snapshots(spark, args.source, step, f"{args.root}/_seen").awaitTermination()
    refresh_pending(spark, args.source, args.root, SETTINGS, args.aliases)
    return 0


def history(spark: SparkSession, args: argparse.Namespace) -> int:
    aliases = read_aliases(spark, args.aliases) if args.aliases else None
    for day in update_history(spark, args.root, SETTINGS, datetime.now(timezone.utc), aliases):
        print(f"merged {day}")
    return 0


def expire(spark: SparkSession, args: argparse.Namespace) -> int:
    for folder in expire_runs(spark, args.root, timedelta(days=args.days), datetime.now(timezone.utc)):
        print(f"removed {folder}")
    return 0


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    expected = [RowCount(name, int(n)) for name, n in (x.split("=") for x in args.expect)]
    with sized_shuffles(spark, published_bytes(spark, args.root)):
        results = check_published(spark, args.root).collect()
        if expected:
            results += run_checks(read_published(spark, args.root), expected).collect()
    for r in results:
        state = "pass" if r.failures == 0 else f"FAIL {r.failures}"
        print(f"{r.check_name} {r.table_name}.{r.column_name}: {state}")
    return int(any(r.failures for r in results))


def verify(spark: SparkSession, args: argparse.Namespace) -> int:
    with sized_shuffles(spark, published_bytes(spark, args.root)):
        rows = view_status(_reports(spark, args.root)).collect()
    for r in rows:
        print(f"{r.view_name}: {r.row_count} rows [{r.status}]")
    return int(any(r.status == "EMPTY" for r in rows))


def show(spark: SparkSession, args: argparse.Namespace) -> int:
    report = _reports(spark, args.root, args.indicator)[args.report]
    report = reports.ordered(args.report, report, COVERAGE)
    if args.regions:
        report = reports.trends_for(report, args.regions)
    if args.report == "comparison":
        report = reports.comparison_by_band(report, args.band)
    with sized_shuffles(spark, published_bytes(spark, args.root)):
        report.show(args.rows, False)
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    steps = top.add_subparsers(required=True)

    def step(fn, help_text: str, source: bool = False, aliases: bool = False):
        sub = steps.add_parser(fn.__name__, help=help_text)
        sub.set_defaults(step=fn)
        if source:
            sub.add_argument("source", help="folder of dated folders with CSV files")
        sub.add_argument("root", help="folder of the landed and published tables")
        if aliases:
            sub.add_argument("--aliases", help="CSV file of region aliases")
        return sub

    sub = step(land, "land dated folders that are new", source=True)
    sub.add_argument("--again", action="store_true", help="land those already landed too")
    sub = step(build, "clean a landed snapshot and publish the warehouse", aliases=True)
    sub.add_argument("--date", help="snapshot date; the newest if left out")
    sub.add_argument("--mode", choices=MODES, default="replace")
    step(refresh, "land and build for each new folder, oldest first", source=True, aliases=True)
    step(history, "bring the history of values up to the landed snapshots", aliases=True)
    sub = step(expire, "remove folders of runs that were replaced some time ago")
    sub.add_argument("--days", type=float, default=7.0, help="longer than any query or run takes")
    sub = step(check, "run the data tests; fails if one does")
    sub.add_argument("--expect", nargs="*", default=[], metavar="TABLE=ROWS", help="exact row counts")
    step(verify, "count the rows of each report; fails if one is empty")
    sub = step(show, "print a report")
    sub.add_argument("report", choices=["trends", "comparison", "below_threshold"])
    sub.add_argument("--rows", type=int, default=20)
    codes = [i.code for i in SETTINGS.indicators]
    sub.add_argument("--indicator", choices=codes, default=SETTINGS.main_indicator)
    sub.add_argument("--regions", nargs="+", help="names of regions; all if left out")
    sub.add_argument("--band", choices=[AT_TARGET, MODERATE, LOW], help="for comparison")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    return args.step(spark or build_session(), args)


if __name__ == "__main__":
    sys.exit(main())
