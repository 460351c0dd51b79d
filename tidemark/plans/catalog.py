"""The published tables and the reports under the names analysts query."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

from tidemark.config import Settings
from tidemark.functions.coverage import AT_TARGET, LOW, MODERATE
from tidemark.sources.schemas import PARTITIONS, SCHEMAS, STAGING
from tidemark.sources.tables import BOOKKEEPING, current_paths, run_folder

_STAR = """
FROM warehouse.fact_health_indicator f
JOIN warehouse.dim_region r ON f.region_id = r.region_key
JOIN warehouse.dim_date d ON f.date_id = d.date_id
JOIN warehouse.dim_indicator i ON f.indicator_id = i.indicator_code
WHERE i.indicator_code = '{indicator}'"""

_LATEST = """
  AND r.region_type = 'country'
  AND d.year = (SELECT max(ld.year) FROM warehouse.dim_date ld WHERE ld.date_id IN
    (SELECT p.date_id FROM warehouse.fact_periods p WHERE p.indicator_id = '{indicator}'))"""

REPORT_VIEWS = {
    "rpt_vaccination_trends": "SELECT r.region_name, r.iso_code, r.region_type_label, d.year,"
    " f.value AS dtp3_coverage_pct, f.is_estimated"
    + _STAR
    + "\nORDER BY r.region_name COLLATE UNICODE NULLS LAST, r.region_name NULLS LAST, d.year NULLS LAST",
    "rpt_regional_comparison": "SELECT r.region_name, r.iso_code, d.year,"
    " f.value AS dtp3_coverage_pct, CASE WHEN f.value >= {threshold} THEN '" + AT_TARGET + "'"
    " WHEN f.value >= {moderate} THEN '" + MODERATE + "' ELSE '" + LOW + "' END AS coverage_band"
    + _STAR
    + _LATEST
    + "\nORDER BY f.value DESC NULLS FIRST, r.region_key",
    "rpt_below_threshold": "SELECT r.region_name, r.iso_code, d.year,"
    " f.value AS dtp3_coverage_pct,"
    " CAST({threshold} - f.value AS DECIMAL(9,2)) AS gap_to_target_pct"
    + _STAR
    + _LATEST
    + "\n  AND f.value < {threshold}\nORDER BY f.value NULLS LAST, r.region_key",
}


def _table_sql(name: str, paths: list[str]) -> str:
    cols = ", ".join(
        f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in SCHEMAS[name].fields
    )
    return " UNION ALL ".join(
        f"SELECT {cols} FROM parquet.`{folder}`{_only(name, kept)}" for folder, kept in _by_run(paths).items()
    )


def _by_run(paths: list[str]) -> dict[str, list[str]]:
    """Folders of runs, each with the partitions that are kept of it; an empty list means all."""
    found: dict[str, list[str]] = {}
    for path in paths:
        folder = run_folder(path) or path
        found.setdefault(folder, [])
        if path != folder:
            found[folder].append(path)
    return found


def _only(name: str, kept: list[str]) -> str:
    """The condition that picks out partitions; it is on partition columns, so others are not read."""
    if not kept:
        return ""
    columns = PARTITIONS[name]
    rows = [[unquote(part.partition("=")[2]) for part in path.split("/")[-len(columns) :]] for path in kept]
    quoted = ("(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in row) + ")" for row in rows)
    return f" WHERE ({', '.join(f'CAST({c} AS STRING)' for c in columns)}) IN ({', '.join(quoted)})"


def publish_catalog(spark: SparkSession, root: str, settings: Settings) -> list[str]:
    """Create ``staging.*``, ``warehouse.*`` and ``reporting.*`` as views of what is current.

    Calling it again after a run points each name at the new folders. Returns the names."""
    names = []
    for schema in ("staging", "warehouse", "reporting"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    for name, paths in current_paths(spark, root).items():
        if name in BOOKKEEPING:
            continue
        qualified = f"{'staging' if name in STAGING else 'warehouse'}.{name}"
        spark.sql(f"CREATE OR REPLACE VIEW {qualified} AS {_table_sql(name, paths)}")
        names.append(qualified)
    for name, text in REPORT_VIEWS.items():
        body = text.format(
            indicator=settings.main_indicator.replace("'", "''"),
            threshold=settings.threshold,
            moderate=settings.moderate_floor,
        )
        spark.sql(f"CREATE OR REPLACE VIEW reporting.{name} AS {body}")
        names.append(f"reporting.{name}")
    return names
