"""Four rows from file to report, with every figure along the way."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from helpers import FOUR_ROWS, rows, write_snapshot
from tidemark.__main__ import main
from tidemark.config import Settings
from tidemark.operators.metrics import count_below, quality_stats
from tidemark.operators.quality import STANDARD_CHECKS, run_checks
from tidemark.plans import reports
from tidemark.plans.catalog import publish_catalog
from tidemark.plans.refresh import read_warehouse, run
from tidemark.sources.tables import read_published
from tidemark.streaming.ingest import land_pending

SETTINGS = Settings()
NOW = datetime(2026, 3, 1)
AT, MID = "At or above WHO target", "Moderate coverage"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("four")
    write_snapshot(base / "source", "2026-02-22")
    root = str(base / "root")
    assert land_pending(spark, str(base / "source"), root, SETTINGS) == ["2026-02-22"]
    result = run(spark, root, "2026-02-22", SETTINGS, NOW)
    assert result.prior_snapshot is None
    assert result.counts == {
        "stg_data_revisions": 0, "stg_revision_values": 0, "stg_health_indicators": 16, "stg_rejected_rows": 0,
        "stg_regions": 3, "dim_region": 3, "dim_date": 2, "dim_indicator": 4,
        "fact_health_indicator": 15, "fact_periods": 8,
    }
    return root


def test_staging_and_dimensions(spark, root):
    t = read_published(spark, root)
    assert {r[0] for r in rows(t["dim_indicator"], "indicator_code")} == {
        "dtp3", "measles_mcv1", "polio_pol3", "hepb3",
    }
    assert rows(t["dim_date"], "date_id", "date_day", "quarter") == [
        (20230101, date(2023, 1, 1), 1),
        (20240101, date(2024, 1, 1), 1),
    ]
    assert rows(t["dim_region"], "region_key", "region_type_label") == [
        ("KEN", "Country"), ("OWID_AFR", "Regional aggregate"), ("ZAF", "Country"),
    ]
    staged = t["stg_health_indicators"]
    assert dict(staged.dtypes)["value"] == "decimal(8,2)"
    assert {r.loaded_at for r in staged.collect()} == {NOW}
    assert staged.where("is_missing").count() == 1
    assert staged.where("is_missing <> is_estimated").count() == 0


def test_reports(spark, root):
    w = read_warehouse(spark, root)
    trends = reports.ordered("trends", reports.vaccination_trends(w, "dtp3"))
    assert [(r.region_name, r.year, int(r.dtp3_coverage_pct)) for r in trends.collect()] == [
        ("Africa", 2024, 60), ("Kenya", 2024, 90), ("South Africa", 2023, 82),
        ("South Africa", 2024, 75),
    ]
    comparison = reports.ordered("comparison", reports.regional_comparison(w, "dtp3"))
    assert [(r.region_name, r.coverage_band) for r in comparison.collect()] == [
        ("Kenya", AT), ("South Africa", MID),
    ]
    below = reports.below_threshold(w, "dtp3").drop("region_key")
    assert rows(below) == [("South Africa", "ZAF", 2024, Decimal("75.00"), Decimal("5.00"))]
    assert rows(count_below(read_published(spark, root)["stg_health_indicators"].join(
        w.region.select("region_key"), "region_key"), "dtp3")) == [(2024, 1)]


def test_quality(spark, root):
    t = read_published(spark, root)
    stats = quality_stats(
        t["stg_health_indicators"], t["stg_regions"], t["stg_rejected_rows"],
        t["stg_data_revisions"], t["stg_revision_values"], "dtp3",
    ).first()
    assert (stats.indicator_rows, stats.region_count, stats.country_count) == (16, 3, 2)
    assert (stats.null_values, stats.rejected_rows, stats.revisions_detected) == (1, 0, 0)
    assert (stats.latest_main_year, stats.countries_below_target) == (2024, 1)
    results = run_checks(t).collect()
    assert len(results) == len(STANDARD_CHECKS) == 21
    assert all(r.failures == 0 for r in results)
    log = spark.read.parquet(f"{root}/data_quality_log")
    assert log.count() == 6 and log.where("check_name = 'pipeline_run'").count() == 1
    assert '"total_rows":19' in log.where("table_name = 'pipeline'").first().details


def test_names_analysts_query(spark, root):
    names = publish_catalog(spark, root, SETTINGS)
    assert len(names) == 13
    sql = lambda text: [tuple(r) for r in spark.sql(text).collect()]
    assert sql("SELECT count(*) FROM reporting.rpt_below_threshold") == [(1,)]
    assert sql("SELECT * FROM reporting.rpt_below_threshold ORDER BY dtp3_coverage_pct") == [
        ("South Africa", "ZAF", 2024, Decimal("75.00"), Decimal("5.00"))
    ]
    assert sql("SELECT region_name, coverage_band FROM reporting.rpt_regional_comparison"
               " ORDER BY dtp3_coverage_pct DESC LIMIT 20") == [("Kenya", AT), ("South Africa", MID)]  # fmt: skip
    assert sql("SELECT region_name, year FROM reporting.rpt_vaccination_trends"
               " WHERE region_name IN ('Kenya', 'Africa') ORDER BY region_name") == [
        ("Africa", 2024), ("Kenya", 2024)]
    assert sql(
        "SELECT dr.region_name, dd.year, di.indicator_name, f.value"
        " FROM warehouse.fact_health_indicator f"
        " JOIN warehouse.dim_region dr ON f.region_id = dr.region_key"
        " JOIN warehouse.dim_date dd ON f.date_id = dd.date_id"
        " JOIN warehouse.dim_indicator di ON f.indicator_id = di.indicator_code"
        " WHERE dr.region_name = 'South Africa' AND di.indicator_code = 'dtp3'"
        " ORDER BY dd.year DESC LIMIT 10"
    ) == [("South Africa", 2024, "DTP3", Decimal("75.00")), ("South Africa", 2023, "DTP3", Decimal("82.00"))]
    assert sql("SELECT count(*) FROM staging.stg_rejected_rows") == [(0,)]


def test_command_line(spark, tmp_path, capsys):
    source, root = str(tmp_path / "source"), str(tmp_path / "root")
    assert main(["build", root], spark) == 1
    write_snapshot(tmp_path / "source", "2026-02-15")
    changed = [FOUR_ROWS[0], "South Africa,ZAF,2024,85,76,74,", *FOUR_ROWS[2:], ",,1900,5,5,5,500"]
    write_snapshot(tmp_path / "source", "2026-02-22", changed)
    assert main(["land", source, root], spark) == 0
    assert "coverage.csv" in capsys.readouterr().out
    assert main(["build", root], spark) == 0
    out = capsys.readouterr().out
    assert "stg_rejected_rows: 4 rows" in out and "revisions_detected     | 1" in out
    assert main(["check", root], spark) == 0
    assert main(["check", root, "--expect", "dim_indicator=4", "fact_health_indicator=15"], spark) == 0
    assert main(["check", root, "--expect", "dim_indicator=5"], spark) == 1
    # South Africa now meets the target: nobody is below it and one view is empty.
    assert main(["verify", root], spark) == 1
    assert "below_threshold: 0 rows [EMPTY]" in capsys.readouterr().out
    assert main(["build", root, "--date", "2026-02-15"], spark) == 0
    assert main(["verify", root], spark) == 0
    capsys.readouterr()
    assert main(["show", root, "below_threshold"], spark) == 0
    assert "South Africa" in capsys.readouterr().out
    assert main(["show", root, "trends", "--regions", "Kenya"], spark) == 0
    out = capsys.readouterr().out
    assert "Kenya" in out and "South Africa" not in out
    assert main(["show", root, "comparison", "--indicator", "measles_mcv1"], spark) == 0
    assert "|76.00" in capsys.readouterr().out
    assert main(["show", root, "comparison", "--band", MID], spark) == 0
    out = capsys.readouterr().out
    assert "South Africa" in out and "Kenya" not in out
