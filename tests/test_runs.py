"""Corrected files, partial refreshes, retention, and runs beside each other."""

import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

from helpers import FOUR_ROWS, rows, write_snapshot
from tidemark.config import Settings
from tidemark.plans import refresh, reports
from tidemark.plans.catalog import publish_catalog
from tidemark.plans.refresh import read_warehouse, run
from tidemark.sources import snapshots, tables
from tidemark.sources.retention import expire_runs
from tidemark.sources.tables import ConcurrentRun, current_paths, read_published
from tidemark.streaming.ingest import land_pending, refresh_pending

SETTINGS = Settings()
NOW = datetime(2026, 3, 1, tzinfo=timezone.utc)
MORE = (*FOUR_ROWS[:2], "Kenya,KEN,2024,91,88,91,89", FOUR_ROWS[3])


def published(spark, root):
    return {n: df.drop("loaded_at", "detected_at") for n, df in read_published(spark, root).items()}


def same_tables(a, b):
    return a.keys() == b.keys() and all(rows(a[n], *a[n].columns) == rows(b[n], *a[n].columns) for n in a)


def fresh(spark, source, root):
    """The same source published from nothing."""
    land_pending(spark, str(source), root, SETTINGS)
    newest = sorted(p.name for p in Path(source).iterdir())[-1]
    run(spark, root, newest, SETTINGS, datetime.now(timezone.utc))
    return published(spark, root)


def data_files(root, name):
    return {str(p) for p in Path(root, name).rglob("*.parquet")}


def test_files_corrected_or_taken_away(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    path = write_snapshot(source, "2026-02-15")
    assert refresh_pending(spark, str(source), root, SETTINGS) == ["2026-02-15"]
    assert refresh_pending(spark, str(source), root, SETTINGS) == []
    before = path.stat()
    write_snapshot(source, "2026-02-15", MORE)  # of the same name and length
    assert path.stat().st_size == before.st_size
    os.utime(path, (before.st_atime, before.st_mtime + 60))
    assert refresh_pending(spark, str(source), root, SETTINGS) == ["2026-02-15"]
    values = published(spark, root)["stg_health_indicators"].where("region_key = 'KEN'")
    assert sorted(int(r.value) for r in values.collect()) == [88, 89, 91, 91]
    write_snapshot(source, "2026-02-15", ["Peru,PER,2024,1,2,3,4"], name="more.csv")
    assert refresh_pending(spark, str(source), root, SETTINGS) == ["2026-02-15"]
    (source / "2026-02-15" / "more.csv").unlink()
    assert refresh_pending(spark, str(source), root, SETTINGS) == ["2026-02-15"]
    assert rows(published(spark, root)["stg_regions"], "region_key") == [("KEN",), ("OWID_AFR",), ("ZAF",)]
    (source / "2026-02-15" / "coverage.csv").unlink()
    assert refresh_pending(spark, str(source), root, SETTINGS) == []


def test_changed_dates(spark):
    ddl = "snapshot_date string, file string, n int"
    files = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 1), ("d2", "a", 1), ("d2", "a", 1), ("d3", "a", 2)], ddl)
    landed = spark.createDataFrame([("d1", "a", 1), ("d2", "a", 1), ("d3", "a", 1), ("d4", "a", 1)], ddl)
    keys = ("snapshot_date", "file", "n")
    assert rows(snapshots.changed_dates(files, landed, keys)) == [("d1",), ("d3",)]
    assert rows(snapshots.changed_dates(landed, landed, keys)) == []
    assert rows(snapshots.changed_dates(files, landed.limit(0), keys)) == [("d1",), ("d2",), ("d3",)]


def test_a_late_file_has_its_partitions_written_only(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    refresh_pending(spark, str(source), root, SETTINGS)
    staged, facts = data_files(root, "stg_health_indicators"), data_files(root, "fact_health_indicator")
    # One figure of 2023, all of them in one indicator.
    write_snapshot(source, "2026-02-15", ["Peru,PER,2023,,55,,"], name="late.csv")
    refresh_pending(spark, str(source), root, SETTINGS)
    new = data_files(root, "stg_health_indicators") - staged
    assert {p.split("/")[-2] for p in new} == {"year=2023"}
    assert len(data_files(root, "fact_health_indicator") - facts) == 4
    assert len(facts) == len(staged) == 8
    got, want = published(spark, root), fresh(spark, source, str(tmp_path / "other"))
    assert same_tables(got, want)
    # Views point at the kept partitions and the new ones.
    publish_catalog(spark, root, SETTINGS)
    for name in ("staging.stg_health_indicators", "warehouse.fact_health_indicator"):
        seen = spark.table(name).drop("loaded_at")
        own = got[name.split(".")[1]]
        assert rows(seen, *own.columns) == rows(own, *own.columns)
    trends = reports.vaccination_trends(read_warehouse(spark, root), "measles_mcv1")
    assert sorted(r.year for r in trends.collect() if r.region_name == "Peru") == [2023]
    # A partition that is no longer there goes.
    (source / "2026-02-15" / "late.csv").unlink()
    write_snapshot(source, "2026-02-15", FOUR_ROWS[1:])
    refresh_pending(spark, str(source), root, SETTINGS)
    assert same_tables(published(spark, root), fresh(spark, source, str(tmp_path / "third")))
    assert rows(read_published(spark, root)["dim_date"], "year") == [(2024,)]


def test_a_refresh_without_changes_writes_no_rows(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    refresh_pending(spark, str(source), root, SETTINGS)
    first, files = published(spark, root), data_files(root, "fact_health_indicator")
    counts = run(spark, root, "2026-02-15", SETTINGS, NOW, mode="refresh").counts
    assert counts["stg_health_indicators"] == counts["fact_health_indicator"] == 0
    assert data_files(root, "fact_health_indicator") == files
    assert same_tables(published(spark, root), first)


def test_marks_of_an_appended_table(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15", FOUR_ROWS[:2])
    write_snapshot(source, "2026-02-22", FOUR_ROWS[2:])
    land_pending(spark, str(source), root, SETTINGS)
    run(spark, root, "2026-02-15", SETTINGS, NOW)
    run(spark, root, "2026-02-22", SETTINGS, NOW, mode="append")
    marks = read_published(spark, root)["partition_marks"]
    assert {(r.indicator_code, r.year): r.staged_rows for r in marks.collect()}["dtp3", 2024] == 3
    assert rows(refresh.partition_marks(read_published(spark, root)["stg_health_indicators"])) == rows(marks)
    # A refresh to the second snapshot alone takes the appended rows away again.
    run(spark, root, "2026-02-22", SETTINGS, NOW, mode="refresh")
    assert rows(published(spark, root)["stg_regions"], "region_key") == [("KEN",), ("OWID_AFR",)]
    assert published(spark, root)["stg_health_indicators"].count() == 8


def test_each_snapshot_is_parsed_once(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    write_snapshot(source, "2026-02-22", MORE)
    land_pending(spark, str(source), root, SETTINGS)
    plans, write = [], refresh.write_tables
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")

    def seen(frames, *args):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in frames.values())
        return write(frames, *args)

    monkeypatch.setattr(refresh, "write_tables", seen)
    run(spark, root, "2026-02-22", SETTINGS, NOW)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(plans) > 8
    raw = [p for p in plans if "/root/raw/" in p]
    # Only the list of malformed lines looks at the landed text, at one column of it.
    assert len(raw) == 1 and "malformed_line" in raw[0] and "try_cast" not in "".join(plans).lower()


def test_two_runs_from_one_state(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    land_pending(spark, str(source), root, SETTINGS)
    run(spark, root, "2026-02-15", SETTINGS, NOW)
    write, inner = refresh.write_tables, []

    def meanwhile(frames, *args):
        if not inner:
            inner.append(1)
            inner.append(run(spark, root, "2026-02-15", SETTINGS, NOW, mode="refresh"))
        return write(frames, *args)

    monkeypatch.setattr(refresh, "write_tables", meanwhile)
    with pytest.raises(ConcurrentRun):
        run(spark, root, "2026-02-15", SETTINGS, NOW)
    assert tables.published_version(spark, root) == 2
    assert inner[1].run_id in current_paths(spark, root)["stg_regions"][0]
    assert not [p for p in Path(root, "published").iterdir() if p.name.startswith("_")]
    run(spark, root, "2026-02-15", SETTINGS, NOW)
    assert tables.published_version(spark, root) == 3


def test_expiry_spares_readers_and_what_is_current(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    refresh_pending(spark, str(source), root, SETTINGS)
    reader = read_published(spark, root)
    first = {n: rows(df, *df.columns) for n, df in reader.items()}
    write_snapshot(source, "2026-02-15", ["Peru,PER,2023,,55,,"], name="late.csv")
    refresh_pending(spark, str(source), root, SETTINGS)
    now = datetime.now(timezone.utc)
    # Someone may still read the first state, which was current within the last hour.
    assert expire_runs(spark, root, timedelta(hours=1), now) == []
    assert {n: rows(df, *df.columns) for n, df in reader.items()} == first
    second = published(spark, root)
    gone = expire_runs(spark, root, timedelta(0), datetime.now(timezone.utc))
    # Of the first run's partitions those of 2024 are kept, by the second.
    assert {p.split("/")[-1] for p in gone if "stg_health_indicators" in p} == {"year=2023"}
    assert any("/runs/" in p for p in gone)
    assert same_tables(published(spark, root), second)
    assert same_tables(second, fresh(spark, source, str(tmp_path / "other")))
    assert expire_runs(spark, root, timedelta(0), datetime.now(timezone.utc)) == []


def test_expiry_of_runs_that_were_never_published(spark, tmp_path, monkeypatch):
    source, root = tmp_path / "source", str(tmp_path / "root")
    write_snapshot(source, "2026-02-15")
    land_pending(spark, str(source), root, SETTINGS)

    def dies(*args):
        raise RuntimeError("dies")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "publish", dies)
        with pytest.raises(RuntimeError, match="dies"):
            run(spark, root, "2026-02-15", SETTINGS, NOW)
    assert expire_runs(spark, root, timedelta(hours=1), datetime.now(timezone.utc)) == []
    later = datetime.now(timezone.utc) + timedelta(hours=2)
    assert len(expire_runs(spark, root, timedelta(hours=1), later)) == 3
    assert expire_runs(spark, str(tmp_path / "nothing"), timedelta(0), later) == []
